"""Repeated passages: Rabin-Karp hashes of every fixed-length window of words, counted in Spark; windows that
a smaller id has too merge into the longest stretches to remove."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.text import stored
from playtrail.llm.tokens import Rolling, Words, byte_values, steps

WINDOW = 50
ANCHOR = 8
_LAST = (1 << 63) - 1
_FIRST_VALUES, _SECOND_VALUES = byte_values(50), byte_values(51)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours, from running minima in blocks of that width, forwards and back."""
    n = len(values) - width + 1
    if n < 1:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    forwards = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], forwards[width - 1 : width - 1 + n])


class _Hashed:
    """Two independent hashes of the words of a step, and of any stretch of them."""

    def __init__(self, words: Words):
        self.words = words
        self.rolls = [Rolling(words.hashes(values)) for values in (_FIRST_VALUES, _SECOND_VALUES)]

    def stretch(self, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        return [roll(starts, ends).view(np.int64) for roll in self.rolls]

    def texts(self) -> list[np.ndarray]:
        return self.stretch(self.words.bounds[:-1], self.words.bounds[1:])

    def anchors(self, window: int, anchor: int) -> np.ndarray:
        """For each word the least hash of the short runs in the window that starts there: equal windows have
        equal anchors, and neighbours mostly share theirs. Windows that leave their text are for the caller to skip."""
        n = max(len(self.words.starts) - anchor + 1, 0)
        starts = np.arange(n)
        return sliding_least(self.rolls[0](starts, starts + anchor).view(np.int64), window - anchor + 1)


def _window_starts(words: Words, t: int, window: int) -> np.ndarray:
    return np.arange(words.bounds[t], max(words.bounds[t + 1] - window + 1, words.bounds[t]))


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _anchored(window: int, anchor: int):
    """Per text its hashes, number of words, digest of all its words, and its distinct anchors."""

    def run(batches):
        for batch in batches:
            rows = []
            for words in steps(batch.column(1)):
                hashed = _Hashed(words)
                anchors, (first, second) = hashed.anchors(window, anchor), hashed.texts()
                for t in range(len(words)):
                    own = np.unique(anchors[_window_starts(words, t, window)])
                    n = int(words.bounds[t + 1] - words.bounds[t])
                    rows.append((int(first[t]), int(second[t]), n, _digest(words.text(t)), pa.array(own)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            offsets = np.concatenate([[0], np.cumsum([len(own) for own in columns[4]])]).astype(np.int32)
            anchors = pa.ListArray.from_arrays(
                pa.array(offsets), pa.concat_arrays(columns[4]) if rows else pa.array([], pa.int64())
            )
            arrays = [pa.array(c, k) for c, k in zip(columns[:4], (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays, anchors], ["place", "one", "two", "n_words", "all_sha256", "anchors"])

    return run


def _windows(window: int, anchor: int):
    """Hashes of all windows whose anchor is among those given with the text."""

    def run(batches):
        for batch in batches:
            places = batch.column(0).to_numpy()
            for words in steps(batch.column(1)):
                hashed = _Hashed(words)
                anchors, (first, _) = hashed.anchors(window, anchor), hashed.texts()
                found = []
                for t in range(len(words)):
                    starts = _window_starts(words, t, window)
                    wanted = batch.column(2)[words.first + t].values.to_numpy()
                    found.append(starts[np.isin(anchors[starts], wanted)])
                starts = np.concatenate([np.zeros(0, np.int64), *found])
                owner = np.repeat(np.arange(len(words)), [len(f) for f in found])
                one, two = hashed.stretch(starts, starts + window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (places[words.first + owner], first[owner], (starts - words.bounds[owner]).astype(np.int32), one, two)],
                    ["place", "one", "start", "window_one", "window_two"],
                )

    return run


def stretches(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Windows at these starts, in order, merged into the longest stretches `(first word, end)`."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > window)
    return list(zip(starts[[0, *(cuts + 1)]].tolist(), (starts[[*cuts, -1]] + window).tolist(), strict=True))


def _cut(window: int):
    """What is left of each text without its stretches."""

    def run(batches):
        for batch in batches:
            rows = []
            for words in steps(batch.column(1)):
                first = _Hashed(words).texts()[0]
                for t in range(len(words)):
                    at = words.first + t
                    if batch.column(2)[at].as_py() != first[t]:
                        continue  # another text with the same id
                    found = stretches(np.unique(batch.column(3)[at].values.to_numpy()), window)
                    keep = np.ones(words.bounds[t + 1] - words.bounds[t], bool)
                    for a, b in found:
                        keep[a:b] = False
                    rows.append((batch.column(0)[at].as_py(), int(first[t]), int((~keep).sum()), _digest(words.text(t, keep)),
                                 [{"first": a, "end": b} for a, b in found]))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            stretch = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), stretch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["place", "one", "n_removed", "kept_sha256", "removed"]
            )

    return run


def repeated_passages(
    df: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`doc_id, n_words, n_removed, kept_sha256, removed`, one row for each row of `df`.

    A word is removed if a window of `window` words over it also starts in a row with a smaller id; `removed` has the
    stretches as `(first, end)` in words, null where nothing goes, and for a whole text its one stretch.

    How it stays small: equal windows have equal anchors, so windows with an anchor that only one text has
    can't repeat and never leave their task. Anchors, one for about 22 words, are counted; only texts with
    shared anchors send window hashes. Texts with the same words come down to the smallest id first: each
    window of a copy also starts there. Hot windows meet no single task: least ids are formed before the
    shuffle, and the join back to the windows may be split.

    A null id is larger than any other, and rows with equal ids remove nothing from each other. Null and
    empty texts have no words; an empty table gives no rows; other columns are ignored.
    """
    place = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LAST))
    texts = df.select(place.alias("place"), F.col(text).alias("text"))
    told = texts.mapInArrow(
        _anchored(window, anchor),
        "place bigint, one bigint, two bigint, n_words bigint, all_sha256 string, anchors array<bigint>",
    )
    told = stored(told, "passages-texts")
    least = told.groupBy("one", "two").agg(F.min("place").alias("least"))
    unique = told.join(least.withColumnRenamed("least", "place"), ["one", "two", "place"], "left_semi")
    posts = stored(unique.select("place", F.explode("anchors").alias("anchor")), "passages-anchors")
    shared = posts.groupBy("anchor").agg(F.min("place").alias("a"), F.max("place").alias("z")).where("a < z").select("anchor")
    wanted = posts.join(shared, "anchor", "left_semi").groupBy("place").agg(F.collect_set("anchor").alias("anchors"))
    candidates = stored(texts.join(wanted, "place"), "passages-candidates")

    windows = candidates.select("place", "text", "anchors").mapInArrow(
        _windows(window, anchor), "place bigint, one bigint, start int, window_one bigint, window_two bigint"
    )
    key = ["window_one", "window_two"]
    earliest = windows.groupBy(*key).agg(F.min("place").alias("earliest"), F.max("place").alias("latest"))
    hits = windows.join(earliest.where("earliest < latest"), key).where("place > earliest")
    starts = hits.groupBy("place", "one").agg(F.collect_list("start").alias("starts"))
    cut = (
        candidates.select("place", "text").join(starts, "place").select("place", "text", "one", "starts")
        .mapInArrow(_cut(window), "place bigint, one bigint, n_removed bigint, kept_sha256 string, removed array<struct<first: bigint, end: bigint>>")
        .dropDuplicates(["place", "one"])
    )
    copy = (F.col("place") > F.col("least")) & (F.col("n_words") >= window)
    whole_text = F.array(F.struct(F.lit(0).cast("bigint").alias("first"), F.col("n_words").alias("end")))
    return (
        told.drop("anchors").join(least, ["one", "two"]).join(cut, ["place", "one"], "left")
        .select(
            F.when(F.col("place") != _LAST, F.col("place")).alias("doc_id"),
            "n_words",
            F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("bigint"))).alias("n_removed"),
            F.when(copy, F.lit(_digest(b""))).otherwise(F.coalesce("kept_sha256", "all_sha256")).alias("kept_sha256"),
            F.when(copy, whole_text).otherwise(F.col("removed")).alias("removed"),
        )
    )
