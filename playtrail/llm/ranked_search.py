"""Ranked lexical search by bag deduplication: equal bags of words over the items' vocabulary are scored once.

A document counts for an item only through the terms that items have, how often it has each of them, and its
length class m. Documents that agree in these, whatever else they say, form a class: rows are dealt by a hash
of the bag and m, and grouped by the bag itself, so a class is never told by its hash alone. Classes are
scored; the members of the few that lead are looked up afterwards, by ascending id.

Items are taken in blocks of at most `BLOCK_TERMS` terms, so what a task holds of them has a fixed bound; each
block reads its own bags. What a task sends on is bounded by the block as well: `top` classes an item.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playtrail.llm.text import stored
from playtrail.scratch import new_folder

TOP = 10
# Terms of one block of items, repeats between items counted; an item with more is a block of its own.
BLOCK_TERMS = 1 << 18
# (document, item) cells and terms that are scored in one step.
_STEP_CELLS, _STEP_POSTS = 1 << 20, 1 << 20
# UTF-8 has bytes from 0x80 on in all characters beyond ASCII and nowhere else, so on lower-cased bytes this is the class of a term.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")

_BAGS = "doc_id bigint, n bigint, bag binary"
_FOUND = "item int, score bigint, least_id bigint, m bigint, hashed bigint, bag binary"


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8; `bytes.lower` changes A-Z alone."""
    return _TERM.findall(text.lower()) if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _packed(counts: Counter, vocabulary: dict[bytes, int]) -> bytes:
    """The counted terms that the vocabulary has, by number: numbers, then counts, four bytes each."""
    known = sorted((vocabulary[term], n) for term, n in counts.items() if term in vocabulary)
    return np.array(known, np.int32).reshape(-1, 2).T.tobytes()


def _bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """`doc_id, n, bag` of every document that has a term."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, bags = [], []
            for text in batch.column("text"):
                found = terms(text.as_py())
                sizes.append(len(found))
                bags.append(_packed(Counter(found), shared.value))
            whole = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())], ["doc_id", "n", "bag"])
            yield whole.filter(pa.array(np.array(sizes, np.int64) > 0))

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")).mapInArrow(restrict, _BAGS)


def _document_counts(bags: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each term of the vocabulary stands: counted in tasks, one list of sums from each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(n_terms, np.int64)
        for batch in batches:
            for bag in batch.column("bag"):
                found = np.frombuffer(bag.as_py(), np.int32)
                own[found[: len(found) // 2]] += 1
        seen = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(own[seen])], ["term", "n"])

    counts = np.zeros(n_terms, np.int64)
    for row in bags.select("bag").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row.term] = row.n
    return counts


def _length_class(n_docs: int, n_terms: int) -> Column:
    """m = 100 - 90 + ((90 * n * N) div L) from the column `n`; decimals keep the product exact for any table."""
    share = f"cast(n as decimal(18,0)) * cast({90 * n_docs} as decimal(18,0)) div cast({max(n_terms, 1)} as decimal(18,0))"
    return F.expr(f"10 + {share}").cast("bigint")


class _Scorer:
    """The items of a block: for each term its weight and the items that have it."""

    def __init__(self, own_terms: list[list[int]], weights: np.ndarray):
        pairs = np.array([(term, item) for item, own in enumerate(own_terms) for term in own], np.int64).reshape(-1, 2)
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        self.n_items, self.weights, self.items = len(own_terms), weights, pairs[:, 1]
        self.first = np.searchsorted(pairs[:, 0], np.arange(len(weights) + 1))
        # Sums in doubles are exact below 2**53.
        self.exact = max(map(len, own_terms), default=0) * int(weights.max(initial=0)) * 10**6 < 1 << 53

    def scores(self, rows: np.ndarray, found: np.ndarray, times: np.ndarray, m: np.ndarray, n_rows: int) -> np.ndarray:
        """Scores by row and item, from the posts (row, term, count, m of the row)."""
        gained = self.weights[found] * ((10**9 * times) // (1000 * times + 8 * m))
        out = np.zeros(n_rows * self.n_items, np.int64)
        fan = self.first[found + 1] - self.first[found]
        ends = np.cumsum(fan)
        start = 0
        while start < len(found):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + (_STEP_POSTS << 2), "right")))
            own = fan[start:stop]
            offset = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            cells = np.repeat(rows[start:stop] * self.n_items, own) + self.items[np.repeat(self.first[found[start:stop]], own) + offset]
            values = np.repeat(gained[start:stop], own)
            if self.exact:
                out += np.bincount(cells, values, len(out)).astype(np.int64)
            else:
                np.add.at(out, cells, values)
            start = stop
        return out.reshape(n_rows, self.n_items)


def _leading(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Rows of the `top` highest scores above 0, equal ones by id."""
    if len(scores) > top:
        rows = np.flatnonzero(scores >= max(np.partition(scores, -top)[-top], 1))
    else:
        rows = np.flatnonzero(scores > 0)
    return rows[np.lexsort((ids[rows], -scores[rows]))][:top]


def _score_classes(classes: DataFrame, own_terms: list[list[int]], weights: np.ndarray, top: int) -> DataFrame:
    """For each item the `top` classes of each task, best score first, then least id.

    Ten classes are enough for ten documents: of a class behind them, every document stands behind the
    least one of each.
    """
    block = classes.sparkSession.sparkContext.broadcast((own_terms, weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Scorer(*block.value)
        own = [[] for _ in range(held.n_items)]
        step = max(1, _STEP_CELLS // max(held.n_items, 1))
        for batch in (whole.slice(k, step) for whole in batches for k in range(0, whole.num_rows, step)):
            bags = batch.column("bag").to_pylist()
            parts = [np.frombuffer(bag, np.int32).reshape(2, -1) for bag in bags]
            sizes = np.array([part.shape[1] for part in parts], np.int64)
            found, times = np.concatenate(parts, axis=1).astype(np.int64)
            rows = np.repeat(np.arange(len(parts)), sizes)
            m = np.asarray(batch.column("m"))
            ids = batch.column("least_id").fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
            hashed = np.asarray(batch.column("hashed"))
            scores = held.scores(rows, found, times, m[rows], len(parts))
            for item in np.flatnonzero(scores.any(axis=0)):
                # A score that the item's present list beats can't come in.
                floor = own[item][-1][0] if len(own[item]) == top else 1
                if scores[:, item].max() < floor:
                    continue
                for row in _leading(scores[:, item], ids, top):
                    own[item].append((int(scores[row, item]), int(ids[row]), int(m[row]), int(hashed[row]), bags[row]))
                own[item] = sorted(own[item], key=lambda entry: (-entry[0], entry[1]))[:top]
        for item, entries in enumerate(own):
            if entries:
                columns = list(zip(*entries, strict=True))
                ids = pa.array([None if i == np.iinfo(np.int64).max else i for i in columns[1]], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(entries), pa.int32()), pa.array(columns[0]), ids, pa.array(columns[2]), pa.array(columns[3]), pa.array(columns[4], pa.binary())],
                    ["item", "score", "least_id", "m", "hashed", "bag"],
                )

    return classes.select("least_id", "m", "hashed", "bag").mapInArrow(score, _FOUND)


def _blocks(items: DataFrame, max_terms: int) -> Iterator[tuple[list[int], list[set[bytes]]]]:
    """Ids and term sets of the items that have terms, so many at a time that their terms stay within the bound."""
    ids, own, size = [], [], 0
    for row in items.toLocalIterator():
        found = set(terms(row.text))
        if not found:
            continue
        if own and size + len(found) > max_terms:
            yield ids, own
            ids, own, size = [], [], 0
        ids, own, size = [*ids, row.item_id], [*own, found], size + len(found)
    if own:
        yield ids, own


def _ranked(docs: DataFrame, ids: list, own: list[set[bytes]], top: int) -> DataFrame:
    """`item_id, rank, doc_id, score` for one block of items."""
    spark = docs.sparkSession
    vocabulary = {term: k for k, term in enumerate(sorted(set().union(*own)))}
    own_terms = [sorted(vocabulary[term] for term in found) for found in own]
    bags = stored(_bags(docs, vocabulary), "search-bags")
    n_docs, n_terms = bags.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.array([weight(n_docs, int(df)) for df in _document_counts(bags, len(vocabulary))], np.int64)
    hashed = (
        bags.where(F.length("bag") > 0)
        .withColumn("m", _length_class(n_docs, n_terms))
        .select("doc_id", "m", "bag", F.xxhash64("bag", "m").alias("hashed"))
    )
    key = ["hashed", "m", "bag"]
    classes = hashed.groupBy(*key).agg(F.min("doc_id").alias("least_id"))
    scored = _score_classes(classes, own_terms, weights, top)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("least_id"))
    leaders = stored(scored.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top).drop("place"), "search-leaders")
    # Two numbers for each leading class, `top` classes an item: the bound of the block holds for them.
    keys = F.broadcast(leaders.select("hashed", "m").distinct())
    in_class = Window.partitionBy(*key).orderBy(F.asc_nulls_last("doc_id"))
    members = (
        hashed.join(keys, ["hashed", "m"], "left_semi")
        .withColumn("place", F.row_number().over(in_class))
        .where(F.col("place") <= top)
        .select(*key, "doc_id")
    )
    named = spark.createDataFrame(list(enumerate(ids)), "item int, item_id bigint")
    in_item = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        leaders.join(members, key)
        .withColumn("rank", F.row_number().over(in_item))
        .where(F.col("rank") <= top)
        .join(named, "item")
        .select("item_id", "rank", "doc_id", "score")
    )


def search(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """`item_id, rank, doc_id, score`: for each item the `top` documents with the highest score above 0.

    Equal scores go by ascending document id, null last. Null and empty texts have no terms: such documents
    count nowhere, such items find nothing. Rows that repeat an id are documents, or items, of their own. Texts
    are read whole, whatever their length. Empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    items = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).cast("binary").alias("text"))
    path = new_folder(spark, "search-ranked")
    schema = "item_id bigint, rank int, doc_id bigint, score bigint"
    spark.createDataFrame([], schema).write.parquet(path)
    for ids, own in _blocks(items, block_terms):
        _ranked(docs, ids, own, top).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
