"""Lines that repeat an earlier line: an exact set-similarity join. Tokens in order of rarity, prefix, position
and length filters give candidates, whose Jaccard similarity is then counted; later matches go."""

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.ngram_join import needed, verified
from playtrail.llm.repeats import bit_map, cell, filter_bits, in_map
from playtrail.llm.text import discard, stored, whole
from playtrail.llm.tokens import Words, byte_values, mixed, plain, steps

SIMILARITY_PERCENT = 80
MIN_WORDS = 1
RARITY_CELLS = 1 << 20
# Words of all lines, and prefix tokens, that meet in one block; those of one token from which on it is split; those of one shuffled row.
WORDS_PER_BLOCK = 1 << 20
POSTS_PER_BLOCK = 100_000
HOT_POSTS = 20_000
POSTS_PER_ROW_GROUP = 1 << 18
# Earlier lines allowed by the bounds among which the first one to verify is chosen.
TRIES = 16
_SEGMENT = 1 << 14
_LAST = (1 << 63) - 1
_VALUES = byte_values(7)


def _narrow(lines: np.ndarray) -> np.ndarray:
    """Line numbers in 16 bits if they fit, which are sorted in linear time."""
    return lines.astype(np.uint16) if len(lines) and lines.max() < 1 << 16 else lines


class _Lines:
    """The token sets of all lines of a step that have words enough, as arrays sorted by line and token."""

    def __init__(self, words: Words, min_words: int):
        breaks = np.flatnonzero(words.data == 10)
        line = np.searchsorted(breaks, words.starts)  # over the whole step
        owner = words.owners()
        # A text begins a line of its own, also where the one before ends without a break.
        line = line + owner
        first_of_text = np.searchsorted(breaks, words.offsets[:-1]) + np.arange(len(words))
        line_words = np.bincount(line, minlength=0) if len(line) else np.zeros(0, np.int64)
        enough = line_words[line] >= min_words if len(line) else np.zeros(0, bool)
        hashes = words.hashes(_VALUES)
        order = np.argsort(hashes[enough])
        order = order[np.argsort(_narrow(line[enough])[order], kind="stable")]
        lines, tokens, owners = line[enough][order], hashes[enough][order], owner[enough][order]
        fresh = np.ones(len(lines), bool)
        fresh[1:] = (lines[1:] != lines[:-1]) | (tokens[1:] != tokens[:-1])
        self.tokens = tokens[fresh]
        lines, owners = lines[fresh], owners[fresh]
        self.starts = np.flatnonzero(np.r_[True, lines[1:] != lines[:-1]]) if len(lines) else np.zeros(0, np.int64)
        self.sizes = np.diff(np.r_[self.starts, len(lines)])
        self.owner = owners[self.starts]
        self.number = lines[self.starts] - first_of_text[self.owner]
        if len(self.starts):
            total = np.add.reduceat(mixed(self.tokens), self.starts)
            either = np.bitwise_xor.reduceat(mixed(self.tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)), self.starts)
            self.keys = mixed((total ^ either) + self.sizes.astype(np.uint64)).view(np.int64)
        else:
            self.keys = np.zeros(0, np.int64)

    def parities(self) -> np.ndarray:
        """128 bits a line, as two columns: whether an odd number of its tokens falls on each.

        Two lines differ in at least as many tokens as bits.
        """
        if not len(self.starts):
            return np.zeros((2, 0), np.int64)
        place = mixed(self.tokens) >> np.uint64(57)
        bit = np.uint64(1) << (place & np.uint64(63))
        halves = [np.where((place < 64) == first, bit, np.uint64(0)) for first in (True, False)]
        return np.stack([np.bitwise_xor.reduceat(half, self.starts).view(np.int64) for half in halves])

    def prefixes(self, levels: np.ndarray, percent: int):
        """The tokens by which each line is found, its rarest ones in their order, and how many each line has.

        They are cut to 32 bits: two tokens that fall together only lead to one more candidate.
        """
        line = np.repeat(np.arange(len(self.starts)), self.sizes)
        level = levels[(self.tokens & np.uint64(len(levels) - 1)).astype(np.int64)]
        order = np.argsort(level, kind="stable")
        order = order[np.argsort(_narrow(line)[order], kind="stable")]
        # Sets too small to reach it with one token more or less are similar to equal ones only: those share a key.
        lengths = np.where(100 * self.sizes < percent * (self.sizes + 1), 0, self.sizes - needed(self.sizes, percent) + 1)
        keep = np.arange(len(line)) - np.repeat(self.starts, self.sizes) < np.repeat(lengths, self.sizes)
        return self.tokens[order][keep].astype(np.uint32).view(np.int32), lengths


def _spots(place: np.ndarray, mark: np.ndarray, line: np.ndarray) -> np.ndarray:
    """One number for a line, from its text's id and hash and its place there."""
    own = mixed(line.astype(np.int64).view(np.uint64)) + mark.astype(np.int64).view(np.uint64)
    return mixed(mixed(own) + place.astype(np.int64).view(np.uint64)).view(np.int64)


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all stretches, one after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def _packed(block: np.ndarray, columns: dict, tokens: np.ndarray | None = None) -> pa.RecordBatch:
    """A row for each block with the values of its rows as bytes, so that few large rows are shuffled.

    With `tokens`, row k has the `columns["found_by"][k]` tokens that follow those of the rows before it.
    """
    order = np.argsort(block, kind="stable")
    full, starts = np.unique(block[order], return_index=True)
    cuts = np.append(starts, len(block))
    lengths = columns.get("found_by")
    columns = {c: values[order] for c, values in columns.items()}
    blobs = {c: [values[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] for c, values in columns.items()}
    if tokens is not None:
        tokens = tokens[_ragged((np.cumsum(lengths) - lengths)[order], lengths[order])]
        ends = np.concatenate([[0], np.cumsum(lengths[order])])[cuts]
        blobs["tokens"] = [tokens[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    arrays = [pa.array(full.astype(np.int32)), *(pa.array(b, pa.binary()) for b in blobs.values())]
    return pa.RecordBatch.from_arrays(arrays, ["block", *blobs])


def _unpacked(table: pa.Table, kinds: dict) -> dict:
    return {c: np.frombuffer(b"".join(v.as_py() for v in table.column(c)), kind) for c, kind in kinds.items()}


def _packed_row(kinds: dict) -> str:
    return ", ".join(["block int", *(f"{c} binary" for c in kinds)])


TOLD = {
    "key": np.int64, "place": np.int64, "mark": np.int64, "line": np.int32, "size": np.int32, "parity": np.int64, "parity2": np.int64,
    "again": np.bool_, "found_by": np.int32, "tokens": np.int32,
}
CLASS = "spot bigint, place bigint, mark bigint, line int, again boolean, size int, parity bigint, parity2 bigint, prefix array<int>"


def _firsts(own: dict) -> tuple[np.ndarray, np.ndarray]:
    """The first line of each key, and the later ones; the same line of the same text, met once more, is neither."""
    order = np.lexsort((own["line"], own["mark"], own["place"], own["key"]))
    fresh = np.ones((2, len(order)), bool)
    key, *place = (own[c][order] for c in ("key", "place", "mark", "line"))
    fresh[0, 1:] = key[1:] != key[:-1]
    fresh[1, 1:] = fresh[0, 1:] | np.any([values[1:] != values[:-1] for values in place], axis=0)
    return order[fresh[0]], order[fresh[1] & ~fresh[0]]


def _line_rows(min_words: int, percent: int, levels, n_blocks: int):
    """All lines, packed by key; those that repeat one of the same batch need no tokens and go by their texts."""

    def run(batches):
        for batch in batches:
            places, marks = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            parts = []
            for words in steps(batch.column(1)):
                own = _Lines(words, min_words)
                at = words.first + own.owner
                tokens, lengths = own.prefixes(levels.value, percent)
                values = [own.keys, places[at], marks[at], own.number, own.sizes, *own.parities(), np.zeros(len(at), bool), lengths, tokens]
                parts.append([v.astype(kind, copy=False) for v, kind in zip(values, TOLD.values(), strict=True)])
            if not parts:
                continue
            *values, tokens = (np.concatenate(own) for own in zip(*parts, strict=True))
            columns = dict(zip(TOLD, values, strict=False))
            first, later = _firsts(columns)
            lengths = columns["found_by"]
            tokens = tokens[_ragged((np.cumsum(lengths) - lengths)[first], lengths[first])]
            columns = {c: v[np.concatenate([first, later])] for c, v in columns.items()}
            columns["again"][len(first) :] = True
            columns["found_by"][len(first) :] = 0
            dealt_by = np.where(columns["again"], columns["mark"], columns["key"]).view(np.uint64)
            yield _packed((mixed(dealt_by) % np.uint64(n_blocks)).astype(np.uint16), columns, tokens)

    return run


def _classes_of_block(table: pa.Table) -> pa.Table:
    """The first line of each key with what finds it, and the lines that repeat it."""
    own = _unpacked(table, TOLD)
    lengths, tokens = own.pop("found_by"), own.pop("tokens")
    starts = np.cumsum(lengths) - lengths
    told = np.flatnonzero(~own["again"])
    first, later = (told[rows] for rows in _firsts({c: own[c][told] for c in ("key", "place", "mark", "line")}))
    later = np.concatenate([later, np.flatnonzero(own["again"])])
    rows = np.concatenate([first, later])
    of_row = np.where(np.arange(len(rows)) < len(first), lengths[rows], 0)
    prefix = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(of_row)]).astype(np.int32)), pa.array(tokens[_ragged(starts[rows], of_row)])
    )
    columns = {c: own[c][rows] for c in ("place", "mark", "line")}
    columns = {"spot": _spots(**columns)} | columns | {"again": np.arange(len(rows)) >= len(first)}
    columns |= {c: own[c][rows] for c in ("size", "parity", "parity2")}
    return pa.table([*map(pa.array, columns.values()), prefix], [*columns, "prefix"])


def _words_of(batch: pa.RecordBatch):
    return (words.hashes(_VALUES) for words in steps(batch.column(0)))


def _prefix_of(batch: pa.RecordBatch):
    return [batch.column(0).flatten().to_numpy()]


def _counted(cells: int, hashes_of=_words_of):
    """How often each counter's words occur in the rows of a task, in segments."""

    def run(batches):
        counts = np.zeros(cells, np.int64)
        for batch in batches:
            for hashes in hashes_of(batch):
                counts += np.bincount((hashes & hashes.dtype.type(cells - 1)).astype(np.int64), minlength=cells)
        segments = counts.reshape(-1, _SEGMENT)
        full = np.flatnonzero(segments.any(axis=1))
        blobs = pa.array([segments[k].astype(np.uint32).tobytes() for k in full], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), blobs], ["segment", "counts"])

    return run


def _totals(parts: DataFrame, cells: int) -> np.ndarray:
    """The sums of the counters of all tasks."""

    def total(key, table):
        counts = np.zeros(_SEGMENT, np.int64)
        for value in table.column("counts"):
            counts += np.frombuffer(value.as_buffer(), np.uint32)
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "counts": [counts.tobytes()]})

    counts = np.zeros(cells, np.int64)
    for row in parts.groupBy("segment").applyInArrow(total, "segment int, counts binary").toLocalIterator():
        counts[row.segment * _SEGMENT : (row.segment + 1) * _SEGMENT] = np.frombuffer(row.counts, np.int64)
    return counts


def token_rarity(texts: DataFrame, cells: int = RARITY_CELLS):
    """For each counter the logarithm of how often its words occur in all texts, as a broadcast byte, and the number of words.

    Words that share a counter count together: the order of rarity may be any for right results.
    """
    counts = _totals(texts.select("text").mapInArrow(_counted(cells), "segment int, counts binary"), cells)
    levels = np.clip(np.rint(6 * np.log2(np.maximum(counts, 1))), 0, 255).astype(np.uint8)
    return texts.sparkSession.sparkContext.broadcast(levels), int(counts.sum())


POST = {
    "token": np.int32, "part": np.int64, "size": np.int32, "at": np.int32, "parity": np.int64, "parity2": np.int64,
    "place": np.int64, "mark": np.int64, "line": np.int32, "open": np.bool_,
}


def _split(tokens: np.ndarray, spots: np.ndarray, chunks) -> tuple[np.ndarray, np.ndarray]:
    """Which rows go to which part of their token, 0 where it has one; each two rows of a token meet in a part of it.

    The rows of a token of n chunks are dealt to them, and each two chunks are a part.
    """
    n = chunks[(tokens & (len(chunks) - 1)).astype(np.int64)].astype(np.int64)
    many = np.flatnonzero(n > 1)
    n = n[many]
    own = (mixed(spots[many].view(np.uint64)) % n.astype(np.uint64)).astype(np.int64)
    at = np.repeat(np.arange(len(many)), n - 1)
    other = np.arange(len(at)) - np.repeat(np.cumsum(n - 1) - (n - 1), n - 1)
    other += other >= own[at]
    part = 1 + np.minimum(own[at], other) * n[at] + np.maximum(own[at], other)
    alone = np.ones(len(tokens), bool)
    alone[many] = False
    whole_tokens = np.flatnonzero(alone)
    return np.concatenate([whole_tokens, many[at]]), np.concatenate([np.zeros(len(whole_tokens), np.int64), part])


@dataclass
class _Map:
    """A broadcast bit map of hashes; it may tell more than are there."""

    bits: int
    packed: Broadcast

    def tells(self, hashes: np.ndarray) -> np.ndarray:
        return in_map(self.packed.value, hashes.astype(np.int64) & (self.bits - 1))


def _map_of(hashes: DataFrame, n: int) -> _Map:
    """The hashes of a one-column table with about `n` rows, far fewer than are looked up."""
    bits = filter_bits(max(n, 1 << 18), 64)
    return _Map(bits, bit_map(hashes.select(cell(F.col(hashes.columns[0]).cast("bigint"), bits).alias("cell")).distinct(), bits))


def _posts(n_blocks: int, chunks, open_spots: _Map | None = None, open_tokens: _Map | None = None):
    """The prefix tokens of classes, packed by token. With the two bit maps only tokens of open classes, which are marked."""

    def packed(parts):
        columns = {c: np.concatenate([p[c] for p in parts]) for c in POST}
        block = mixed(columns["token"].astype(np.uint64) + mixed(columns["part"].view(np.uint64))) % np.uint64(n_blocks)
        return _packed(block.astype(np.uint16 if n_blocks <= 1 << 16 else np.int32), columns)

    def run(batches):
        parts = []
        for batch in batches:
            prefix = batch.column("prefix")
            tokens, lengths = prefix.flatten().to_numpy(), np.diff(prefix.offsets.to_numpy())
            row = np.repeat(np.arange(len(batch)), lengths)
            at = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            spots = batch.column("spot").to_numpy()
            opened = np.ones(len(batch), bool)
            if open_spots is not None:
                opened, keep = open_spots.tells(spots), open_tokens.tells(tokens)
                tokens, row, at = tokens[keep], row[keep], at[keep]
            take, part = _split(tokens, spots[row], chunks.value)
            row = row[take]
            own = {"token": tokens[take], "part": part, "at": at[take], "open": opened[row]}
            own |= {c: batch.column(c).to_numpy()[row] for c in ("size", "parity", "parity2", "place", "mark", "line")}
            parts.append({c: own[c].astype(kind, copy=False) for c, kind in POST.items()})
            if sum(len(p["token"]) for p in parts) >= POSTS_PER_ROW_GROUP:
                yield packed(parts)
                parts = []
        if parts:
            yield packed(parts)

    return run


def _matches(one: dict, other: dict, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length, position and parity bounds for pairs of lines that share a token.

    Also by how many tokens two lines may differ, and how many of these the parities leave.
    """
    m, n, i, j = one["size"], other["size"], one["at"], other["at"]
    both = m + n
    reach = np.minimum(i, j) + np.minimum(m - i, n - j)
    bound = both * (100 - percent) // (100 + percent)
    left = bound - sum(np.bitwise_count(one[c] ^ other[c]).astype(np.int64) for c in ("parity", "parity2"))
    return (100 * m >= percent * n) & (100 * n >= percent * m) & (reach >= needed_of_both(both, percent)) & (left >= 0), bound, left


def needed_of_both(both, percent: int):
    return -(-both * percent // (100 + percent))


def _earlier(percent: int, all_of_them: bool):
    """Pairs of each open line of a block and a line before it that the bounds allow, with what the parities leave.

    A line looks back until one leaves it a quarter of its bound, or `TRIES` are allowed, and takes the one that leaves
    most, unless `all_of_them` are asked for.
    """

    def run(table):
        columns = _unpacked(table, POST)
        order = np.lexsort([columns[c] for c in ("line", "mark", "place", "part", "token")])
        columns = {c: values[order] for c, values in columns.items()}
        token, part = columns["token"], columns["part"]
        starts = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (part[1:] != part[:-1])])
        rank = np.arange(len(token)) - np.repeat(starts, np.diff(np.r_[starts, len(token)]))
        spots = _spots(columns["place"], columns["mark"], columns["line"])
        bounds = {c: columns[c].astype(np.int64) for c in ("size", "at")}
        bounds |= {c: columns[c].view(np.uint64) for c in ("parity", "parity2")}
        later = np.flatnonzero((rank >= 1) & columns["open"])
        tries = np.zeros(len(token), np.int64)
        step, pairs = 1, [np.zeros((3, 0), np.int64)]
        while len(later):
            found, bound, left = _matches({c: v[later] for c, v in bounds.items()}, {c: v[later - step] for c, v in bounds.items()}, percent)
            found &= spots[later] != spots[later - step]
            pairs.append(np.stack([spots[later[found]], spots[later[found] - step], left[found]]))
            if not all_of_them:
                tries[later[found]] += 1
                later = later[~found | (4 * left < np.maximum(bound, 1)) & (tries[later] < TRIES)]
            step += 1
            later = later[rank[later] >= step]
        a, b, left = np.concatenate(pairs, axis=1)
        order = np.lexsort((b, a) if all_of_them else (b, -left, a))
        a, b, left = a[order], b[order], left[order]
        fresh = np.ones(len(a), bool)
        fresh[1:] = (a[1:] != a[:-1]) | all_of_them & (b[1:] != b[:-1])
        return pa.table({"a": a[fresh], "b": b[fresh], "left": left[fresh]})

    return run


def _kept_sets(min_words: int, wanted: _Map):
    """The token sets of the lines whose number is in a bit map; no other line is looked into."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            places, marks = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            data, offsets = plain(batch.column(1))
            data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
            breaks = np.flatnonzero(data == 10)
            starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
            before = np.searchsorted(breaks, offsets)
            n_lines = np.diff(before) + 1
            owner = np.repeat(np.arange(len(batch)), n_lines)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(n_lines) - n_lines, n_lines)
            ends = np.append(starts[1:] - 1, len(data))
            last = np.cumsum(n_lines) - 1
            ends[last] = offsets[1:]
            spots = _spots(places[owner], marks[owner], number)
            keep = np.flatnonzero(wanted.tells(spots))
            for some in np.array_split(keep, max(1, int((ends - starts)[keep].sum()) >> 20)):
                lengths = (ends - starts)[some]
                within = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
                lines = pa.LargeStringArray.from_buffers(len(some), pa.py_buffer(within), pa.py_buffer(data[_ragged(starts[some], lengths)]))
                for words in steps(lines):
                    own = _Lines(words, min_words)
                    keys = spots[some][words.first + own.owner]
                    sets = [own.tokens[a : a + n].tobytes() for a, n in zip(own.starts, own.sizes, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sets, pa.binary())], ["key", "grams"])

    return run


def _linked(pairs: DataFrame, texts: DataFrame, min_words: int, percent: int) -> DataFrame:
    """Candidate pairs of lines with `linked`, counted on their whole sets."""
    wanted = _map_of(pairs.select(F.explode(F.array("a", "b")).alias("key")), 2 * pairs.count())
    sets = texts.mapInArrow(_kept_sets(min_words, wanted), "key bigint, grams binary")
    sets = stored(sets.groupBy("key").agg(F.first("grams").alias("grams")), "lines-sets")
    told = verified(pairs, sets, percent)
    discard(sets)
    return told


def _repeated_spots(texts: DataFrame, classes: DataFrame, min_words: int, percent: int, hot_posts: int) -> DataFrame:
    """Classes of equal token sets that are similar to a class whose first line is earlier.

    The classes of a token meet in a block of tokens, where each is held against the nearest earlier ones;
    the likeliest of those that the bounds allow is verified on whole sets. Only classes without a match there go
    on, to all earlier ones they share a token with. Tokens of more than `hot_posts` classes are dealt to several
    blocks, so that each two classes of a token meet in one.
    """
    spark = texts.sparkSession
    counts = _totals(classes.select("prefix").mapInArrow(_counted(RARITY_CELLS, _prefix_of), "segment int, counts binary"), RARITY_CELLS)
    # A counter has the rows of one token at least.
    chunks = spark.sparkContext.broadcast(np.maximum(-(-counts // hot_posts), 1).astype(np.int32))

    def candidates(*open_maps):
        n_blocks = max(int(counts.sum()) // POSTS_PER_BLOCK, 4 * spark.sparkContext.defaultParallelism)
        posts = classes.mapInArrow(_posts(n_blocks, chunks, *open_maps), _packed_row(POST))
        return posts.groupBy("block").applyInArrow(_earlier(percent, bool(open_maps)), "a bigint, b bigint, left bigint")

    pairs = stored(candidates().groupBy("a").agg(F.max_by("b", "left").alias("b")), "lines-candidates")
    first = _linked(pairs, texts, min_words, percent)
    discard(pairs)

    unmatched = first.where("not linked").select("a")
    open_spots = _map_of(unmatched, unmatched.count())

    def open_prefixes(batches):
        for batch in batches:
            rows = open_spots.tells(batch.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(1).filter(pa.array(rows)).flatten()], ["token"])

    tokens = stored(classes.select("spot", "prefix").mapInArrow(open_prefixes, "token int").distinct(), "lines-tokens")
    open_tokens = _map_of(tokens, tokens.count())
    discard(tokens)
    rest = stored(candidates(open_spots, open_tokens).select("a", "b").distinct(), "lines-second")
    second = _linked(rest, texts, min_words, percent)
    discard(rest)
    linked = first.where("linked").unionByName(second.where("linked"))
    found = stored(linked.select(F.col("a").alias("spot")).distinct(), "lines-matched")
    discard(first, second)
    return found


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()


def _cut(batches):
    """Each text without its removed lines."""
    for batch in batches:
        rows = []
        for text, gone in zip(batch.column(1), batch.column(2), strict=True):
            lines = (text.as_py() or "").split("\n")
            gone = set(gone.as_py() or ())
            kept = "\n".join(line for k, line in enumerate(lines) if k not in gone)
            rows.append((len(lines), len(gone), _digest(kept), kept))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n_lines", "n_removed", "kept_sha256", "kept_text"])


def repeated_lines(
    df: DataFrame, percent: int = SIMILARITY_PERCENT, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text",
    hot_posts: int = HOT_POSTS,
) -> DataFrame:
    """`doc_id, n_lines, n_removed, kept_sha256, kept_text`, one row for each row of `df`.

    A line is removed if an earlier one, by id, then a hash of the text, then place in the text, has `percent` of the union of
    their words in common, as sets and judged on the input. Lines without words stay; with a higher `min_words`, lines of
    fewer words stay as well and are no one's match. Ids are whole numbers. Rows with the same id and text are one
    document and fare alike. Null ids are the last. Null and empty texts have one empty line; an empty table gives no
    rows; other columns are ignored.
    """
    place = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LAST))
    texts = df.select(place.alias("place"), F.col(text).alias("text"), F.xxhash64(text).alias("mark"))
    levels, n_words = token_rarity(texts)
    n_blocks = min(max(n_words // WORDS_PER_BLOCK, 4 * df.sparkSession.sparkContext.defaultParallelism), 1 << 16)
    told = texts.mapInArrow(_line_rows(min_words, percent, levels, n_blocks), _packed_row(TOLD))
    classes = stored(told.groupBy("block").applyInArrow(_classes_of_block, CLASS), "lines-classes")
    firsts = classes.where("not again")
    matched = _repeated_spots(texts, firsts, min_words, percent, hot_posts)
    similar = firsts.select("spot", "place", "mark", "line").join(matched, "spot", "left_semi").drop("spot")
    again = classes.where("again").select("place", "mark", "line")
    gone = again.unionByName(similar).groupBy("place", "mark").agg(F.collect_set("line").alias("gone"))
    gone = stored(gone, "lines-gone")
    discard(classes, matched)

    # Texts that lose no line stay where they are; a bit map of bounded size tells most of them.
    told_by = F.xxhash64("place", "mark")
    bits = filter_bits(gone.count(), 16)
    places = bit_map(gone.select(cell(told_by, bits).alias("cell")).distinct(), bits)

    @F.pandas_udf("boolean")
    def touched(cells: pd.Series) -> pd.Series:
        return pd.Series(in_map(places.value, cells.to_numpy()))

    every = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), place.alias("place"), F.xxhash64(text).alias("mark"))
    every = every.withColumn("touched", touched(cell(told_by, bits)))
    unharmed = every.where("not touched").select(
        "doc_id", F.size(F.split(whole("text"), "\n", -1)).cast("bigint").alias("n_lines"), F.lit(0).cast("bigint").alias("n_removed"),
        F.sha2(whole("text"), 256).alias("kept_sha256"), whole("text").alias("kept_text"),
    )
    kind = df.schema[doc_id].dataType.simpleString()
    cut = every.where("touched").join(gone, ["place", "mark"], "left").select("doc_id", "text", "gone").mapInArrow(
        _cut, f"doc_id {kind}, n_lines bigint, n_removed bigint, kept_sha256 string, kept_text string"
    )
    return unharmed.unionByName(cut)
