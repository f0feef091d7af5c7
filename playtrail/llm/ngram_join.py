"""Documents with similar sets of n-grams: a blocked sparse product of the document by n-gram matrix with itself,
kept to the entries that can reach the least similarity."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.llm.components import components
from playtrail.llm.repeats import bit_map, cell, filter_bits, in_map
from playtrail.llm.text import WORD, discard, stored
from playtrail.llm.tokens import Rolling, ascii_lower, byte_values, mixed, steps

N_GRAM = 5
SIMILARITY_PERCENT = 80
# Counters of how often columns occur; each is one byte when broadcast.
MAX_RARITY_CELLS = 1 << 25
_SEGMENT = 1 << 14
_GREATEST = (1 << 63) - 1
FILTER_BITS_PER_COLUMN = 8
# Blocks of the product: classes on a side, rows that meet in a task, n-grams of whole sets on a side.
CLASSES_PER_CHUNK = 512
ROWS_PER_BLOCK = 50_000
GRAMS_PER_CHUNK = 1 << 20
# N-grams that fewer classes of a block have are counted pair by pair, the others as columns of a dense matrix.
_DENSE = 24
_VALUES = byte_values(6)


def gram_sets(texts: pa.Array, n: int = N_GRAM):
    """For each step of a batch the place of its first text and, per text, the sorted hashes of its distinct n-grams.

    A shorter text has its whole sequence of words as the only n-gram; one without words has none.
    """
    for words in steps(texts, lower=ascii_lower):
        roll = Rolling(words.hashes(_VALUES))
        places = np.arange(max(len(words.starts) - n + 1, 0))
        grams = roll(places, places + n)
        sets = []
        for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
            if b - a >= n:
                sets.append(np.unique(grams[a : b - n + 1]))
            else:
                sets.append(roll(np.array([a]), np.array([b])) if b > a else grams[:0])
        yield words.first, sets


def class_key(grams: np.ndarray) -> int:
    """One number for a set; two different sets share it with odds of 2**-64."""
    both = np.add.reduce(mixed(grams)) ^ np.bitwise_xor.reduce(mixed(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return int(mixed(np.array([both + np.uint64(len(grams))], np.uint64)).view(np.int64)[0])


def needed(size, percent: int):
    """The least overlap of a set of that size with any set similar to it."""
    return -(-size * percent // 100)


def _classes(n: int):
    def run(batches):
        for batch in batches:
            sizes, keys = [], []
            for _, sets in gram_sets(batch.column(1), n):
                sizes += map(len, sets)
                keys += (class_key(grams) if len(grams) else None for grams in sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64())],
                ["doc_id", "mark", "size", "key"],
            )

    return run


def _counted(n: int, cells: int):
    """How often each counter's columns occur in the texts of a task, in segments of bytes; 255 stands for more."""

    def run(batches):
        counts = np.zeros(cells, np.uint32)
        for batch in batches:
            for _, sets in gram_sets(batch.column(1), n):
                places, times = np.unique(np.concatenate(sets) & np.uint64(cells - 1), return_counts=True)
                counts[places.astype(np.int64)] += times.astype(np.uint32)
        segments = np.minimum(counts, 255).astype(np.uint8).reshape(-1, _SEGMENT)
        for full in np.array_split(np.flatnonzero(segments.any(axis=1)), 16):
            blobs = pa.array([segments[k].tobytes() for k in full], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), blobs], ["segment", "counts"])

    return run


def rarity_cells(n_entries: int) -> int:
    """Counters for so many entries, a power of two within bounds: about twenty entries share one."""
    return min(max(1 << max(n_entries // 20 - 1, 0).bit_length(), _SEGMENT), MAX_RARITY_CELLS)


def rarity_levels(texts: DataFrame, n: int, cells: int):
    """For each counter a level, 0 for columns no more common than most and one more for each further half octave.

    Levels only set the order in which columns are looked at, which may be any for right results; with
    passages that many documents share at its end, they lead to no candidates. Broadcast in `cells` bytes.
    """
    parts = texts.mapInArrow(_counted(n, cells), "segment int, counts binary")

    def total(key, table):
        counts = np.zeros(_SEGMENT, np.uint32)
        for value in table.column("counts"):
            counts += np.frombuffer(value.as_buffer(), np.uint8)
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "counts": [counts.tobytes()]})

    counts = np.zeros(cells, np.uint32)
    for row in parts.groupBy("segment").applyInArrow(total, "segment int, counts binary").toLocalIterator():
        counts[row.segment * _SEGMENT : (row.segment + 1) * _SEGMENT] = np.frombuffer(row.counts, np.uint32)
    usual = max(float(counts.mean()), 1.0)
    levels = np.clip(np.rint(2 * np.log2(np.maximum(counts, 1) / usual)) - 1, 0, 255).astype(np.uint8)
    return texts.sparkSession.sparkContext.broadcast(levels)


def _prefixes(n: int, percent: int, levels, shared=None, bits: int = 0):
    """The columns by which each set can be found: similar sets have one of these in common, in any one order.

    With `shared`, only columns whose bit there is set, with the set's key and size.
    """

    def run(batches):
        for batch in batches:
            for _, sets in gram_sets(batch.column(1), n):
                columns, keys, sizes = [], [], []
                for grams in sets:
                    if not len(grams):
                        continue
                    size = len(grams)
                    level = levels.value[(grams & np.uint64(len(levels.value) - 1)).astype(np.int64)]
                    # Sets are sorted by hash, which a stable sort by level keeps.
                    own = grams[np.argsort(level, kind="stable")[: size - needed(size, percent) + 1]].view(np.int64)
                    if shared is not None:
                        own = own[in_map(shared.value, own & (bits - 1))]
                        if not len(own):
                            continue
                        keys.append(np.full(len(own), class_key(grams)))
                        sizes.append(np.full(len(own), size, np.int32))
                    columns.append(own)
                none = np.zeros(0, np.int64)
                arrays = [pa.array(np.concatenate([none, *columns]))]
                names = ["column"]
                if shared is not None:
                    arrays += [pa.array(np.concatenate([none, *keys])), pa.array(np.concatenate([none.astype(np.int32), *sizes]))]
                    names += ["key", "size"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _kept_sets(n: int, wanted, bits: int):
    """Sets of the classes in a bit map, each once a task."""

    def run(batches):
        seen = set()
        for batch in batches:
            for _, sets in gram_sets(batch.column(0), n):
                keys = np.array([class_key(grams) if len(grams) else 0 for grams in sets], np.int64)
                found = []
                for t in np.flatnonzero(in_map(wanted.value, keys & (bits - 1))):
                    if len(sets[t]) and int(keys[t]) not in seen:
                        seen.add(int(keys[t]))
                        found.append(t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[found]), pa.array([sets[t].tobytes() for t in found], pa.binary())], ["key", "grams"]
                )

    return run


def _overlaps(percent: int):
    """A block of the product: entries for candidate pairs only, counted over the columns of both."""

    def run(batches):
        for batch in batches:
            left, right = batch.column("left_grams"), batch.column("right_grams")
            keep = np.zeros(len(batch), bool)
            for k in range(len(batch)):
                a, b = (np.frombuffer(side[k].as_buffer(), np.uint64) for side in (left, right))
                common = np.searchsorted(b, a)
                common = int((b[np.minimum(common, len(b) - 1)] == a).sum())
                keep[k] = 100 * common >= percent * (len(a) + len(b) - common)
            yield batch.select(["a", "b"]).append_column("linked", pa.array(keep))

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs `(a, b)` of classes with `linked`, counted on their whole sets."""
    left = sets.select(F.col("key").alias("a"), F.col("grams").alias("left_grams"))
    right = sets.select(F.col("key").alias("b"), F.col("grams").alias("right_grams"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "left_grams", "right_grams")
    return stored(rows.mapInArrow(_overlaps(percent), "a bigint, b bigint, linked boolean"), "ngram-pairs")


def may_reach(one: Column, other: Column, percent: int) -> Column:
    """The sizes of two sets allow the similarity."""
    return (100 * one >= percent * other) & (100 * other >= percent * one)


def _ordered(one: Column, other: Column) -> list[Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def _sets_of(keys: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """The sets of these classes."""
    keys = stored(keys.distinct(), "ngram-keys")
    bits = filter_bits(keys.count(), 16)
    wanted = bit_map(keys.select(cell(F.col("key"), bits).alias("cell")).distinct(), bits)
    sets = texts.select("text").mapInArrow(_kept_sets(n, wanted, bits), "key bigint, grams binary")
    found = stored(sets.join(keys, "key", "left_semi").groupBy("key").agg(F.first("grams").alias("grams")), "ngram-sets")
    discard(keys)
    return found


def _least_common(one: Column, other: Column, percent: int) -> Column:
    """How many columns the prefixes of two similar sets have in common at least.

    Up to the end of the prefix that ends first, all common columns are in both prefixes; the rest of that set bounds what
    can follow. Together they must come to the overlap that the sizes ask for.
    """
    overlap = F.ceil((one + other) * percent / (100 + percent))
    rest = lambda size: F.ceil(size * percent / 100) - 1
    return F.greatest(overlap - F.greatest(rest(one), rest(other)), F.lit(1))


def similar_classes(texts: DataFrame, n: int, percent: int, n_entries: int, n_columns: int) -> DataFrame:
    """Links `(a, b)` between classes of equal sets that connect exactly the classes that similarity connects.

    The product runs over the columns of prefixes first, a fifth of all. Each column's classes are
    multiplied with the column's leader only; sums that are large enough are verified on whole sets and
    joined to components, which gathers large groups of near copies without all their pairs. Then the
    entries of different components follow, all of them, block by block; classes without a sum that reaches the bound
    from the two sizes go. For the others the blocks of the product of whole sets are made, and a block passes
    on the links that connect its components, of which there are fewer than classes. Columns with the same classes
    are multiplied once, with their number as weight.
    """
    levels = rarity_levels(texts, n, rarity_cells(n_entries))
    columns = texts.mapInArrow(_prefixes(n, percent, levels), "column bigint")
    bits = filter_bits(n_columns, FILTER_BITS_PER_COLUMN)
    repeated = columns.groupBy("column").count().where("count > 1").select(cell(F.col("column"), bits).alias("cell"))
    shared = bit_map(repeated, bits)
    posts = texts.mapInArrow(_prefixes(n, percent, levels, shared, bits), "column bigint, key bigint, size int")
    posts = stored(posts.distinct(), "ngram-columns")

    lists = posts.groupBy("column").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("xor"),
    ).where("n > 1")
    lists = lists.groupBy("n", "sum", "xor").agg(F.min("column").alias("column"), F.count("*").alias("weight"))
    members = posts.join(lists.select("column", "weight"), "column")
    # The class with the most columns leads each of its columns, so that a group of near copies meets around a few of them.
    degree = members.groupBy("key").agg(F.sum("weight").alias("degree"))
    members = stored(members.join(degree, "key"), "ngram-members")
    discard(posts)

    pairs = stored(_against_leaders(members, percent), "ngram-candidates")
    in_pairs = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key")))
    sets = _sets_of(in_pairs, texts, n)
    tested = verified(pairs, sets, percent)
    discard(pairs, sets)
    first = tested.where("linked").select("a", "b")
    joined = components(first)
    open_members = _open(members, joined)
    near = stored(_untested(_products(_with_hubs(open_members), percent), tested), "ngram-near")
    discard(members, open_members)
    sets = _sets_of(near.select("key"), texts, n)
    links = stored(first.unionByName(_forests(near, sets, percent)), "ngram-links")
    discard(tested, near, sets)
    return links


def _open(members: DataFrame, joined: DataFrame) -> DataFrame:
    """Members with their component, of the columns that more than one component has, and with the column's hub.

    A column's hub is the component that has most of it.
    """
    placed = members.join(joined.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    sizes = placed.groupBy("column", "component").agg(F.count("*").alias("n"))
    hubs = sizes.groupBy("column").agg(F.max(F.struct("n", "component")).alias("hub"), F.count("*").alias("several")).where("several > 1")
    return stored(placed.join(hubs.select("column", F.col("hub.component").alias("hub")), "column"), "ngram-open")


def _with_hubs(members: DataFrame) -> DataFrame:
    """Members with `hubs`, the number of hubs that a class has columns of."""
    return members.join(members.groupBy("key").agg(F.count_distinct("hub").alias("hubs")), "key")


def _in_blocks(rows: DataFrame, chunks: DataFrame, per_block: int, n_rows: Column) -> DataFrame:
    """The rows of each hub in blocks of two chunks: `low` and `high`, and `block`, which several small ones share."""
    chunked = rows.join(chunks, "hub").withColumn("chunk", F.pmod(F.xxhash64("key", F.lit(2)), F.col("chunks")).cast("int"))
    copies = chunked.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    n_copies = chunked.agg(F.coalesce(F.sum(n_rows * F.col("chunks")), F.lit(0))).first()[0]
    n_blocks = max(8 * rows.sparkSession.sparkContext.defaultParallelism, int(n_copies) // per_block)
    sides = copies.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")}).drop("chunks", "other")
    return sides.withColumn("block", F.pmod(F.xxhash64("hub", "low", "high"), F.lit(n_blocks)))


def _each_block(table: pa.Table, order: list[str]):
    """The blocks in a group, each as arrays whose rows are sorted by `order`."""
    columns = {c: table.column(c).to_numpy() for c in table.column_names if c != "grams"}
    sorted_by = np.lexsort([columns[c] for c in reversed(["hub", "low", "high", *order])])
    columns = {c: v[sorted_by] for c, v in columns.items()}
    new_block = np.flatnonzero(np.r_[True, np.any([np.diff(columns[c]) != 0 for c in ("hub", "low", "high")], axis=0), True])
    for a, b in zip(new_block[:-1], new_block[1:], strict=True):
        yield {c: v[a:b] for c, v in columns.items()}, sorted_by[a:b]


def _products(members: DataFrame, percent: int) -> DataFrame:
    """`hub, key, component, size` of the classes whose common columns with one of another component can reach the bound,
    and the `least` and `most` of the keys of those others.

    The matrix is cut into blocks: columns by their hub, classes of a hub into chunks, so that a block is a product of
    two chunks and a group of any size spreads over tasks. A pair's columns may lie with several
    hubs; then one of them has at least their share of the bound, and a block keeps the pairs that reach such a share.
    """
    chunks = members.groupBy("hub").agg(F.ceil(F.approx_count_distinct("key") / CLASSES_PER_CHUNK).cast("int").alias("chunks"))
    rows = members.select("hub", "column", "weight", "key", "size", "component", "hubs")
    blocks = _in_blocks(rows, chunks, ROWS_PER_BLOCK, F.lit(1))

    def product(table):
        found = [pa.table({c: pa.array([], pa.int64()) for c in ("hub", "key", "component", "size", "least", "most")})]
        for block, _ in _each_block(table, ["column"]):
            near = _near_classes(block, percent)
            found.append(pa.table({"hub": np.full(len(near["key"]), block["hub"][0]), **near}))
        return pa.concat_tables(found)

    schema = "hub bigint, key bigint, component bigint, size bigint, least bigint, most bigint"
    near = blocks.groupBy("block").applyInArrow(product, schema)
    return near.groupBy("hub", "key", "component", "size").agg(F.min("least").alias("least"), F.max("most").alias("most"))


def _untested(near: DataFrame, tested: DataFrame) -> DataFrame:
    """Without the classes whose only other one of a hub has been tested against them: that link is in, or isn't one."""
    told = near.withColumns({"a": F.least("key", "least"), "b": F.greatest("key", "least")})
    done = tested.select("a", "b", F.lit(True).alias("done"))
    left = told.join(done, ["a", "b"], "left").where((F.col("least") != F.col("most")) | F.col("done").isNull())
    return left.select("hub", "key", "component", "size")


def _near_classes(rows: dict, percent: int) -> dict:
    """The classes of one block that have an entry which is large enough."""
    keys, first, place = np.unique(rows["key"], return_index=True, return_inverse=True)
    own = {c: rows[c][first].astype(np.int64) for c in ("size", "component", "hubs", "chunk")}
    low, high = rows["low"][0], rows["high"][0]
    left, right = (np.flatnonzero(own["chunk"] == side) for side in (low, high))
    at = np.zeros(len(keys), np.int64)
    at[left] = np.arange(len(left))
    at_right = np.zeros(len(keys), np.int64)
    at_right[right] = np.arange(len(right))
    sums = np.zeros((len(left), len(right)), np.int32)
    cuts = np.flatnonzero(np.r_[True, np.diff(rows["column"]) != 0, True])
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        here, chunk = place[a:b], rows["chunk"][a:b]
        sums[np.ix_(at[here[chunk == low]], at_right[here[chunk == high]])] += np.int32(rows["weight"][a])
    i, j = np.nonzero(sums)
    together = sums[i, j].astype(np.int64)
    i, j = left[i], right[j]
    one, other = own["size"][i], own["size"][j]
    enough = np.maximum(-(-(one + other) * percent // (100 + percent)) - np.maximum(needed(one, percent), needed(other, percent)) + 1, 1)
    keep = (
        (together * np.minimum(own["hubs"][i], own["hubs"][j]) >= enough) & (own["component"][i] != own["component"][j])
        & (100 * one >= percent * other) & (100 * other >= percent * one)
    )
    one, other = np.r_[i[keep], j[keep]], np.r_[j[keep], i[keep]]
    least, most = np.full(len(keys), _GREATEST), np.full(len(keys), -_GREATEST)
    np.minimum.at(least, one, keys[other])
    np.maximum.at(most, one, keys[other])
    near = np.unique(one)
    return {"key": keys[near], "component": own["component"][near], "size": own["size"][near], "least": least[near], "most": most[near]}


def _forests(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links `(a, b)` that connect what similarity connects among the classes of each hub.

    Again in blocks of two chunks, now of whole sets and of bounded size. A block counts all overlaps of its classes and
    passes on a spanning forest of its components.
    """
    sizes = F.greatest(F.count("*") / CLASSES_PER_CHUNK, F.sum("size") / GRAMS_PER_CHUNK)
    chunks = near.groupBy("hub").agg(F.ceil(sizes).cast("int").alias("chunks"))
    blocks = _in_blocks(near, chunks, GRAMS_PER_CHUNK, F.col("size")).join(sets, "key")

    def connect(table):
        found = [np.zeros((2, 0), np.int64)]
        grams = table.column("grams").combine_chunks()
        for block, rows in _each_block(table, ["key"]):
            own = [np.frombuffer(grams[int(row)].as_buffer(), np.uint64) for row in rows]
            found.append(_forest(block, own, percent))
        both = np.concatenate(found, axis=1)
        return pa.table({"a": both.min(axis=0), "b": both.max(axis=0)})

    return blocks.groupBy("block").applyInArrow(connect, "a bigint, b bigint")


def _overlap_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many n-grams each class on the left has in common with each on the right."""
    used = np.union1d(left, right)
    place = np.repeat(used, [len(sets[k]) for k in used])
    grams = np.concatenate([sets[k] for k in used])
    order = np.argsort(grams, kind="stable")
    grams, place = grams[order], place[order]
    starts = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
    sizes = np.diff(np.r_[starts, len(grams)])
    at, at_right = np.full(len(sets), -1), np.full(len(sets), -1)
    at[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
    counts = np.zeros((len(left), len(right)), np.int64)
    for size in range(2, _DENSE):
        for some in np.array_split(starts[sizes == size], max(1, (sizes == size).sum() * size * size >> 20)):
            members = place[some[:, None] + np.arange(size)]
            i, j = at[members][:, :, None], at_right[members][:, None, :]
            cells = (i * len(right) + j)[(i >= 0) & (j >= 0)]
            counts += np.bincount(cells, minlength=counts.size).reshape(counts.shape)
    common = np.flatnonzero(sizes >= _DENSE)
    for some in np.array_split(common, max(1, len(common) >> 10)):
        column = np.repeat(np.arange(len(some)), sizes[some])
        members = place[np.concatenate([np.arange(starts[k], starts[k] + sizes[k]) for k in some])] if len(some) else place[:0]
        one, other = (np.zeros((side, len(some)), np.float32) for side in (len(left), len(right)))
        for matrix, where in ((one, at), (other, at_right)):
            inside = where[members] >= 0
            matrix[where[members][inside], column[inside]] = 1
        counts += (one @ other.T).astype(np.int64)
    return counts


def _forest(rows: dict, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Links of one block, one fewer than the components that they connect, as two rows of keys."""
    left, right = (np.flatnonzero(rows["chunk"] == rows[side][0]) for side in ("low", "high"))
    if not len(left) or not len(right):
        return np.zeros((2, 0), np.int64)
    sizes = rows["size"].astype(np.int64)
    common = _overlap_counts(sets, left, right)
    linked = 100 * common >= percent * (sizes[left][:, None] + sizes[right][None, :] - common)
    _, component = np.unique(rows["component"], return_inverse=True)
    ways = np.zeros((len(sets), len(sets)), bool)
    ways[np.ix_(left, right)] = linked
    ways |= ways.T
    reached = np.zeros(component.max() + 1, bool)
    links = []
    for start in range(len(reached)):
        if reached[start]:
            continue
        reached[start] = True
        queue = [start]
        while queue:
            own = np.flatnonzero(component == queue.pop())
            near = np.flatnonzero(ways[own].any(axis=0))
            for k in near:
                if not reached[component[k]]:
                    reached[component[k]] = True
                    queue.append(component[k])
                    links.append((rows["key"][own[ways[own, k].argmax()]], rows["key"][k]))
    return np.array(links, np.int64).reshape(-1, 2).T


def _against_leaders(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of a column's leader with its other classes, if their columns add up to half the bound."""
    leaders = members.groupBy("column").agg(F.max(F.struct("degree", "key", "size")).alias("leader"))
    size, leader_size = F.col("size"), F.col("leader.size")
    return (
        members.join(leaders, "column").where(F.col("key") != F.col("leader.key")).where(may_reach(size, leader_size, percent))
        .groupBy(*_ordered(F.col("key"), F.col("leader.key")), _least_common(size, leader_size, percent).alias("enough"))
        .agg(F.sum("weight").alias("together")).where("2 * together >= enough").select("a", "b").distinct()
    )


def _grouped(df: DataFrame, n: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """Per row of `df` its id, a hash of its text, the size and key of its set, its group (a key) and the group's least id."""
    texts = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("mark"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    told = texts.mapInArrow(_classes(n), f"doc_id {kind}, mark bigint, size bigint, key bigint")
    told = stored(told, "ngram-classes")
    classes = told.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    n_entries, n_texts = told.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    n_columns = n_entries * (100 - percent) // 100 + n_texts
    links = similar_classes(texts.select("doc_id", "text"), n, percent, n_entries, n_columns)
    linked = components(links).join(classes.withColumnRenamed("key", "node"), "node")
    named = linked.groupBy("component").agg(F.min("least").alias("named"))
    of_class = linked.join(named, "component").select(F.col("node").alias("key"), "component", "named")
    every_class = classes.join(of_class, "key", "left").select(
        "key", F.coalesce("component", "key").alias("group"), F.coalesce("named", "least").alias("named")
    )
    return told.join(every_class, "key", "left")


def near_groups(
    df: DataFrame, n: int = N_GRAM, percent: int = SIMILARITY_PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`doc_id, n_shingles, component_id`, one row for each row of `df`.

    Two texts are linked if their sets of n-grams of words, A-Z in lower case, have `percent` of their union
    in common; `component_id` is the least id that links lead to. Equal sets are one class from the start, so copies
    cost nothing more. Texts without words are linked with nothing and have their own id. Null ids don't name
    a component that has another id. An empty table gives no rows; other columns are ignored.
    """
    return _grouped(df, n, percent, doc_id, text).select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("named", "doc_id").alias("component_id")
    )


def drop_near_copies(
    df: DataFrame, n: int = N_GRAM, percent: int = SIMILARITY_PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of `df`, with all their columns, of which each group keeps the one with the least id (null last).

    Rows that repeat both id and text come down to one; rows without words all stay. Rows whose group has no other
    go straight through; only the others, told by a bit map of bounded size, are shuffled.
    """
    told = stored(_grouped(df, n, percent, doc_id, text).where("key is not null"), "ngram-groups")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    winners = told.groupBy("group").agg(F.min(row).alias("winner"), F.count("*").alias("n")).where("n > 1")
    in_groups = told.join(winners, "group")
    told_by = F.xxhash64("doc_id", "mark")
    bits = filter_bits(told.count(), 16)
    places = bit_map(in_groups.select(cell(told_by, bits).alias("cell")).distinct(), bits)

    @F.pandas_udf("boolean")
    def grouped(cells: pd.Series) -> pd.Series:
        return pd.Series(in_map(places.value, cells.to_numpy()))

    own_mark = F.xxhash64(text)
    flagged = F.col(text).isNotNull() & F.col(text).rlike(WORD) & grouped(cell(F.xxhash64(F.col(doc_id), own_mark), bits))
    marked = df.withColumns({"__ngram_mark": own_mark, "__ngram_again": F.coalesce(flagged, F.lit(False))})
    losers = in_groups.where(~row.eqNullSafe(F.col("winner"))).select(F.col("doc_id").alias("__ngram_id"), "mark").distinct()
    lost = F.col(doc_id).eqNullSafe(F.col("__ngram_id")) & (F.col("__ngram_mark") == F.col("mark"))
    kept = marked.where("__ngram_again").join(losers, lost, "left_anti").dropDuplicates([doc_id, "__ngram_mark"])
    return marked.where("not __ngram_again").unionByName(kept).select(*df.columns)
