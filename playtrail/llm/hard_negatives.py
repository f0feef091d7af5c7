"""Hard-negative mining with an R-tree that sort-tile-recursive packing builds, one page of it a row of a table.

Rows are dealt by label and by their most spread coordinate into regions of nearly equal size; within a region
they are packed into pages, within a page sorted and tiled by further coordinates into leaves. Leaves, inner nodes
and regions carry a minimum bounding box, so an inner product with any vector lies between the sums of what each
coordinate can add at least and at most. A search goes best box first: each anchor visits the pages of its most
promising region, which gives a k-th score; after that it visits only regions whose box reaches a score window and isn't
strictly below the k-th. Within a page a queue does the same with the nodes.

What travels is an anchor for each page that it visits, never a pair of rows. Tasks hold one page and a batch of anchors;
the boxes of at most `MAX_REGIONS` regions are broadcast. Rows with equal vectors are spread by a hash of the row.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playtrail.llm.text import stored

SCALE = 256
MAX_REGIONS = 4096
# Bytes of the vectors of one page, rows of a leaf, children of a node, coordinates that tiling may use.
PAGE_BYTES, LEAF_ROWS, FANOUT, MAX_AXES = 1 << 20, 64, 8, 8
# Rows whose sum of squares reaches this take no part, so that a hundred times every product fits into 64 bits.
MAX_SQUARES = 1 << 56
# Stands for the page number in the row that describes a whole region.
_REGION = -1
_LAST = np.iinfo(np.int64).max
_LEAST = np.iinfo(np.int64).min

_PACKED = "row bigint, vec_id bigint, label bigint, anchor boolean, vector binary"
_PAGE = "region int, page int, n int, low_label bigint, high_label bigint, low binary, high binary, payload binary"
_QUERY = "query bigint, label bigint, vector binary, tags array<bigint>, lows array<bigint>, highs array<bigint>"
_VISIT = f"region int, page int, {_QUERY}"
_HIT = "query bigint, tag bigint, score bigint, vec_id bigint, row bigint"


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of rows of `a` with rows of `b`; in doubles where these are exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if a.shape[1] * float(np.abs(a).max()) * float(np.abs(b).max()) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _intervals(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest product that each query can have with a vector in each box."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    return _dot(up, low) + _dot(down, high), _dot(up, high) + _dot(down, low)


def str_order(values: np.ndarray, leaf: int) -> np.ndarray:
    """Sort by the first coordinate, cut into slabs of whole leaves, and go on in each slab with the next one."""
    order = np.argsort(values[:, 0], kind="stable")
    if values.shape[1] == 1 or len(values) <= leaf:
        return order
    n_leaves = -(-len(values) // leaf)
    slab = leaf * -(-n_leaves // int(np.ceil(n_leaves ** (1 / values.shape[1]))))
    parts = [order[k : k + slab] for k in range(0, len(order), slab)]
    return np.concatenate([part[str_order(values[part, 1:], leaf)] for part in parts])


def _matrix(column: pa.Array, n_dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(len(column), n_dims)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(_LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def _id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == _LAST)


@dataclass
class Page:
    """The rows of a page in leaf order and the boxes of all its nodes, the root first."""

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    @classmethod
    def packed(cls, rows, ids, labels, vectors, axes: list[int]) -> "Page":
        """Runs of one label, each tiled; equal vectors stand by id, so that their leaves are apart in it."""
        order = np.lexsort((ids, labels))
        ordered_labels = labels[order]
        starts = np.flatnonzero(np.r_[True, ordered_labels[1:] != ordered_labels[:-1]]) if len(order) else []
        parts = []
        for run in np.split(order, starts[1:]):
            n_axes = max(1, min(len(axes), int(np.log2(max(2, len(run) / LEAF_ROWS)))))
            own = vectors[run][:, axes[:n_axes]] if axes else np.zeros((len(run), 1), np.int32)
            parts.append(run[str_order(own, LEAF_ROWS)])
        order = np.concatenate(parts)
        return cls(rows[order], ids[order], labels[order], vectors[order])

    def payload(self) -> bytes:
        return b"".join(x.tobytes() for x in (self.rows, self.ids, self.labels, self.vectors))

    @classmethod
    def read(cls, payload: bytes, n: int, n_dims: int) -> "Page":
        rows, ids, labels = np.frombuffer(payload, np.int64, 3 * n).reshape(3, n)
        return cls(rows, ids, labels, np.frombuffer(payload, np.int32, n * n_dims, 24 * n).reshape(n, n_dims))

    def build(self) -> None:
        """Boxes level by level: `first_child` of a node, `n_children`, or for leaves their rows."""
        firsts = np.arange(0, len(self.rows), LEAF_ROWS)
        level = [
            np.minimum.reduceat(self.vectors, firsts), np.maximum.reduceat(self.vectors, firsts),
            np.minimum.reduceat(self.labels, firsts), np.maximum.reduceat(self.labels, firsts),
            np.minimum.reduceat(self.ids, firsts),
        ]
        levels = [level]
        while len(levels[-1][0]) > 1:
            low, high, low_label, high_label, least = levels[-1]
            firsts = np.arange(0, len(low), FANOUT)
            levels.append([
                np.minimum.reduceat(low, firsts), np.maximum.reduceat(high, firsts),
                np.minimum.reduceat(low_label, firsts), np.maximum.reduceat(high_label, firsts),
                np.minimum.reduceat(least, firsts),
            ])
        levels.reverse()
        self.n_levels = len(levels)
        self.starts = np.cumsum([0] + [len(level[0]) for level in levels])
        self.low, self.high, self.low_label, self.high_label, self.least = (np.concatenate(parts) for parts in zip(*levels, strict=True))
        self.n_leaves = len(levels[-1][0])

    def children(self, node: int) -> range:
        """The nodes below an inner node, which is one of a level above the leaves'."""
        level = int(np.searchsorted(self.starts, node, "right")) - 1
        first = self.starts[level + 1] + (node - self.starts[level]) * FANOUT
        return range(first, min(first + FANOUT, self.starts[level + 2]))


def _allowed(low_label: np.ndarray, high_label: np.ndarray, label: int, same: bool) -> np.ndarray:
    """Boxes that may hold a row of the label, or of another one."""
    if same:
        return (low_label <= label) & (label <= high_label)
    return (low_label != label) | (high_label != label)


class _Best:
    """The k best (score, id) of one window."""

    def __init__(self, low: int, high: int, k: int):
        self.low, self.high, self.k, self.found = low, high, k, []

    def floor(self) -> int:
        return self.low if len(self.found) < self.k else -self.found[-1][0]

    def useful(self, least: int, most: int, least_id: int) -> bool:
        """Whether a box with these bounds can still add: it meets the window and isn't behind the k-th."""
        if most < self.low or least > self.high:
            return False
        return len(self.found) < self.k or (-most, least_id) < self.found[-1][:2]

    def add(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        hits = np.flatnonzero((scores >= self.floor()) & (scores <= self.high))
        if len(hits):
            if len(hits) > self.k:
                hits = hits[np.lexsort((ids[hits], -scores[hits]))[: self.k]]
            more = zip((-scores[hits]).tolist(), ids[hits].tolist(), rows[hits].tolist(), strict=True)
            self.found = sorted([*self.found, *more])[: self.k]


def _search_page(page: Page, batch: pa.RecordBatch, n_dims: int, same: bool, k: int) -> list[tuple]:
    """Best-first search for every query of the batch."""
    queries = _matrix(batch.column("vector"), n_dims)
    least, most = _intervals(queries, page.low, page.high)
    first_leaf = len(page.low) - page.n_leaves
    out = []
    columns = (batch.column(name).to_pylist() for name in ("query", "label", "tags", "lows", "highs"))
    for place, (query, label, tags, lows, highs) in enumerate(zip(*columns, strict=True)):
        windows = [_Best(low, high, k) for low, high in zip(lows, highs, strict=True)]
        low, high = least[place], most[place]
        open_ = _allowed(page.low_label, page.high_label, label, same) & (high >= min(lows)) & (low <= max(highs))
        vector = queries[place : place + 1]
        queue = [(-int(high[0]), int(page.least[0]), 0)] if open_[0] else []
        while queue:
            bound, least_id, node = heapq.heappop(queue)
            if -bound < min(window.floor() for window in windows):
                break  # strictly below every k-th, as are all that are left
            if not any(window.useful(int(low[node]), -bound, least_id) for window in windows):
                continue
            if node < first_leaf:
                for child in page.children(node):
                    if open_[child]:
                        heapq.heappush(queue, (-int(high[child]), int(page.least[child]), child))
                continue
            start = (node - first_leaf) * LEAF_ROWS
            held = slice(start, start + LEAF_ROWS)
            fits = ((page.labels[held] == label) == same) & (page.rows[held] != query)
            scores = _dot(vector, page.vectors[held])[0][fits]
            for window in windows:
                window.add(scores, page.ids[held][fits], page.rows[held][fits])
        for tag, window in zip(tags, windows, strict=True):
            out.extend((query, tag, -score, vec_id, row) for score, vec_id, row in window.found)
    return out


@dataclass
class Tree:
    """The pages, a table in the shared folder; the boxes of the regions, broadcast; the dimensions."""

    pages: DataFrame
    regions: object
    n_dims: int


def _pack_rows(df: DataFrame, n_dims: int, scale: int) -> DataFrame:
    """Integer vectors of the rows that take part, missing components at the end of shorter ones zero."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            sizes = np.diff(np.asarray(column.offsets))
            flat = column.flatten()
            values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
            row = np.repeat(np.arange(len(column)), sizes)
            within = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            with np.errstate(invalid="ignore", over="ignore"):
                values = np.floor(scale * values)
                squares = np.bincount(row, values * values, len(column))
            kept = squares < MAX_SQUARES  # false for what isn't finite
            dense = np.zeros((len(column), n_dims), np.int32)
            fine = kept[row]
            dense[row[fine], within[fine]] = values[fine].astype(np.int32)
            packed = pa.array([vector.tobytes() for vector in dense], pa.binary())
            whole = [batch.column(name) for name in ("row", "vec_id", "label", "anchor")] + [packed]
            yield pa.RecordBatch.from_arrays(whole, ["row", "vec_id", "label", "anchor", "vector"]).filter(pa.array(kept))

    return df.mapInArrow(pack, _PACKED)


def _axes(packed: DataFrame, n_dims: int) -> list[int]:
    """The coordinates in order of their spread: sums from each task, added up."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, n_dims))
        for batch in batches:
            values = _matrix(batch.column("vector"), n_dims).astype(np.float64)
            sums += values.sum(0), (values * values).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_dims)), pa.array(sums[0]), pa.array(sums[1])], ["axis", "one", "two"])

    n = packed.count()
    rows = packed.select("vector").mapInArrow(add, "axis bigint, one double, two double").groupBy("axis").agg(F.sum("one").alias("one"), F.sum("two").alias("two")).collect()
    spread = {row.axis: row.two - row.one * row.one / max(n, 1) for row in rows}
    return sorted(spread, key=lambda axis: (-spread[axis], axis))[:MAX_AXES]


def _page_row(region: int, page: int, n: int, bounds: tuple, payload: bytes | None) -> pa.RecordBatch:
    low_label, high_label, low, high = bounds
    values = [region, page, n, low_label, high_label, low.tobytes(), high.tobytes(), payload]
    types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = ["region", "page", "n", "low_label", "high_label", "low", "high", "payload"]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)


def build(packed: DataFrame, n_dims: int, page_bytes: int = PAGE_BYTES, max_regions: int = MAX_REGIONS) -> Tree:
    """Regions by range of (label, most spread coordinate, hash of the row), pages of bounded size, tiled leaves."""
    spark, axes = packed.sparkSession, _axes(packed, n_dims)
    page_rows = max(LEAF_ROWS, page_bytes // (4 * max(n_dims, 1)))
    n_rows = packed.count()
    # Small tables get smaller pages, so that there is work for every core.
    n_regions = min(max(n_rows // page_rows, min(64, n_rows // (4 * LEAF_ROWS))) + 1, max_regions)

    def first(vectors: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in vectors:
            values = _matrix(batch.column("vector"), n_dims)[:, axes[0]] if axes else np.zeros(batch.num_rows, np.int32)
            names = ["row", "vec_id", "label", "vector"]
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in names), pa.array(values, pa.int32())], [*names, "spread"])

    placed = packed.mapInArrow(first, "row bigint, vec_id bigint, label bigint, vector binary, spread int")
    order = ["label", "spread", "hashed"]
    dealt = placed.withColumn("hashed", F.xxhash64("row")).repartitionByRange(n_regions, *order).sortWithinPartitions(*order)

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, made = [], 0, []

        def page() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            own = Page.packed(
                np.asarray(table.column("row")), _ids(table.column("vec_id")), np.asarray(table.column("label")),
                _matrix(table.column("vector"), n_dims), axes[1:] or axes,
            )
            bounds = int(own.labels.min()), int(own.labels.max()), own.vectors.min(0), own.vectors.max(0)
            made.append(bounds)
            return _page_row(table.column("region")[0].as_py(), len(made) - 1, table.num_rows, bounds, own.payload())

        region = None
        for batch in batches:
            for k in range(0, batch.num_rows, page_rows):
                part = batch.slice(k, page_rows)
                region = part.column("region")[0].as_py()
                if size + part.num_rows > page_rows:
                    yield page()
                    held, size = [], 0
                held, size = [*held, part], size + part.num_rows
        if size:
            yield page()
            low_labels, high_labels, lows, highs = zip(*made, strict=True)
            yield _page_row(region, _REGION, len(made), (min(low_labels), max(high_labels), np.min(lows, 0), np.max(highs, 0)), None)

    numbered = dealt.withColumn("region", F.spark_partition_id())
    table = stored(numbered.select("row", "vec_id", "label", "vector", "region").mapInArrow(pages, _PAGE), "rtree-pages")
    # One row a region, at most `max_regions`.
    rows = table.where(F.col("page") == _REGION).orderBy("region").collect()
    numbers = [np.array([row[name] for row in rows], np.int64) for name in ("region", "n", "low_label", "high_label")]
    boxes = [np.array([np.frombuffer(row[name], np.int32) for row in rows], np.int32).reshape(len(rows), n_dims) for name in ("low", "high")]
    return Tree(table.where(F.col("page") != _REGION), spark.sparkContext.broadcast((*numbers, *boxes)), n_dims)


def _visits(tree: Tree, queries: DataFrame, same: bool, first: bool) -> DataFrame:
    """The pages that each query visits: of its home region first, of every other that can still add to it after that."""
    regions, n_dims = tree.regions, tree.n_dims
    names = ["query", "label", "vector", "tags", "lows", "highs"]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, n_pages, low_label, high_label, low, high = regions.value
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                batch = whole.slice(k, 256)
                least, most = _intervals(_matrix(batch.column("vector"), n_dims), low, high)
                at, region, page = [], [], []
                columns = (batch.column(name).to_pylist() for name in ("label", "lows", "highs"))
                for place, (label, lows, highs) in enumerate(zip(*columns, strict=True)):
                    fits = _allowed(low_label, high_label, label, same)
                    reach = np.zeros(len(numbers), bool)
                    for one, other in zip(lows, highs, strict=True):
                        reach |= (most[place] >= one) & (least[place] <= other)
                    if not fits.any():
                        continue
                    home = int(np.argmax(np.where(fits, most[place], _LEAST)))
                    fits &= reach
                    chosen = [home] if first else [r for r in np.flatnonzero(fits) if r != home]
                    for r in chosen:
                        at.extend([place] * n_pages[r])
                        region.extend([numbers[r]] * n_pages[r])
                        page.extend(range(n_pages[r]))
                    if len(at) > 4096:
                        yield sent(batch, at, region, page)
                        at, region, page = [], [], []
                if at:
                    yield sent(batch, at, region, page)

    def sent(batch: pa.RecordBatch, at: list, region: list, page: list) -> pa.RecordBatch:
        copies = batch.select(names).take(pa.array(at, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(region, pa.int32()), pa.array(page, pa.int32()), *copies.columns], ["region", "page", *names])

    return queries.select(*names).mapInArrow(route, _VISIT)


def _visit_pages(tree: Tree, visits: DataFrame, same: bool, k: int) -> DataFrame:
    """Each page meets its queries in a stream that is sorted by page: the page first, then batches of queries."""
    n_dims, place = tree.n_dims, ["region", "page"]
    visits = stored(visits, "rtree-visits")
    wanted = tree.pages.join(visits.select(*place).distinct(), place, "left_semi").select(*place, "n", "payload")
    both = wanted.unionByName(visits, allowMissingColumns=True).withColumn("is_query", F.col("query").isNotNull())
    # A number of its own keeps pages apart that are small in bytes but long in work.
    n_tasks = int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(n_tasks, *place).sortWithinPartitions(*place, "is_query")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page = None
        for batch in batches:
            is_query = np.asarray(batch.column("is_query").to_numpy(zero_copy_only=False), bool)
            cuts = np.flatnonzero(~is_query)
            bounds = np.unique(np.r_[0, cuts, cuts + 1, batch.num_rows])
            for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
                if not is_query[start]:
                    page = Page.read(batch.column("payload")[start].as_py(), batch.column("n")[start].as_py(), n_dims)
                    page.build()
                    continue
                for k0 in range(start, stop, 256):
                    found = _search_page(page, batch.slice(k0, min(256, stop - k0)), n_dims, same, k)
                    query, tag, score, vec_id, row = (np.array(x, np.int64) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 5
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query), pa.array(tag), pa.array(score), _id_array(vec_id), pa.array(row)],
                        ["query", "tag", "score", "vec_id", "row"],
                    )

    return dealt.mapInArrow(run, _HIT)


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The k best of each window, with their `rank`; tasks send at most k of each."""
    best = Window.partitionBy("query", "tag").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def nearest(tree: Tree, queries: DataFrame, same: bool, k: int) -> DataFrame:
    """`query, tag, score, vec_id, row, rank`: the k best rows for each window of each query.

    A query is `query` (the row that asks, itself no answer), `label`, `vector`, and windows in `tags, lows,
    highs`, both ends included; rows of the same label answer, or rows of others. Higher scores come first, then
    smaller `vec_id`, null last.
    """
    queries = stored(queries, "rtree-queries")
    home = stored(_best(_visit_pages(tree, _visits(tree, queries, same, True), same, k), k), "rtree-home")
    floors = home.where(F.col("rank") == k).groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("tag", "score"))).alias("floors"))
    raised = F.zip_with("tags", "lows", lambda tag, low: F.greatest(low, F.coalesce(F.element_at("floors", tag), low)))
    later = queries.join(floors, "query", "left").withColumn("lows", F.when(F.col("floors").isNull(), F.col("lows")).otherwise(raised))
    others = _visit_pages(tree, _visits(tree, later, same, False), same, k)
    return _best(home.drop("rank").unionByName(others), k)


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    n_positives: int = 5,
    n_negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: int = SCALE,
    page_bytes: int = PAGE_BYTES,
    max_regions: int = MAX_REGIONS,
) -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score`.

    A score is the inner product of two vectors whose components are floor(scale * x). For each row where `anchors` holds and
    each of its `n_positives` best other rows of its label: the `n_negatives` best rows of other labels with
    low_percent * positive <= 100 * negative <= high_percent * positive. Higher scores come first, then smaller ids, null last.

    Rows with a null label or vector, a null or non-finite component, or a sum of squares of 2**56 or more (where sums
    might not fit into 64 bits) take no part. Components that a shorter vector lacks are zero. Rows that repeat an id
    are rows, and anchors, of their own; an anchor without id keeps its null. Without positives or negatives there
    is no row; an empty table gives none. Other columns are ignored.
    """
    given = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(label).cast("bigint").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.col(vector).cast("array<double>").alias("vector"),
    ).where("label is not null and vector is not null")
    n_dims = max(1, given.agg(F.max(F.size("vector"))).first()[0] or 0)
    packed = stored(_pack_rows(given, n_dims, scale), "rtree-rows")
    tree = build(packed, n_dims, page_bytes, max_regions)
    asked = packed.where("anchor").select(F.col("row").alias("query"), "vec_id", "label", "vector")
    whole = [F.array(F.lit(x).cast("bigint")).alias(name) for name, x in (("tags", 0), ("lows", _LEAST), ("highs", _LAST))]
    positives = stored(
        nearest(tree, asked.select("query", "label", "vector", *whole), True, n_positives)
        .select("query", F.col("row").alias("tag"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "rtree-positives",
    )
    # The window's ends are whole numbers: low_percent * p / 100 rounded up, high_percent * p / 100 rounded down.
    low, high = f"({low_percent} * positive_score)", f"({high_percent} * positive_score)"
    window = positives.select(
        "query",
        "tag",
        F.expr(f"({low} + pmod(-{low}, 100)) div 100").alias("low"),
        F.expr(f"({high} - pmod({high}, 100)) div 100").alias("high"),
    )
    windows = window.where("low <= high").groupBy("query").agg(F.collect_list(F.struct("tag", "low", "high")).alias("w"))
    asking = windows.join(asked, "query").select(
        "query", "label", "vector", F.col("w.tag").alias("tags"), F.col("w.low").alias("lows"), F.col("w.high").alias("highs")
    )
    negatives = nearest(tree, asking, False, n_negatives)
    return (
        negatives.join(positives, ["query", "tag"])
        .join(asked.select("query", F.col("vec_id").alias("anchor_id")), "query")
        .select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
    )
