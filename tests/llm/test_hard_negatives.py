"""Hard negatives against plain products of all vectors."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from playtrail.llm.hard_negatives import LEAF_ROWS, Page, _intervals, _search_page, hard_negatives, str_order

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, region int"


def mined(df, **settings):
    return hard_negatives(df, F.col("vec_id") % 5 == 0, **settings)


def expected(rows, n_positives=5, n_negatives=3):
    used = []
    for vec_id, vector, label in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            used.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    used = [row for row in used if sum(x * x for x in row[1]) < 1 << 56]
    order = lambda pair: (-pair[0], pair[1][0] is None, pair[1][0] or 0)
    out = []
    for a, (vec_id, vector, label) in enumerate(used):
        if vec_id is None or vec_id % 5:
            continue
        scored = [(sum(x * y for x, y in zip(vector, other[1], strict=False)), other) for b, other in enumerate(used) if a != b]
        for score, positive in sorted((p for p in scored if p[1][2] == label), key=order)[:n_positives]:
            window = [n for n in scored if n[1][2] != label and 50 * score <= 100 * n[0] <= 95 * score]
            for rank, (value, negative) in enumerate(sorted(window, key=order)[:n_negatives], 1):
                out.append((vec_id, positive[0], rank, negative[0], score, value))
    return Counter(out)


def rows(n=400, dims=6, seed=0):
    draw = random.Random(seed)
    out = []
    for k in range(n):
        vector = [draw.gauss(0, 1) for _ in range(dims)]
        kind = draw.random()
        if kind < 0.3:
            vector = [0.5, -0.25, 1.0, 0.0, 0.125, -1.0][:dims]  # a common vector: ties
        elif kind < 0.34:
            vector[draw.randrange(dims)] = draw.choice([None, float("nan"), float("inf")])
        elif kind < 0.36:
            vector = None
        elif kind < 0.38:
            vector = vector[:3]
        elif kind < 0.39:
            vector = [1e20] * dims
        out.append((k if draw.random() > 0.02 else None, vector, draw.choice([0, 0, 0, 1, 2, 3, None])))
    return [*out, out[5], out[10], (777, [], 1), (780, [], 1)]


def frame(spark, given):
    return spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in given], SCHEMA)


@pytest.mark.parametrize("page_bytes,max_regions", [(1 << 20, 4096), (LEAF_ROWS * 24, 3)])
def test_against_all_products(spark, page_bytes, max_regions):
    given = rows()
    found = mined(frame(spark, given), page_bytes=page_bytes, max_regions=max_regions)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, found.collect())) == expected(given)


def test_few_rows_and_labels(spark):
    for given in ([], [(0, [1.0], 1)], [(0, [1.0], 1), (5, [1.0], 1)], [(0, [1.0], 1), (5, [1.0], 2)], [(0, [2.0], 1), (1, [2.0], 1), (2, [1.5], 3)]):
        found = mined(frame(spark, given)).collect()
        assert Counter(map(tuple, found)) == expected(given)


def test_str_packs_every_row_into_leaves_near_each_other():
    draw = np.random.default_rng(1)
    points = draw.integers(-1000, 1000, (4096, 2)).astype(np.int32)
    order = str_order(points, 64)
    assert sorted(order) == list(range(4096))
    leaves = points[order].reshape(64, 64, 2)
    assert np.median(np.ptp(leaves, axis=1)) < 500  # a square root of the leaves a side, not whole strips


def test_boxes_bound_products_and_prune(spark):
    import pyarrow as pa

    draw = np.random.default_rng(2)
    n = 5000
    vectors = (draw.normal(size=(n, 2)) * 300).astype(np.int32)
    page = Page.packed(np.arange(n), np.arange(n), draw.integers(0, 2, n), vectors, [0, 1])
    page = Page.read(page.payload(), n, 2)
    page.build()
    query = vectors[:1]
    least, most = _intervals(query, page.low, page.high)
    products = page.vectors @ query[0]
    first = len(page.low) - page.n_leaves
    for leaf in range(page.n_leaves):
        own = products[leaf * LEAF_ROWS : (leaf + 1) * LEAF_ROWS]
        assert least[0, first + leaf] <= own.min() and own.max() <= most[0, first + leaf]
    seen = []
    original = Page.children
    Page.children = lambda self, node: seen.append(node) or original(self, node)
    try:
        batch = pa.RecordBatch.from_pylist([
            {"query": 0, "label": int(page.labels[page.rows == 0][0]), "vector": query[0].tobytes(), "tags": [0], "lows": [-(2**62)], "highs": [2**62]}
        ])
        found = _search_page(page, batch, 2, True, 5)
    finally:
        Page.children = original
    own = sorted(((-int(p), int(i)) for p, i, r, l in zip(products, page.ids, page.rows, page.labels, strict=True) if r != 0 and l == page.labels[page.rows == 0][0]))[:5]
    assert [(-score, vec_id) for _, _, score, vec_id, _ in found] == own
    assert len(seen) < 0.5 * first  # few inner nodes are opened
