import random

import pytest

from playtrail.operators import measure_ranges, most_specific_ranges, with_city
from tests.conftest import plan_of, rows_of

RANGES = "ip_lo bigint, ip_hi bigint, city string"


def num(ip):
    a, b, c, d = (int(x) for x in ip.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


@pytest.fixture(scope="module")
def ranges(spark):
    rows = [
        (num("1.0.0.0"), num("1.0.0.255"), "A"),
        (num("1.0.1.0"), num("1.0.1.0"), "one address"),
        (num("1.0.255.0"), num("1.1.0.255"), "across an edge"),
        (num("2.0.0.0"), num("2.255.255.255"), "wide"),
    ]
    return spark.createDataFrame(rows, RANGES)


EXPECTED = [
    ("1.0.0.0", "A"), ("1.0.0.255", "A"), ("1.0.1.0", "one address"), ("1.0.1.1", None),
    ("1.0.254.255", None), ("1.0.255.0", "across an edge"), ("1.1.0.0", "across an edge"),
    ("1.1.0.255", "across an edge"), ("1.1.1.0", None), ("2.0.0.0", "wide"), ("2.255.255.255", "wide"),
    ("3.0.0.0", None), ("300.1.1.1", None), ("1.0.0", None), ("", None), (None, None),
]


@pytest.mark.parametrize("limit", [0, 10**9])
@pytest.mark.parametrize("bits", [4, 12, 16])
def test_range_ends_and_unmatched(spark, ranges, limit, bits):
    if bits == 4:  # narrow buckets suit narrow ranges
        ranges, expected = ranges.filter("city <> 'wide'"), [(i, c if c != "wide" else None) for i, c in EXPECTED]
    else:
        expected = EXPECTED
    visits = spark.createDataFrame([(ip,) for ip, _ in EXPECTED], "ip string")
    found = with_city(visits, measure_ranges(ranges, bits, limit))
    assert rows_of(found) == sorted(expected, key=lambda row: [(v is None, str(v)) for v in row])


def test_agrees_with_brute_force(spark):
    rng = random.Random(7)
    ends = sorted(rng.sample(range(0, 1 << 20), 400))
    table = [(lo, hi, f"c{lo}") for lo, hi in zip(ends[::2], ends[1::2])]
    ips = [rng.randrange(0, 1 << 20) for _ in range(500)]
    dotted = [".".join(str(n >> s & 255) for s in (24, 16, 8, 0)) for n in ips]
    expected = [next((c for lo, hi, c in table if lo <= n <= hi), None) for n in ips]
    found = with_city(
        spark.createDataFrame(list(enumerate(dotted)), "id int, ip string"), spark.createDataFrame(table, RANGES)
    )
    assert [r.city for r in found.orderBy("id").collect()] == expected


def test_only_a_measured_table_is_broadcast(spark, ranges):
    visits = spark.range(10).selectExpr("concat('1.0.0.', id) AS ip")
    small = plan_of(with_city(visits, measure_ranges(ranges)))
    assert "BroadcastHashJoin" in small and "BroadcastNestedLoopJoin" not in small
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan_of(with_city(visits, measure_ranges(ranges, broadcast_limit_bytes=0)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in large and "Broadcast" not in large


@pytest.mark.parametrize(
    "rows",
    [
        [(0, 10, "a"), (10, 20, "b")],
        [(0, 100000, "a"), (50000, 50001, "b")],
        [(0, 10, "a"), (0, 10, "a")],
        [(20, 10, "a")],
        [(None, 10, "a")],
        [(10, None, "a")],
    ],
)
def test_unsound_ranges_are_refused(spark, rows):
    with pytest.raises(ValueError):
        measure_ranges(spark.createDataFrame(rows, RANGES))


def test_touching_ranges_and_empty_table(spark):
    assert measure_ranges(spark.createDataFrame([(0, 10, "a"), (11, 20, "b")], RANGES)).rows == 2
    empty = measure_ranges(spark.createDataFrame([], RANGES))
    assert (empty.rows, empty.size_bytes) == (0, 0)
    visits = spark.createDataFrame([("1.1.1.1",)], "ip string")
    assert rows_of(with_city(visits, empty)) == [("1.1.1.1", None)]


def narrowest(table, n):
    inside = [(hi - lo, -lo, city is None, city or "") for lo, hi, city in table if lo <= n <= hi]
    found = min(inside, default=None)
    return found and (None if found[2] else found[3])


def dotted(n):
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


@pytest.mark.parametrize("span", [64, 1 << 20, 1 << 32])
def test_nested_ranges_take_the_most_specific(spark, span):
    rng = random.Random(span)
    table = [(0, span - 1, "all"), (0, span - 1, "again")]
    for k in range(150):
        lo = rng.randrange(span)
        table.append((lo, min(span - 1, lo + rng.randrange(1 + (span >> rng.randrange(1, 20)))), rng.choice([f"c{k}", "tie", None])))
    table += [(lo, hi, "copy") for lo, hi, _ in table[5:20]]
    ranges = spark.createDataFrame(table, RANGES)
    pieces = sorted((r.ip_lo, r.ip_hi, r.city) for r in most_specific_ranges(ranges).collect())
    assert all(lo <= hi for lo, hi, _ in pieces) and all(a[1] < b[0] for a, b in zip(pieces, pieces[1:]))
    places = sorted({max(0, min(span - 1, n + d)) for lo, hi, _ in table for n in (lo, hi) for d in (-1, 0, 1)} | {rng.randrange(span) for _ in range(200)})
    found = with_city(spark.createDataFrame([(n, dotted(n)) for n in places], "n bigint, ip string"), measure_ranges(ranges, 20, nested=True))
    assert {r.n: r.city for r in found.collect()} == {n: narrowest(table, n) for n in places}


def test_nested_ranges_without_sound_ends(spark):
    for bad in ((5, 3, "reversed"), (None, 3, "open"), (3, None, "open")):
        with pytest.raises(ValueError, match="without ends"):
            measure_ranges(spark.createDataFrame([(0, 9, "a"), bad], RANGES), nested=True)
    with pytest.raises(ValueError, match="overlapping"):
        measure_ranges(spark.createDataFrame([(0, 9, "a"), (2, 3, "b")], RANGES))
    assert most_specific_ranges(spark.createDataFrame([], RANGES)).count() == 0


def test_deep_nesting_makes_no_pairs(spark):
    """A thousand ranges inside each other: joins are of blocks, whose number grows with the ranges alone."""
    table = [(k, 1_000_000 - k, f"c{k}") for k in range(1000)]
    pieces = most_specific_ranges(spark.createDataFrame(table, RANGES))
    assert "NestedLoop" not in plan_of(pieces) and "Cartesian" not in plan_of(pieces)
    assert pieces.count() == 1999
