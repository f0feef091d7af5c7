"""Tables kept by ranges of their key: even files, and reads that open few of them."""

import os

import pytest
from pyspark.sql import functions as F

from playtrail.sinks import key_range_files, read_key_range, write_key_ranges
from tests.conftest import rows_of

SCHEMA = "row_key string, n bigint"


@pytest.fixture
def rows(spark):
    """A third of the rows share one key."""
    key = F.when(F.col("id") % 3 == 0, "k5000").otherwise(F.format_string("k%04d", F.col("id") % 9973))
    return spark.range(30_000).select(key.alias("row_key"), F.col("id").alias("n")).repartition(5)


def test_a_heavy_key_leaves_files_even_and_sorted(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    write_key_ranges(rows, path, files=12)
    bounds = sorted(spark.read.parquet(f"{path}/bounds").collect(), key=lambda r: (r.first, r.last, r.file))
    assert sum(r.rows for r in bounds) == 30_000 and len(bounds) == 12
    assert max(r.rows for r in bounds) < 1.6 * 30_000 / 12
    assert all(a.last <= b.first for a, b in zip(bounds, bounds[1:]))
    assert sum(r.first <= "k5000" <= r.last for r in bounds) >= 4


def test_a_range_opens_its_files_only(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    write_key_ranges(rows, path, files=12)
    for low, high in (("k0100", "k0200"), ("k5000", "k5000"), (None, "k0001"), ("k9", None), ("a", "b"), (None, None)):
        expected = rows
        if low is not None:
            expected = expected.where(F.col("row_key") >= low)
        if high is not None:
            expected = expected.where(F.col("row_key") <= high)
        found = read_key_range(spark, path, SCHEMA, low, high)
        assert rows_of(found) == rows_of(expected)
    assert len(key_range_files(spark, path, "k0100", "k0200")) <= 2
    assert len(read_key_range(spark, path, SCHEMA, "k0100", "k0200").inputFiles()) <= 2


def test_writing_again_replaces_and_other_cases(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    for part in (rows, rows.limit(0), spark.createDataFrame([(None, 1), ("a", 2), ("a", 2), (None, 3)], SCHEMA)):
        write_key_ranges(part, path, files=3)
        assert rows_of(read_key_range(spark, path, SCHEMA)) == rows_of(part)
        assert len([d for d in os.listdir(f"{path}/rows") if d.startswith("version=")]) == 1
    assert rows_of(read_key_range(spark, path, SCHEMA, "a", "a")) == [("a", 2), ("a", 2)]
    numbers = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    write_key_ranges(numbers, path, "k", 4)
    assert read_key_range(spark, path, numbers.schema, 10, 19, "k").count() == 10
