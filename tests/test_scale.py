"""What must hold when one key has a third of all rows: same results, and no task that gets them all."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from playtrail.operators import measure_ranges, top_games_by_city, with_city
from playtrail.operators.keyed import BROWSE_KEY, latest_per_key, upsert
from playtrail.sinks.keyed_table import touched_days
from playtrail.streaming import exclude_users, running_downloads
from tests.conftest import plan_of, rows_of

ROWS = 60_000


@contextmanager
def settings(spark, **values):
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


SHUFFLED = {
    "spark__sql__shuffle__partitions": "64",
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "16KB",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "16KB",
}


@pytest.fixture(scope="module")
def ranges(spark):
    rows = [((10 << 24) + i * 65536, (10 << 24) + (i + 1) * 65536 - 1, f"c{i}") for i in range(200)]
    return spark.createDataFrame(rows, "ip_lo bigint, ip_hi bigint, city string")


@pytest.fixture(scope="module")
def visits(spark):
    """A third of the visits come from one address, a third from unreadable ones."""
    ip = (
        F.when(F.col("id") % 3 == 0, "10.7.7.7")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("10."), (F.col("id") % 200).cast("string"), F.lit(".0.1")))
        .otherwise(F.concat(F.lit("host-"), F.col("id").cast("string")))
    )
    return spark.range(0, ROWS, 1, 8).select(
        "id", ip.alias("ip"), (F.col("id") % 5).cast("int").alias("gameId"), F.lit("g").alias("gameName"),
    )


def test_busy_address_is_split_in_a_shuffled_lookup(spark, visits, ranges):
    expected = rows_of(with_city(visits, ranges).groupBy("city").count())
    with settings(spark, **SHUFFLED):
        located = with_city(visits, measure_ranges(ranges, broadcast_limit_bytes=0))
        assert located.select("id").distinct().count() == located.count() == ROWS
        assert rows_of(located.groupBy("city").count()) == expected
        located.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(located)


def test_city_report_counts_per_address_before_a_shuffled_lookup(spark, visits, ranges):
    expected = rows_of(top_games_by_city(visits, ranges))
    with settings(spark, **SHUFFLED):
        report = top_games_by_city(visits, measure_ranges(ranges, broadcast_limit_bytes=0))
        below_join = plan_of(report).split("SortMergeJoin")[1]
        assert "HashAggregate(keys=[ip" in below_join
        assert rows_of(report) == expected


def test_copies_of_one_key_collapse(spark):
    one_key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    df = spark.range(0, ROWS, 1, 8).select(
        F.lit("201801010101").alias("date"), F.lit("1.1.1.1").alias("ip"), one_key.cast("int").alias("gameId"),
        F.col("id").alias("seq"),
    )
    found = latest_per_key(df, BROWSE_KEY, ["seq"])
    assert found.count() == ROWS - ROWS // 3 + 1
    assert found.filter("gameId = 0").first().seq == ROWS - 3
    halves = upsert(df.filter("id % 2 = 0"), df.filter("id % 2 = 1"), BROWSE_KEY, ["seq"])
    assert halves.exceptAll(found).count() == 0 and halves.count() == found.count()


@pytest.mark.parametrize("salt", [1, 8])
def test_busy_user_and_long_blocklist(spark, salt):
    user = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 1000 + 2)
    events = spark.range(0, ROWS, 1, 8).select(user.cast("bigint").alias("user_id"), F.lit("20180101010101").alias("time"))
    blocked = spark.range(0, 1000, 2).withColumnRenamed("id", "user_id")
    with settings(spark, **SHUFFLED):
        kept = exclude_users(events, blocked, salt)
        assert kept.filter("user_id % 2 = 0 AND user_id < 1000").count() == 0
        assert kept.filter("user_id = 1").count() == ROWS // 3
        totals = running_downloads(kept)
        assert "partial_count" in plan_of(totals)
        expected = events.filter("user_id % 2 = 1 OR user_id >= 1000").count()
        assert rows_of(totals) == [("20180101", expected)]


def test_merge_opens_only_touched_days(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(20).selectExpr("id", "cast(20180101 + id AS string) AS day")
    days.write.partitionBy("day").parquet(path)
    stored, updates = spark.read.schema("id bigint, day string").parquet(path), days.filter("id < 3")
    touched = touched_days(stored, updates)
    assert "dynamicpruning" in plan_of(touched).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert rows_of(touched.select("id", "day")) == rows_of(updates)


def test_busy_user_of_one_input_partition_is_spread(spark):
    events = spark.range(0, ROWS, 1, 1).select(F.lit(1).cast("bigint").alias("user_id"), "id")
    blocked = spark.range(5, 1000).withColumnRenamed("id", "user_id")
    with settings(spark, **SHUFFLED, spark__sql__adaptive__enabled="false"):
        kept = exclude_users(events, blocked, 8)
        shares = [r["n"] for r in kept.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(shares) == ROWS and len(shares) > 1 and max(shares) < 0.7 * ROWS
