import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from playtrail.plans import start_live
from playtrail.plans.live import read_rows
from playtrail.plans.table_queries import payments_by_minute_daily
from playtrail.schema import TOPIC_MESSAGE
from playtrail.sources import kafka_options, read_topic_files
from playtrail.streaming import (
    add_sums,
    append_rows,
    exclude_listed,
    exclude_users,
    keep_daily,
    keep_snapshot,
    measure_blocklist,
    parse_downloads,
    parse_payments,
    read_daily,
    read_snapshot,
    rejected_messages,
    running_downloads,
    running_payments,
    sliding_downloads,
    sliding_payments,
    with_possible_members,
)
from playtrail.streaming.tables import replace_days
from tests.conftest import plan_of, rows_of

DOWNLOAD = '{"time":"20210417093559","user_id":31,"game_id":7}'
PAYMENT = (
    '{"flag":"1","order_id":"a1","fee":46,"time":"20210417093559","user_id":31,"game_id":7}'
)


def messages(spark, *values, topic="t"):
    return spark.createDataFrame([(topic, v) for v in values], TOPIC_MESSAGE)


def download(time, user=1):
    return json.dumps({"time": time, "user_id": user, "game_id": 1})


def payment(time, fee, flag="1", user=1):
    return json.dumps({"flag": flag, "order_id": "o", "fee": fee, "time": time, "user_id": user, "game_id": 1})


class Topic:
    """A folder of message files that grows batch by batch."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.runs = spark, str(folder), Path(str(folder) + "-out")

    def send(self, *values, topic="t"):
        messages(self.spark, *values, topic=topic).coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self):
        return read_topic_files(self.spark, self.folder, 1)

    def run(self, start, rows, name="table"):
        path = str(self.runs / name)
        query = start(rows, path, str(self.runs / f"{name}-checkpoint"), available_now=True)
        query.awaitTermination()
        return path


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "messages")


def test_parse_samples(spark):
    row = parse_downloads(messages(spark, DOWNLOAD)).first()
    assert (row.day, row.hour, row.minute, row.user_id, row.game_id) == ("20210417", "09", "35", 31, 7)
    assert str(row.event_time) == "2021-04-17 09:35:59"
    row = parse_payments(messages(spark, PAYMENT)).first()
    assert (row.order_id, row.paid, row.fee, row.user_id) == ("a1", 1, 46, 31)


@pytest.mark.parametrize(
    "value,paid,fee",
    [
        (PAYMENT.replace('"1"', '"0"'), 0, 46),
        (PAYMENT.replace('"1"', "1"), 1, 46),
        (PAYMENT.replace('"flag":"1",', ""), 0, 46),
        (PAYMENT.replace("46", '"46"'), 1, 46),
        (PAYMENT.replace('"fee":46,', ""), 1, 0),
        (PAYMENT.replace("46", "5000000000"), 1, 5000000000),
    ],
)
def test_payment_variants(spark, value, paid, fee):
    row = parse_payments(messages(spark, value)).first()
    assert (row.paid, row.fee) == (paid, fee)


def test_messages_that_do_not_count_are_kept_apart(spark):
    bad = {
        "no json": "unreadable time",
        "": "unreadable time",
        PAYMENT.replace("20210417093559", "20211317093559"): "unreadable time",
        PAYMENT.replace('"time":"20210417093559",', ""): "unreadable time",
        PAYMENT.replace('"user_id":31,', ""): "unreadable user",
        PAYMENT.replace("31", '"x"'): "unreadable user",
        PAYMENT.replace("46", '"free"'): "unreadable fee",
    }
    all_messages = messages(spark, PAYMENT, *bad)
    rejects = rejected_messages(all_messages, "t", payment=True)
    assert {r.value: r.reason for r in rejects.collect()} == bad
    assert parse_payments(all_messages).count() == 1
    # A download has no fee to be wrong.
    assert parse_downloads(all_messages).count() == 2


def test_topics_are_kept_apart(spark):
    both = messages(spark, DOWNLOAD, topic="a").union(messages(spark, PAYMENT, PAYMENT, topic="b"))
    assert parse_downloads(both, "a").count() == 1 and parse_payments(both, "b").count() == 2
    assert parse_downloads(both).count() == 3


def test_json_is_parsed_once(spark):
    plan = plan_of(running_payments(parse_payments(messages(spark, PAYMENT), "t")))
    assert plan.count("from_json") == 1


TIMES = ["20210417093559", "20210417093600", "20210417100000", "20210418093559", "20210417093559"]


@pytest.mark.parametrize(
    "grain,pooled,expected",
    [
        ("day", False, {"20210417": 4, "20210418": 1}),
        ("hour", False, {"2021041709": 3, "2021041710": 1, "2021041809": 1}),
        ("minute", False, {"202104170935": 2, "202104170936": 1, "202104171000": 1, "202104180935": 1}),
        ("day", True, {"20210417": 4, "20210418": 1}),
        ("hour", True, {"09": 4, "10": 1}),
        ("minute", True, {"35": 3, "36": 1, "00": 1}),
    ],
)
def test_totals_of_every_grain(spark, grain, pooled, expected):
    found = running_downloads(parse_downloads(messages(spark, *map(download, TIMES))), grain, pooled)
    assert {r.bucket: r.downloads for r in found.collect()} == expected
    if not pooled:
        windowed = running_downloads(parse_downloads(messages(spark, *map(download, TIMES))), grain, watermark="1 hour")
        assert {r.bucket: r.downloads for r in windowed.collect()} == expected


def test_payment_sums_count_orders_from_zero_and_keep_unpaid_fees_apart(spark):
    values = [payment("20210417093559", 10), payment("20210417093559", 5, "0"), payment("20210418000000", 1)]
    found = running_payments(parse_payments(messages(spark, *values)))
    assert rows_of(found) == [("20210417", 2, 1, 15, 10), ("20210418", 1, 1, 1, 1)]


def test_pooled_buckets_have_no_watermark(spark):
    with pytest.raises(ValueError):
        running_downloads(parse_downloads(messages(spark, DOWNLOAD)), "hour", pooled=True, watermark="1 hour")


def test_sliding_windows_hold_edges_once(spark):
    times = ["20210417093500", "20210417093504", "20210417093505", "20210417093509"]
    found = sliding_downloads(parse_downloads(messages(spark, *map(download, times))))
    assert {str(r.window_start)[-8:]: (str(r.window_end)[-8:], r.downloads) for r in found.collect()} == {
        "09:34:55": ("09:35:05", 2), "09:35:00": ("09:35:10", 4), "09:35:05": ("09:35:15", 2),
    }
    sums = sliding_payments(parse_payments(messages(spark, payment("20210417093500", 7, "0"))))
    assert [tuple(r)[2:] for r in sums.collect()] == [(1, 0, 7, 0)] * 2


def forget_last_commit(topic):
    """As if the driver was lost after the last write and before its batch was marked as done."""
    commits = topic.runs / "table-checkpoint" / "commits"
    last = max((f for f in commits.iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
    last.unlink()
    (commits / f".{last.name}.crc").unlink(missing_ok=True)


@pytest.mark.parametrize("watermark", [None, "2 days"])
def test_daily_table_changes_only_the_days_of_a_batch(spark, topic, watermark):
    def totals():
        rows = running_downloads(parse_downloads(topic.stream()), "hour", watermark=watermark)
        return dict(rows_of(read_daily(spark, topic.run(keep_daily, rows))))

    topic.send(download("20210417093559"), download("20210418000000"))
    assert totals() == {"2021041709": 1, "2021041800": 1}
    untouched = sorted((topic.runs / "table" / "day=20210418").rglob("*.parquet"))
    topic.send(download("20210417093559"), download("20210417103559"))
    topic.send(download("20210417093559"), download("20210419000000"))
    expected = {"2021041709": 3, "2021041710": 1, "2021041800": 1, "2021041900": 1}
    assert totals() == expected
    assert sorted((topic.runs / "table" / "day=20210418").rglob("*.parquet")) == untouched
    forget_last_commit(topic)
    assert totals() == expected
    topic.send(download("20210417113559"))
    assert totals() == {**expected, "2021041711": 1}


def test_stream_totals_grow_over_batches_and_restarts(spark, topic):
    topic.send(download("20210417093559"), download("20210418000000"))
    topic.send(download("20210417093559"))  # one key again, the other without news

    def totals():
        rows = running_downloads(parse_downloads(topic.stream()))
        return dict(rows_of(read_snapshot(spark, topic.run(keep_snapshot, rows))))

    assert totals() == {"20210417": 2, "20210418": 1}
    topic.send(download("20210418120000"), download("20210419000000"))
    assert totals() == {"20210417": 2, "20210418": 2, "20210419": 1}
    assert totals() == {"20210417": 2, "20210418": 2, "20210419": 1}  # nothing new


def test_repeated_batch_counts_once(spark, topic):
    topic.send(payment("20210417093559", 10))
    topic.send(payment("20210417093559", 5, "0"))

    def totals():
        rows = running_payments(parse_payments(topic.stream()))
        return rows_of(read_snapshot(spark, topic.run(keep_snapshot, rows)))

    expected = [("20210417", 2, 1, 15, 10)]
    assert totals() == expected
    forget_last_commit(topic)
    assert totals() == expected


def test_broken_off_snapshot_is_not_read(spark, topic):
    for _ in range(3):
        topic.send(download("20210417093559"))
    path = topic.run(keep_snapshot, running_downloads(parse_downloads(topic.stream())))
    assert rows_of(read_snapshot(spark, path)) == [("20210417", 3)]
    # The next batch has written some of its rows, but not its mark.
    half = spark.createDataFrame([("20210417", 99, 3)], "bucket string, downloads bigint, batch_id bigint")
    half.write.mode("overwrite").parquet(f"{path}/rows/slot=1")
    assert rows_of(read_snapshot(spark, path)) == [("20210417", 3)]


def test_watermarked_buckets_need_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        with pytest.raises(ValueError, match="UTC"):
            running_downloads(parse_downloads(messages(spark, DOWNLOAD)), "day", watermark="1 hour")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("salt", [1, 4])
def test_blocked_users_are_left_out(spark, salt):
    events = parse_downloads(messages(spark, *[download("20210417093559", u) for u in (1, 1, 2, 3, 3)]))
    blocked = spark.createDataFrame([(1,), (1,), (9,)], "user_id int")
    kept = exclude_users(events, blocked, salt)
    assert kept.columns == events.columns
    assert sorted(r.user_id for r in kept.collect()) == [2, 3, 3]
    assert exclude_users(events, blocked.limit(0), salt).count() == 5


@pytest.mark.parametrize("max_bytes", [1 << 12, 1 << 25])
def test_a_long_blocklist_shuffles_few_events(spark, max_bytes):
    """The filter lets every listed user through, and with room enough few others; results are exact either way."""
    blocked = spark.range(0, 20_000, 2).select(F.col("id").alias("user_id")).hint("merge")
    blocked = blocked.unionByName(spark.createDataFrame([(None,), (2**62,), (-5,)], "user_id bigint"))
    users = spark.range(100_000, 160_000).unionByName(spark.range(0, 400)).unionByName(spark.createDataFrame([(2**62,), (-5,), (-7,)], "id bigint"))
    events = users.select(F.col("id").alias("user_id"), F.lit("x").alias("time"))
    listed = measure_blocklist(blocked, max_bytes)
    told = with_possible_members(events, listed)
    possible = told.where("possible").count()
    assert told.count() == events.count() and (possible < 8000 if max_bytes > 1 << 12 else possible > 8000)
    kept = exclude_listed(events, listed)
    assert kept.columns == events.columns
    assert sorted(r.user_id for r in kept.collect()) == sorted(r.user_id for r in exclude_users(events, blocked).collect())
    certain = told.where(~F.col("possible"))
    assert "hashpartitioning(user_id" not in plan_of(certain) and "BroadcastHashJoin" in plan_of(certain)


def test_new_blocked_users_count_from_the_next_batch(spark, topic, tmp_path):
    blocked_path = str(tmp_path / "blocked")
    spark.createDataFrame([(1,)], "user_id bigint").write.parquet(blocked_path)

    def kept():
        blocked = spark.read.schema("user_id bigint").parquet(blocked_path)
        rows = exclude_users(parse_downloads(topic.stream()), blocked).select("user_id")
        return sorted(r.user_id for r in spark.read.parquet(topic.run(append_rows, rows)).collect())

    topic.send(download("20210417093559", 1), download("20210417093559", 2))
    assert kept() == [2]
    spark.createDataFrame([(2,)], "user_id bigint").write.mode("append").parquet(blocked_path)
    topic.send(download("20210417093559", 2), download("20210417093559", 3))
    assert kept() == [2, 3]


def test_closed_windows_are_appended_once_and_late_events_dropped(spark, topic):
    def totals():
        rows = running_downloads(parse_downloads(topic.stream()), "minute", watermark="1 minute")
        return rows_of(spark.read.parquet(topic.run(append_rows, rows)))

    topic.send(download("20210417093501"))
    topic.send(download("20210417093502"), download("20210417094000"))
    assert totals() == [("202104170935", 2)]
    topic.send(download("20210417093503"), download("20210417095000"))
    assert totals() == [("202104170935", 2), ("202104170940", 1)]


@pytest.mark.parametrize("pooled", [False, True])
def test_live_run_fills_every_table_from_one_read(spark, topic, tmp_path, pooled):
    topic.send(download("20210417093559", 1), download("20210417093559", 5), "broken", topic="down")
    topic.send(payment("20210417093559", 10, user=1), payment("20210417094559", 3, user=5), topic="pay")
    blocked = spark.createDataFrame([(1,)], "user_id bigint")
    root = str(tmp_path / "live")

    def run():
        query = start_live(
            topic.stream(), blocked, root, str(tmp_path / "checkpoints"), "down", "pay", "hour", pooled, available_now=True
        )
        assert [q.id for q in spark.streams.active] in ([query.id], [])
        query.awaitTermination()

    def daily(name):
        return rows_of(read_daily(spark, f"{root}/{name}"))

    run()
    bucket = "09" if pooled else "2021041709"
    assert daily("downloads") == [(bucket, 2)]
    assert daily("payments") == [(bucket, 2, 2, 13, 13)]
    assert daily("downloads_not_blocked_totals") == [(bucket, 1)]
    assert daily("payments_not_blocked_totals") == [(bucket, 1, 1, 3, 3)]
    assert [r.user_id for r in read_rows(spark, f"{root}/downloads_not_blocked").collect()] == [5]
    assert [r.fee for r in read_rows(spark, f"{root}/payments_not_blocked").collect()] == [3]
    assert [r.value for r in read_rows(spark, f"{root}/downloads_rejected").collect()] == ["broken"]
    # All windows are there when the run ends, also those of the newest event.
    assert len(daily("payments_sliding")) == 4 and len(daily("downloads_sliding")) == 2
    # An event that comes days late still counts, in its own day.
    topic.send(download("20210412093559", 5), download("20210417093559", 5), topic="down")
    run()
    assert daily("downloads") == ([(bucket, 4)] if pooled else [("2021041209", 1), (bucket, 3)])
    assert sum(row[2] for row in daily("downloads_sliding")) == 8


def test_a_repeated_batch_adds_nothing_twice(spark, tmp_path):
    path = str(tmp_path / "sums")

    def sums(*rows):
        return spark.createDataFrame(list(rows), "bucket string, downloads bigint")

    add_sums(sums(("2021041709", 2), ("2021041809", 1)), 0, path)
    for _ in range(3):
        add_sums(sums(("2021041709", 5)), 1, path)
        assert rows_of(read_daily(spark, path)) == [("2021041709", 7), ("2021041809", 1)]
    add_sums(sums(("2021041710", 1)), 2, path)
    assert rows_of(read_daily(spark, path)) == [("2021041709", 7), ("2021041710", 1), ("2021041809", 1)]


def test_a_batch_opens_only_its_days(spark, tmp_path):
    path = str(tmp_path / "sums")
    days = spark.range(20).selectExpr("cast(20210412 + id AS string) AS bucket", "id AS downloads")
    add_sums(days, 0, path)
    plans = []

    def merge(earlier, changed):
        plans.append(plan_of(earlier))
        return earlier.select(*changed.columns).limit(0).unionByName(changed)

    replace_days(days.limit(1).withColumn("day", F.col("bucket")), 1, path, merge, ("bucket",))
    assert "dynamicpruning" in plans[0].lower() and "Window" not in plans[0]
    assert read_daily(spark, path).count() == 20


def test_kafka_options():
    assert kafka_options("h:9092", ["a", "b"], "g", max_offsets_per_trigger=10) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "a,b", "startingOffsets": "latest",
        "kafka.group.id": "g", "maxOffsetsPerTrigger": "10",
    }


def test_daily_payments_of_events_over_years(spark, tmp_path):
    """The newest event comes first: none of the older ones is behind the watermark."""
    days = F.when(F.col("id") < 3, 900).otherwise(F.col("id") * 30)
    ts = (F.lit("2024-01-01 10:00:00").cast("timestamp") + F.make_dt_interval(days)).alias("ts")
    rest = [F.lit(7).cast("bigint").alias("user_id"), F.lit("purchase").alias("event_type"), F.lit(2.0).alias("value"), F.lit('{"k": 3}').alias("props")]
    events = spark.range(30).coalesce(1).select(F.col("id").alias("event_id"), ts, *rest)
    events.write.parquet(f"{tmp_path}/events.parquet")
    found = payments_by_minute_daily(spark, str(tmp_path))
    assert found.agg(F.sum("orders")).first()[0] == 30
