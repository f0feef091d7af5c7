"""The tables of a streaming run: batches that show as a whole, totals kept as changes, windows made of panes."""

import pytest
from pyspark.sql import functions as F

from playtrail.plans import start_live
from playtrail.plans.live import ROW_TABLES, TOTAL_TABLES, read_rows
from playtrail.schema import TOPIC_MESSAGE
from playtrail.streaming import (
    flag_blocked,
    keep_totals,
    newest_batch,
    parse_downloads,
    parse_messages,
    parse_payments,
    read_daily,
    read_totals,
    read_windows,
    rejected_messages,
    running_payments,
    sliding_payments,
)
from playtrail.streaming.runs import changes_of, fold, write_batch
from tests.conftest import plan_of, rows_of
from tests.test_streaming import Topic, download, forget_last_commit, messages, payment



def payments_changes(events):
    return changes_of(events, F.array(F.lit("payments")))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "messages")


def paid_events(spark, *values):
    return parse_payments(messages(spark, *values))


def at_many_times(n=300):
    """Orders over three days, some within the same seconds."""
    return [payment(f"202104{17 + k % 3}{k * 7 % 24:02}{k * 11 % 60:02}{k * 13 % 60:02}", k, str(k % 2)) for k in range(n)]


@pytest.mark.parametrize("fold_every", [1, 2, 50])
def test_every_grain_of_one_run(spark, tmp_path, fold_every):
    values, root = at_many_times(), str(tmp_path / "run")
    for k in range(5):
        write_batch(spark, root, k, payments_changes(paid_events(spark, *values[k::5])), fold_every=fold_every)
    events = paid_events(spark, *values)
    for grain, pooled in (("day", False), ("hour", False), ("minute", False), ("hour", True), ("minute", True)):
        assert rows_of(read_totals(spark, root, "payments", grain, pooled)) == rows_of(running_payments(events, grain, pooled))
    for length, slide in ((10, 5), (60, 20), (5, 5), (5, 15), (20, 15)):
        expected = sliding_payments(events, f"{length} seconds", f"{slide} seconds") if length >= slide else None
        found = rows_of(read_windows(spark, root, "payments", length, slide))
        if expected is not None:
            assert found == rows_of(expected)
        else:
            assert sum(row[2] for row in found) == sum(int(v.split('"time": "')[1][12:14]) % slide < length for v in values)
    one_day = read_totals(spark, root, "payments", "hour", days=["20210418"])
    assert rows_of(one_day) == [row for row in rows_of(running_payments(events, "hour")) if row[0].startswith("20210418")]


def test_windows_are_made_of_panes_of_half_as_many_rows(spark, tmp_path):
    root, values = str(tmp_path / "run"), at_many_times(200)
    write_batch(spark, root, 0, payments_changes(paid_events(spark, *values)))
    panes = spark.read.parquet(f"{root}/changes").where("grain = 'pane'")
    assert 2 * panes.count() == read_windows(spark, root, "payments").count() + sum(
        1 for a, b in zip(*[sorted(r.start for r in panes.collect())[k:] for k in (0, 1)], strict=False) if b - a == 5
    )
    with pytest.raises(ValueError, match="multiples"):
        read_windows(spark, root, "payments", 7, 5)


def test_a_batch_that_breaks_off_between_two_tables_shows_in_none(spark, tmp_path):
    root = str(tmp_path / "run")

    def batch(*values):
        events = paid_events(spark, *values)
        return payments_changes(events), events.select("order_id", "fee", F.lit("open").alias("table"))

    def seen():
        rows = read_rows_of(spark, root)
        return rows, rows_of(read_totals(spark, root, "payments")), rows_of(read_windows(spark, root, "payments"))

    changes, rows = batch(payment("20210417093559", 10))
    write_batch(spark, root, 0, changes, rows)
    before = seen()
    changes, rows = batch(payment("20210417093601", 5))
    broken = changes.withColumn("events", F.when(F.col("events") > 0, F.raise_error("lost").cast("bigint")))
    with pytest.raises(Exception, match="lost"):
        write_batch(spark, root, 1, broken, rows)
    # Its rows are written, but nothing of the batch shows.
    assert spark.read.parquet(f"{root}/rows").count() == 2
    assert seen() == before and newest_batch(spark, root) == 0
    assert write_batch(spark, root, 1, changes, rows)
    rows_after, totals, windows = seen()
    assert rows_after == [5, 10] and totals == [("20210417", 2, 2, 15, 15)] and len(windows) == 3
    # A whole batch is not written twice, and one of another run not at all.
    assert not write_batch(spark, root, 1, changes, rows)
    assert seen() == (rows_after, totals, windows)
    with pytest.raises(ValueError, match="checkpoint"):
        write_batch(spark, root, 0, changes, rows)


def read_rows_of(spark, root):
    rows = spark.read.parquet(f"{root}/rows").where(F.col("batch") <= newest_batch(spark, root))
    return sorted(r.fee for r in rows.collect())


def test_a_folding_touches_only_its_days_and_can_break_off(spark, tmp_path):
    root = str(tmp_path / "run")
    base = tmp_path / "run" / "base"

    def add(batch_id, *days):
        values = [payment(f"{day}093559", 1) for day in days]
        write_batch(spark, root, batch_id, payments_changes(paid_events(spark, *values)), fold_every=1000)

    def totals():
        return {r.bucket: r.orders for r in read_totals(spark, root, "payments").collect()}

    add(0, "20210417", "20210418")
    fold(spark, root)
    fold(spark, root)  # nothing new
    untouched = sorted((base / "day=20210418").rglob("*.parquet"))
    add(1, "20210417")
    # A folding that broke off: a folder without its mark.
    half = spark.read.parquet(str(base / "day=20210417" / "upto=0"))
    half.withColumn("events", F.lit(99).cast("bigint")).write.parquet(str(base / "day=20210417" / "upto=1"))
    assert totals() == {"20210417": 2, "20210418": 1}
    add(2, "20210417", "20210419")
    fold(spark, root)
    assert totals() == {"20210417": 3, "20210418": 1, "20210419": 1}
    assert sorted((base / "day=20210418").rglob("*.parquet")) == untouched
    for k in range(3, 7):
        add(k, "20210417")
        fold(spark, root)
    assert totals() == {"20210417": 7, "20210418": 1, "20210419": 1}
    # Only what the newest states need is left.
    assert len(list((base / "day=20210417").iterdir())) <= 3
    assert len(list((tmp_path / "run" / "changes").glob("batch=*"))) <= 2
    assert len([f for f in (tmp_path / "run" / "marks").iterdir() if f.name.isdigit()]) == 2


def test_streamed_totals_after_restarts_and_repeated_batches(spark, topic):
    def totals():
        root = topic.run(lambda rows, path, checkpoint, available_now: keep_totals(rows, "downloads", path, checkpoint, available_now=available_now, fold_every=2), parse_downloads(topic.stream()))
        return rows_of(read_totals(spark, root, "downloads", "hour")), read_windows(spark, root, "downloads").count()

    topic.send(download("20210417093559"), download("20210418000000"))
    topic.send(download("20210417093559"))
    assert totals() == ([("2021041709", 2), ("2021041800", 1)], 4)
    forget_last_commit(topic)
    assert totals() == ([("2021041709", 2), ("2021041800", 1)], 4)
    topic.send(download("20200101000000"))  # very late
    assert totals() == ([("2020010100", 1), ("2021041709", 2), ("2021041800", 1)], 6)


def test_a_run_before_its_first_batch(spark, tmp_path):
    root = str(tmp_path / "run")
    assert newest_batch(spark, root) == -1
    assert read_totals(spark, root, "downloads").count() == 0 and read_windows(spark, root, "downloads").count() == 0
    write_batch(spark, root, 0, payments_changes(paid_events(spark, "broken")))
    assert read_totals(spark, root, "payments", "minute").count() == 0


def test_messages_of_both_topics_are_parsed_as_apart(spark):
    values = [download("20210417093559"), payment("20210417093559", 7), "no json", payment("20210417093559", "free"), payment("20211317093559", 1)]
    both = spark.createDataFrame([(topic, value) for topic in "dpx" for value in values], TOPIC_MESSAGE)
    parsed = parse_messages(both, "d", "p")
    fine = parsed.where("reason is null")
    for kind, topic_name, parse in (("downloads", "d", parse_downloads), ("payments", "p", parse_payments)):
        expected = parse(both, topic_name)
        assert rows_of(fine.where(F.col("kind") == kind).select(*expected.columns)) == rows_of(expected)
        bad = rejected_messages(both, topic_name, kind == "payments")
        assert rows_of(parsed.where((F.col("kind") == kind) & F.col("reason").isNotNull()).select(*bad.columns)) == rows_of(bad)
    assert plan_of(parsed).count("from_json") == 1


@pytest.mark.parametrize("salt", [1, 4])
def test_blocked_users_are_flagged(spark, salt):
    events = parse_downloads(messages(spark, *[download("20210417093559", u) for u in (1, 1, 2, 3, 3)]))
    blocked = spark.createDataFrame([(1,), (1,), (9,)], "user_id int")
    found = flag_blocked(events, blocked, salt)
    assert found.columns == [*events.columns, "blocked"]
    assert sorted((r.user_id, r.blocked) for r in found.collect()) == [(1, True), (1, True), (2, False), (3, False), (3, False)]


def test_a_live_run_whose_batch_breaks_off(spark, topic, tmp_path, monkeypatch):
    """The second batch loses its driver between rows and totals; the restart repeats it."""
    root, checkpoints = str(tmp_path / "live"), str(tmp_path / "checkpoints")
    blocked = spark.createDataFrame([(1,)], "user_id bigint")

    def run():
        start_live(topic.stream(), blocked, root, checkpoints, "down", "pay", "hour", available_now=True).awaitTermination()

    def seen():
        rows = {name: rows_of(read_rows(spark, f"{root}/{name}")) for name in ROW_TABLES}
        return rows | {name: rows_of(read_daily(spark, f"{root}/{name}")) for name in TOTAL_TABLES}

    topic.send(download("20210417093559", 1), download("20210417093559", 5), "broken", topic="down")
    topic.send(payment("20210417093559", 3, user=5), "broken", topic="pay")
    run()
    before = seen()
    topic.send(download("20210417093600", 5), "broken too", topic="down")

    def lost(*args, **kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr("playtrail.streaming.runs._set_mark", lost)
        with pytest.raises(Exception, match="driver lost"):
            run()
    assert seen() == before
    run()
    after = seen()
    assert after["downloads"] == [("2021041709", 3)] and after["payments"] == before["payments"]
    assert len(after["downloads_not_blocked"]) == 2 and len(after["downloads_rejected"]) == 2


def test_a_batch_needs_two_writes(spark, tmp_path):
    """What a batch costs doesn't grow with what is stored: two write jobs, and no read of earlier totals."""
    root = str(tmp_path / "run")
    paths = []
    for k in range(3):
        changes = payments_changes(paid_events(spark, payment("20210417093559", 1)))
        write_batch(spark, root, k, changes)
        paths.append(sorted(p.name for p in (tmp_path / "run" / "changes").iterdir() if p.name.startswith("batch=")))
    assert paths[-1] == ["batch=0", "batch=1", "batch=2"]
    assert "FileScan" not in plan_of(changes)
