"""A log that grows by new files: each is parsed once, reports come from its counts."""

import os
import time

import pytest

from playtrail.operators import (
    games_by_city_from_counts,
    games_by_month_from_counts,
    hours_from_counts,
    phone_model_times,
    phone_models_from_counts,
    top_games_by_city,
    top_games_by_month,
    visits_by_hour,
)
from playtrail.sinks import add_new_files, read_counts, read_growing_log, read_ledger
from playtrail.sources import read_browse_log
from tests.conftest import plan_of, rows_of

RANGES = "ip_lo bigint, ip_hi bigint, city string"


def line(day, k=0, hour=22):
    return f"10.0.0.{k % 7}\t[{day} {hour:02}:31:47]\t(Android 8,model{k % 3})\tgame {k % 4}\t{k % 4}"


@pytest.fixture
def log(spark, tmp_path):
    class Log:
        source, target = str(tmp_path / "text"), str(tmp_path / "log")

        def put(self, name, *lines):
            path = tmp_path / "text" / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text("".join(text + "\n" for text in lines))

        def add(self):
            return add_new_files(spark, self.source, self.target)

    return Log()


def all_reports(spark, log):
    rows = read_browse_log(spark, f"{log.source}/*")
    ranges = spark.createDataFrame([(167772160, 167772162, "A"), (167772164, 167772165, "B")], RANGES)
    games = read_counts(spark, log.target, "games")
    for n in (None, 2):
        assert rows_of(games_by_month_from_counts(games, 3, n)) == rows_of(top_games_by_month(rows, 3, n))
        assert rows_of(games_by_city_from_counts(games, ranges, n)) == rows_of(top_games_by_city(rows, ranges, n))
        assert rows_of(phone_models_from_counts(read_counts(spark, log.target, "phone_models"), n)) == rows_of(phone_model_times(rows, n))
    assert rows_of(games_by_month_from_counts(games, 3, year=2017)) == rows_of(top_games_by_month(rows, 3, year=2017))
    assert rows_of(games_by_city_from_counts(games, ranges, drop_unmatched=True)) == rows_of(top_games_by_city(rows, ranges, drop_unmatched=True))
    assert rows_of(hours_from_counts(read_counts(spark, log.target, "hours"))) == rows_of(visits_by_hour(rows))
    assert rows_of(read_growing_log(spark, log.target).drop("year", "month")) == rows_of(rows)


def test_only_new_files_are_parsed_and_reports_add_up(spark, log):
    log.put("a.txt", *[line("2018-03-05", k) for k in range(20)], "broken")
    log.put("b.txt", *[line("2017-03-31", k, 3) for k in range(9)])
    assert log.add() == 2 and log.add() == 0
    all_reports(spark, log)
    first_files = {f: os.stat(f).st_mtime_ns for f in read_growing_log(spark, log.target).inputFiles() for f in [f.removeprefix("file://")]}
    log.put("c.txt", *[line("2018-03-05", k, 1) for k in range(5)], *[line("2018-04-01", k) for k in range(4)])  # a day again, and a new one
    log.put("d.txt")  # empty: nothing to parse yet
    assert log.add() == 1
    all_reports(spark, log)
    assert [r.reason for r in read_growing_log(spark, log.target, "rejected").collect()] == ["fewer than five fields"]
    # The first load's files are as they were, and the ledger names each file once.
    assert all(os.stat(f).st_mtime_ns == t for f, t in first_files.items())
    ledger = read_ledger(spark, log.target).collect()
    assert sorted(os.path.basename(r.path) for r in ledger) == ["a.txt", "b.txt", "c.txt"]
    assert len({r.load for r in ledger}) == 2


def test_a_report_of_one_day_opens_that_day(spark, log):
    log.put("a.txt", line("2018-03-05"), line("2018-03-06"), line("2018-03-06", 1))
    log.add()
    counts = read_counts(spark, log.target, "games", days=["20180306"])
    assert sum(r.times for r in counts.collect()) == 2
    files = [f for f in counts.inputFiles() if "day=20180306" in f]
    plan = plan_of(counts)
    assert files and "PartitionFilters" in plan and "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert read_counts(spark, log.target, "games", days=["19990101"]).count() == 0


def test_a_file_that_changed_is_an_error_and_nothing_is_written(spark, log):
    log.put("a.txt", line("2018-03-05"))
    log.add()
    before = rows_of(read_growing_log(spark, log.target))
    time.sleep(1.1)
    log.put("a.txt", line("2018-03-05"), line("2018-03-05", 1))
    log.put("b.txt", line("2018-03-07"))
    with pytest.raises(ValueError, match="a.txt"):
        log.add()
    assert rows_of(read_growing_log(spark, log.target)) == before


def test_a_load_that_breaks_off_is_parsed_again(spark, log, monkeypatch):
    log.put("a.txt", line("2018-03-05"))
    log.add()
    log.put("b.txt", line("2018-03-06"), line("2018-03-07"))

    def lost(*args, **kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr("playtrail.sinks.growing_log.hour_of", lost)  # rows are written, counts are not
        with pytest.raises(RuntimeError):
            log.add()
    assert read_growing_log(spark, log.target).count() == 1
    assert log.add() == 1
    all_reports(spark, log)


def test_a_log_without_loads(spark, log):
    log.put("a.txt")
    assert log.add() == 0
    assert read_growing_log(spark, log.target).count() == 0 and read_counts(spark, log.target, "hours").count() == 0
    log.put("b.txt", "only a broken line")
    assert log.add() == 1
    assert read_growing_log(spark, log.target).count() == 0 and read_counts(spark, log.target, "games").count() == 0
