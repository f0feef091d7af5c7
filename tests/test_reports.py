import pytest

from playtrail.operators import (
    measure_ranges,
    phone_model_times,
    top_games_by_city,
    top_games_by_month,
    top_n_per_group,
    visits_by_hour,
)
from pyspark.sql import functions as F
from tests.conftest import plan_of

LOG = "ip string, date string, androidVersion string, phoneModel string, gameName string, gameId int"
both_forms = pytest.mark.parametrize("use_sql", [False, True])


def log(spark, rows):
    return spark.createDataFrame([(ip, date, "Android o", phone, game, gid) for ip, date, phone, game, gid in rows], LOG)


@pytest.fixture(scope="module")
def visits(spark):
    rows = (
        [("1.0.0.1", "201803040910", "m1", "x", 1)] * 3
        + [("1.0.0.2", "201803052310", "m2", "y", 2)] * 3
        + [("1.0.0.3", "201703052310", "_", "z", 3)] * 4
        + [("2.0.0.1", "201804010010", "m1", "x", 1)] * 2
        + [("9.9.9.9", "201804010010", "m2", "w", 4)]
        + [("1.0.0.4", "201803010010", "m1", "w", 4), ("1.0.0.4", "201803010010", "m1", "v", 4)]
    )
    return log(spark, rows)


@pytest.fixture(scope="module")
def ranges(spark):
    rows = [(1 << 24, (1 << 24) + 255, "A"), (2 << 24, (2 << 24) + 255, "B")]
    return spark.createDataFrame(rows, "ip_lo bigint, ip_hi bigint, city string")


def tuples(df):
    return [tuple(r) for r in df.collect()]


@both_forms
def test_by_month_pools_years_breaks_ties_and_merges_names(visits, use_sql):
    expected = [(3, "z", 3, 4), (3, "x", 1, 3), (3, "y", 2, 3), (3, "v", 4, 2)]
    report = top_games_by_month(visits, 3, use_sql=use_sql)
    assert report.columns == ["month", "gameName", "gameId", "times"]
    assert tuples(report) == expected
    assert tuples(top_games_by_month(visits, 3, 2, use_sql=use_sql)) == expected[:2]
    assert tuples(top_games_by_month(visits, 3, year=2018, use_sql=use_sql)) == expected[1:]
    assert tuples(top_games_by_month(visits, 7, use_sql=use_sql)) == []


@both_forms
@pytest.mark.parametrize("limit", [0, 10**9])
def test_by_city(visits, ranges, use_sql, limit):
    measured = measure_ranges(ranges, broadcast_limit_bytes=limit)
    everything = [
        ("A", 3, "z", 4, 1), ("A", 1, "x", 3, 2), ("A", 2, "y", 3, 3), ("A", 4, "v", 2, 4),
        ("B", 1, "x", 2, 1), (None, 4, "w", 1, 1),
    ]
    report = top_games_by_city(visits, measured, use_sql=use_sql)
    assert report.columns == ["city", "gameId", "gameName", "times", "rank"]
    assert set(tuples(report)) == {row for row in everything if row[4] <= 3}
    assert set(tuples(top_games_by_city(visits, measured, n=None, use_sql=use_sql))) == set(everything)
    matched = top_games_by_city(visits, measured, n=None, use_sql=use_sql, drop_unmatched=True)
    assert set(tuples(matched)) == set(everything[:-1])


def test_by_city_takes_a_city_column(spark):
    df = spark.createDataFrame([("A", 1, "x"), ("A", 1, "x")], "city string, gameId int, gameName string")
    assert tuples(top_games_by_city(df)) == [("A", 1, "x", 2, 1)]


@both_forms
def test_four_games_tied_for_three_places(spark, use_sql):
    df = spark.createDataFrame([("A", g, "n") for g in (4, 2, 3, 1)], "city string, gameId int, gameName string")
    assert sorted(r.gameId for r in top_games_by_city(df, use_sql=use_sql).collect()) == [1, 2, 3]


@both_forms
def test_by_phone_model(visits, use_sql):
    expected = [("m1", 7), ("_", 4), ("m2", 4)]
    assert tuples(phone_model_times(visits, use_sql=use_sql)) == expected
    assert tuples(phone_model_times(visits, 1, use_sql=use_sql)) == expected[:1]
    assert tuples(phone_model_times(visits, use_sql=use_sql, drop_unknown=True)) == [("m1", 7), ("m2", 4)]


@both_forms
def test_by_hour_counts_rows_without_game_too(spark, visits, use_sql):
    assert tuples(visits_by_hour(visits, use_sql=use_sql)) == [("00", 5), ("09", 3), ("23", 7)]
    only_date = spark.createDataFrame([("201801010100",)], "date string")
    assert tuples(visits_by_hour(only_date, use_sql=use_sql)) == [("01", 1)]


def test_sql_forms_leave_no_views_behind(spark, visits):
    before = {t.name for t in spark.catalog.listTables()}
    visits_by_hour(visits, use_sql=True).collect()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_plans_count_before_they_shuffle(visits):
    month = plan_of(top_games_by_month(visits, 3, 10))
    assert "TakeOrderedAndProject" in month
    first_shuffle_input = month.split("Exchange")[-1]
    assert "HashAggregate(keys=[gameId" in first_shuffle_input and "SortAggregate" not in first_shuffle_input


def test_top_n_per_group_cuts_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = plan_of(top_n_per_group(df, ["k"], [F.desc("v")], 2))
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Partial") > plan.index("Exchange")
