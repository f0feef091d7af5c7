import pytest
from pyspark.errors import PySparkException

from playtrail.operators import from_cells, latest_per_key, to_cells, upsert, with_row_key
from playtrail.operators.keyed import BROWSE_KEY
from playtrail.sinks import merge_keyed_table, write_cells, write_keyed_table
from playtrail.sources import REPORT_COLUMNS, read_cells, read_keyed_table
from tests.conftest import plan_of, rows_of

KEYED = "date string, ip string, androidVersion string, phoneModel string, gameName string, gameId int, seq int"


def rows(spark, *items):
    return spark.createDataFrame([(d, ip, "Android o", phone, "g", gid, seq) for d, ip, gid, phone, seq in items], KEYED)


def brief(df):
    return {(r.date, r.ip, r.gameId): (r.phoneModel, r.seq) for r in df.collect()}


def test_latest_per_key(spark):
    df = rows(spark, ("d1", "a", 1, "old", 1), ("d1", "a", 1, "new", 2), ("d1", "a", 2, "x", 1), ("d2", "a", 1, "y", 1))
    assert brief(latest_per_key(df, BROWSE_KEY, ["seq"])) == {
        ("d1", "a", 1): ("new", 2), ("d1", "a", 2): ("x", 1), ("d2", "a", 1): ("y", 1)
    }


def test_ambiguous_row_keys_stay_apart(spark):
    df = rows(spark, ("d", "1.1.1.1", 23, "p", 1), ("d", "1.1.1.12", 3, "q", 1))
    assert len(brief(latest_per_key(df, BROWSE_KEY, ["seq"]))) == 2


def test_full_ties_are_settled_by_the_other_columns(spark):
    df = rows(spark, ("d", "a", 1, "p", 1), ("d", "a", 1, "q", 1))
    assert brief(latest_per_key(df, BROWSE_KEY, ["seq"])) == {("d", "a", 1): ("q", 1)}


def test_upsert_prefers_newer_then_update(spark):
    existing = rows(spark, ("d", "a", 1, "kept", 5), ("d", "b", 1, "tied", 3), ("d", "c", 1, "alone", 1))
    updates = rows(spark, ("d", "a", 1, "late", 4), ("d", "b", 1, "a tied update", 3), ("d", "e", 1, "new", 1))
    assert brief(upsert(existing, updates, BROWSE_KEY, ["seq"])) == {
        ("d", "a", 1): ("kept", 5), ("d", "b", 1): ("a tied update", 3),
        ("d", "c", 1): ("alone", 1), ("d", "e", 1): ("new", 1),
    }


def test_copies_of_a_key_are_dropped_before_the_shuffle(spark):
    plan = plan_of(latest_per_key(rows(spark, ("d", "a", 1, "p", 1)), BROWSE_KEY, ["seq"]))
    assert plan.count("WindowGroupLimit") == 2


def test_merge_rewrites_only_touched_days_and_can_run_again(spark, tmp_path):
    path = str(tmp_path / "keyed")
    base = rows(spark, ("201801010101", "a", 1, "old", 1), ("201801020101", "a", 1, "other day", 1),
                ("201801010102", "b", 1, "same day", 1))
    write_keyed_table(base, path, BROWSE_KEY, ["seq"])
    untouched = sorted((tmp_path / "keyed" / "day=20180102").glob("*.parquet"))
    updates = rows(spark, ("201801010101", "a", 1, "new", 2), ("201801030101", "a", 1, "new day", 2))
    for _ in range(2):
        merge_keyed_table(spark, path, updates, BROWSE_KEY, ["seq"])
        assert brief(read_keyed_table(spark, path)) == {
            ("201801010101", "a", 1): ("new", 2), ("201801010102", "b", 1): ("same day", 1),
            ("201801020101", "a", 1): ("other day", 1), ("201801030101", "a", 1): ("new day", 2),
        }
    assert sorted((tmp_path / "keyed" / "day=20180102").glob("*.parquet")) == untouched
    with pytest.raises(ValueError):
        merge_keyed_table(spark, path, updates, ["ip"], ["seq"])


def test_report_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "keyed")
    write_keyed_table(rows(spark, ("201801010101", "a", 1, "p", 1)), path, BROWSE_KEY, ["seq"])
    for report, columns in REPORT_COLUMNS.items():
        table = read_keyed_table(spark, path, report)
        assert table.columns == columns
        schema = plan_of(table).split("ReadSchema: struct<")[1].split(">")[0]
        assert sorted(part.split(":")[0] for part in schema.split(",")) == sorted(columns)


def test_cells_are_sorted_bytes_and_come_back_as_rows(spark, tmp_path):
    path = str(tmp_path / "cells")
    df = with_row_key(rows(spark, *[("201801010101", f"1.1.1.{i}", i, "电话", 1) for i in range(40)]))
    write_cells(df, path, files=3)
    stored = spark.read.parquet(path)
    assert dict(stored.dtypes)["value"] == "binary" and stored.count() == 240
    files = sorted((tmp_path / "cells").glob("*.parquet"))
    assert len(files) == 3
    keys = []
    for file in files:
        keys += [(r.row_key, r.qualifier) for r in spark.read.parquet(str(file)).collect()]
    assert keys == sorted(keys)
    back = from_cells(read_cells(spark, path))
    assert rows_of(back.select(*df.drop("seq").columns)) == rows_of(df.drop("seq"))


def test_missing_cells_are_null(spark):
    cells = spark.createDataFrame([("k", "ip", "1.1.1.1"), ("k", "gameId", "x")], "row_key string, qualifier string, value string")
    row = from_cells(cells).first()
    assert (row.ip, row.gameId, row.date) == ("1.1.1.1", None, None)


def test_cells_need_one_shuffle_each_way(spark):
    df = with_row_key(rows(spark, ("d", "a", 1, "p", 1)))
    assert plan_of(from_cells(to_cells(df))).count("Exchange") == 1
    sorted_cells = to_cells(df.repartitionByRange("row_key")).sortWithinPartitions("row_key", "qualifier")
    assert plan_of(sorted_cells).count("Exchange") == 1


def test_cells_of_two_rows_under_one_key_are_an_error(spark):
    df = rows(spark, ("d", "1.1.1.1", 23, "p", 1), ("d", "1.1.1.12", 3, "q", 1))
    with pytest.raises(PySparkException, match="several cells"):
        from_cells(to_cells(with_row_key(df))).collect()
    back = from_cells(to_cells(with_row_key(df, exact=True)))
    assert rows_of(back.select(*df.drop("seq").columns)) == rows_of(df.drop("seq"))


def test_null_dates_are_refused_before_anything_changes(spark, tmp_path):
    path = str(tmp_path / "keyed")
    write_keyed_table(rows(spark, ("201801010101", "a", 1, "p", 1)), path, BROWSE_KEY, ["seq"])
    with pytest.raises(PySparkException, match="needs a date"):
        merge_keyed_table(spark, path, rows(spark, (None, "a", 1, "q", 2)), BROWSE_KEY, ["seq"])
    assert brief(read_keyed_table(spark, path)) == {("201801010101", "a", 1): ("p", 1)}
