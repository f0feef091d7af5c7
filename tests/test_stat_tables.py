from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

from playtrail.sinks import STAT_TABLES, read_stat, stat_rows, write_stat, write_stat_jdbc
from tests.conftest import rows_of

MONTH = "month int, gameName string, gameId int, times bigint"
CITY = "city string, gameId int, gameName string, times bigint, rank int"


def month_report(spark, *rows):
    return spark.createDataFrame(list(rows), MONTH)


def test_table_and_column_names(spark):
    assert {t.name: list(t.columns.values()) for t in STAT_TABLES.values()} == {
        "game_by_month_topn_stat": ["month", "game_name", "game_id", "times"],
        "game_by_city_topn_stat": ["city", "game_id", "game_name", "times", "ranks"],
        "game_by_phonemodel_times_stat": ["phonemodel", "times"],
        "game_by_hour_times_stat": ["hour", "times"],
    }
    report = spark.createDataFrame([(None, 1, "x", 2, 1)], CITY)
    assert rows_of(stat_rows(report, "by_city")) == [(None, 1, "x", 2, 1)]
    assert rows_of(stat_rows(report, "by_city", "elsewhere")) == [("elsewhere", 1, "x", 2, 1)]


def test_writing_again_replaces_only_its_month(spark, tmp_path):
    root = str(tmp_path)
    write_stat(month_report(spark, (3, "x", 1, 5), (3, "y", 2, 1)), "by_month", root)
    write_stat(month_report(spark, (4, "x", 1, 7)), "by_month", root)
    for _ in range(2):
        write_stat(month_report(spark, (3, "x", 1, 6)), "by_month", root)
        assert rows_of(read_stat(spark, "by_month", root)) == [(3, "x", 1, 6), (4, "x", 1, 7)]


def test_whole_reports_are_replaced(spark, tmp_path):
    root = str(tmp_path)
    hours = "hour string, times bigint"
    write_stat(spark.createDataFrame([("00", 1), ("01", 1)], hours), "by_hour", root)
    write_stat(spark.createDataFrame([("00", 2)], hours), "by_hour", root)
    assert rows_of(read_stat(spark, "by_hour", root)) == [("00", 2)]


def test_database_write_keeps_other_months_and_is_computed_first(spark, monkeypatch):
    """No database is at hand: the JDBC calls are stood in for, everything up to them is real."""
    stored = spark.createDataFrame([(3, "stale", 9, 1), (4, "x", 1, 7)], "month int, game_name string, game_id int, times bigint")
    written = {}

    def write(self, url, table, mode=None, properties=None):
        written.update(url=url, table=table, properties=properties, rows=rows_of(self._df), files=self._df.inputFiles())

    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, properties=None: stored)
    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    write_stat_jdbc(month_report(spark, (3, "x", 1, 6)), "by_month", "jdbc:any", {"user": "u"})
    assert written["table"] == "game_by_month_topn_stat" and written["properties"] == {"user": "u"}
    assert written["rows"] == [(3, "x", 1, 6), (4, "x", 1, 7)]
    assert written["files"]  # the rows come from a staged table, not from the one to be truncated
    write_stat_jdbc(spark.createDataFrame([(None, 1, "x", 2, 1)], CITY), "by_city", "jdbc:any")
    assert written["rows"] == [("", 1, "x", 2, 1)]


def test_a_month_without_rows_is_cleared(spark, tmp_path):
    root = str(tmp_path)
    write_stat(month_report(spark), "by_month", root, 3)
    assert read_stat(spark, "by_month", root).count() == 0  # a first run without rows can be read
    write_stat(month_report(spark, (3, "x", 1, 5), (4, "x", 1, 7)), "by_month", root, 3)
    write_stat(month_report(spark), "by_month", root, 3)
    assert rows_of(read_stat(spark, "by_month", root)) == [(4, "x", 1, 7)]
