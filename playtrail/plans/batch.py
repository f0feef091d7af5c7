"""The whole batch run: raw text, clean table, four reports, result tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.operators import (
    measure_ranges,
    phone_model_times,
    top_games_by_city,
    top_games_by_month,
    visits_by_hour,
)
from playtrail.operators.keyed import BROWSE_KEY
from playtrail.scratch import new_folder, remove_folder
from playtrail.sinks import STAT_TABLES, clean_log, read_stat, report_rows, write_keyed_table, write_stat, write_stat_jdbc
from playtrail.sources import read_clean_log, read_keyed_table


def browse_reports(log: DataFrame, ranges: DataFrame, month: int, n: int | None = None) -> dict[str, DataFrame]:
    """The four reports over one log; each reads only the columns it needs."""
    return {
        "by_month": top_games_by_month(log, month, n),
        "by_city": top_games_by_city(log, measure_ranges(ranges)),
        "by_phone_model": phone_model_times(log, n),
        "by_hour": visits_by_hour(log),
    }


def run_batch(
    spark: SparkSession, source: str, clean_path: str, ranges: DataFrame, month: int,
    stat_root: str | None = None, jdbc_url: str | None = None, jdbc_properties: dict[str, str] | None = None,
    keyed_path: str | None = None, n: int | None = None, rebalance: bool = False,
) -> dict[str, DataFrame]:
    """Store the log and write all reports to Parquet tables, to database tables or to both.

    With `keyed_path` the reports count the newest row per (minute, address, game) of a keyed table
    instead of every logged visit. The two answer different questions, so neither is the default
    behind the other's back. Returns the reports as they are stored, or lazily where nothing is stored.
    """
    clean_log(spark, source, clean_path, rebalance)
    log = read_clean_log(spark, clean_path)
    if keyed_path is not None:
        write_keyed_table(log.drop("year", "month"), keyed_path, BROWSE_KEY, ["event_time"])
        log = read_keyed_table(spark, keyed_path)
    reports = browse_reports(log, ranges, month, n)
    if stat_root is None and jdbc_url is None:
        return reports
    # Each report is computed once, into the Parquet tables; the database is filled from these.
    root = stat_root or new_folder(spark, "stat")
    found = {}
    for report, rows in reports.items():
        covered = month if STAT_TABLES[report].slice_column else None
        write_stat(rows, report, root, covered)
        found[report] = report_rows(read_stat(spark, report, root), report)
        if covered is not None:
            found[report] = found[report].filter(F.col("month") == covered)
        if jdbc_url is not None:
            write_stat_jdbc(found[report], report, jdbc_url, jdbc_properties, covered=covered)
    if stat_root is not None:
        return found
    remove_folder(spark, root)
    return reports
