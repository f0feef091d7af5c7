"""Result tables of the four reports. Writing a report again replaces what it wrote before."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playtrail.scratch import new_folder, remove_folder


@dataclass(frozen=True)
class StatTable:
    name: str
    columns: dict[str, str]  # report column -> (renamed) table column, in table order
    keys: tuple[str, ...]
    schema: str  # of the table
    slice_column: str | None = None  # a report that fills only one slice of its table names it here


# Table and column names are fixed values: dashboards read these tables.
STAT_TABLES = {
    "by_month": StatTable(
        "game_by_month_topn_stat",
        {"month": "month", "gameName": "game_name", "gameId": "game_id", "times": "times"},
        ("month", "game_id"),
        "month int, game_name string, game_id int, times bigint",
        slice_column="month",
    ),
    "by_city": StatTable(
        "game_by_city_topn_stat",
        {"city": "city", "gameId": "game_id", "gameName": "game_name", "times": "times", "rank": "ranks"},
        ("city", "game_id"),
        "city string, game_id int, game_name string, times bigint, ranks int",
    ),
    "by_phone_model": StatTable(
        "game_by_phonemodel_times_stat", {"phoneModel": "phonemodel", "times": "times"}, ("phonemodel",),
        "phonemodel string, times bigint",
    ),
    "by_hour": StatTable(
        "game_by_hour_times_stat", {"hour": "hour", "times": "times"}, ("hour",), "hour string, times bigint"
    ),
}


def stat_rows(df: DataFrame, report: str, unmatched_city: str | None = None) -> DataFrame:
    """A report under the column names of its table.

    A database key can't be null: `unmatched_city` names the group of addresses without a city.
    """
    table = STAT_TABLES[report]
    rows = df.select(*[F.col(c).alias(target) for c, target in table.columns.items()])
    if unmatched_city is not None and "city" in rows.columns:
        rows = rows.withColumn("city", F.coalesce("city", F.lit(unmatched_city)))
    return rows


def report_rows(df: DataFrame, report: str) -> DataFrame:
    """Rows of a result table under the column names of its report."""
    return df.select(*[F.col(target).alias(c) for c, target in STAT_TABLES[report].columns.items()])


def write_stat(df: DataFrame, report: str, root: str, covered: int | None = None) -> None:
    """Write a report to its Parquet table below `root`; other months of the monthly table stay.

    `covered` is the month that the report is about: without rows for it, its old rows go nevertheless.
    """
    table = STAT_TABLES[report]
    path = f"{root}/{table.name}"
    rows = stat_rows(df, report)
    if not table.slice_column:
        rows.write.mode("overwrite").parquet(path)
        return
    in_slice = Observation()
    of_slice = F.count_if(F.col(table.slice_column) == covered) if covered is not None else F.count("*")
    writer = rows.observe(in_slice, of_slice.alias("rows")).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(table.slice_column).parquet(path)
    if covered is not None and not in_slice.get["rows"]:
        remove_folder(df.sparkSession, f"{path}/{table.slice_column}={covered}")


def read_stat(spark: SparkSession, report: str, root: str) -> DataFrame:
    table = STAT_TABLES[report]
    return spark.read.schema(table.schema).parquet(f"{root}/{table.name}").select(*table.columns.values())


def write_stat_jdbc(
    df: DataFrame, report: str, url: str, properties: dict[str, str] | None = None,
    unmatched_city: str | None = "", connections: int = 4, covered: int | None = None,
) -> None:
    """Write a report to its existing database table, batched and with one transaction per partition.

    The rows are computed into the shared folder before the table is touched. Then the table is
    truncated and filled again, so its definition and key stay as they are. Slices that this report
    doesn't cover are copied along; `covered` names the slice that it covers, with or without rows. If
    filling the table fails, it may be left with a part of its rows: the error names the folder that has all of them,
    and writing that folder to the table repairs it. Otherwise the folder is removed.
    """
    table = STAT_TABLES[report]
    properties = properties or {}
    spark = df.sparkSession
    rows = stat_rows(df, report, unmatched_city)
    if table.slice_column:
        stored = spark.read.jdbc(url, table.name, properties=properties)
        kept = stored.select(*rows.columns)
        if covered is None:
            of_rows = rows.select(table.slice_column).distinct()
            kept = kept.join(of_rows, table.slice_column, "left_anti").select(*rows.columns)
        else:
            kept = kept.filter(~F.col(table.slice_column).eqNullSafe(F.lit(covered)))
        rows = kept.unionByName(rows)
    staged = new_folder(spark, f"stat-{report}")
    rows.write.parquet(staged)
    writer = spark.read.schema(table.schema).parquet(staged).write.mode("overwrite").option("truncate", "true")
    writer = writer.option("batchsize", "1000").option("numPartitions", str(connections))
    try:
        writer.jdbc(url, table.name, properties=properties)
    except Exception as error:
        error.add_note(f"{table.name} may be incomplete; all of its rows are in {staged}")
        raise
    remove_folder(spark, staged)
