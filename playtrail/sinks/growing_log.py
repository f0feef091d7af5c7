"""A clean log that grows by the files that are new, with its partial counts beside it.

    rows/load=*/status=*/year=*/month=*    clean rows and rejected lines, as `clean_log` writes them
    counts/kind=*/load=*/day=*             visits per day and key, for the reports
    ledger/load=*                          the files of each load: path, length, time

A load counts once its part of the ledger is written, which comes last; what a broken one has left is never read.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from playtrail.functions import day_of, hour_of
from playtrail.schema import BROWSE_COLUMNS, PARSED_LOG
from playtrail.scratch import names_below
from playtrail.sinks.browse_store import clean_log
from playtrail.sources.browse_log import read_clean_log

_LEDGER = "path string, length bigint, modified timestamp, load string"
# Key columns of each kind of counts, and their types as the tables have them.
COUNT_KEYS = {
    "games": ("ip string", "gameId int", "gameName string"),
    "phone_models": ("phoneModel string",),
    "hours": ("hour string",),
}


def read_ledger(spark: SparkSession, target: str) -> DataFrame:
    """The files whose lines are in the log, with the load that brought them."""
    if not names_below(spark, f"{target}/ledger"):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(f"{target}/ledger")


def add_new_files(spark: SparkSession, source: str, target: str, rebalance: bool = False) -> int:
    """Parse the files below `source` that the log doesn't have yet, and tell how many there were.

    Files are told by path, length and time. One that has changed since it was parsed is an error, raised
    before anything is written: its old lines couldn't be told from its new ones. Files that are gone keep their
    rows, empty ones wait until they have lines. Only the new files are opened, once; counts are made from the
    clean rows. One load runs at a time.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    found = listed.select("path", "length", F.col("modificationTime").alias("modified"))
    known = read_ledger(spark, target).select("path", F.col("length").alias("old_length"), F.col("modified").alias("old_modified"))
    told = found.join(known, "path", "left").where(
        F.col("old_length").isNull() | (F.col("length") != F.col("old_length")) | (F.col("modified") != F.col("old_modified"))
    )
    # A read is given its files by name, so the names of the new ones come to the driver anyway.
    new = told.orderBy("path").collect()
    changed = [row.path for row in new if row.old_length is not None]
    if changed:
        raise ValueError(f"log files that have changed since they were parsed: {', '.join(changed[:5])}")
    if not new:
        return 0
    load = uuid.uuid4().hex
    rows = f"{target}/rows/load={load}"
    clean_log(spark, [row.path for row in new], rows, rebalance)
    visits = read_clean_log(spark, rows).withColumns({"day": day_of("date"), "hour": hour_of("date")})
    for kind, keys in COUNT_KEYS.items():
        names = [key.split(" ")[0] for key in keys]
        counts = visits.groupBy("day", *names).agg(F.count("*").alias("times")).hint("rebalance", "day")
        counts.write.partitionBy("day").parquet(f"{target}/counts/kind={kind}/load={load}")
    entries = spark.createDataFrame([(row.path, row.length, row.modified) for row in new], _LEDGER.rsplit(",", 1)[0])
    entries.coalesce(1).write.parquet(f"{target}/ledger/load={load}")
    return len(new)


def _loads(spark: SparkSession, target: str) -> list[str]:
    return [row["load"] for row in read_ledger(spark, target).select("load").distinct().collect()]


def read_growing_log(spark: SparkSession, target: str, status: str = "clean") -> DataFrame:
    """The rows of all loads that are whole; a filter on `year` or `month` reads only those folders.

    `status="rejected"` gives the lines that couldn't be read, with their reason.
    """
    loads = _loads(spark, target)
    if not loads:
        stored = spark.createDataFrame([], PARSED_LOG)
    else:
        layout = StructType([*PARSED_LOG.fields, StructField("load", StringType())])
        stored = spark.read.schema(layout).parquet(f"{target}/rows").where(F.col("load").isin(loads))
    stored = stored.where(F.col("status") == status)
    if status == "rejected":
        return stored.select("line", F.col("reject_reason").alias("reason"))
    return stored.select(*BROWSE_COLUMNS, "event_time", "year", "month")


def read_counts(spark: SparkSession, target: str, kind: str, days: list[str] | None = None) -> DataFrame:
    """`day`, the keys of this kind of counts and `times`; several rows of one key add up.

    With `days` (`yyyyMMdd`) only their folders are opened.
    """
    schema = ", ".join([*COUNT_KEYS[kind], "times bigint", "day string", "load string"])
    loads = _loads(spark, target)
    if not loads:
        return spark.createDataFrame([], schema).drop("load")
    counts = spark.read.schema(schema).parquet(f"{target}/counts/kind={kind}").where(F.col("load").isin(loads))
    return (counts if days is None else counts.where(F.col("day").isin(days))).drop("load")
