"""Storing keyed tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from playtrail.functions import day_of
from playtrail.operators.keyed import latest_per_key, to_cells, upsert
from playtrail.scratch import new_folder, remove_folder


def write_keyed_table(df: DataFrame, path: str, keys: list[str], order_by: list[str]) -> None:
    """Write the newest row per key in `day` folders, replacing the table. A null date is an error."""
    newest = latest_per_key(df, keys, order_by).withColumn("day", _day())
    _in_days(newest).mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def merge_keyed_table(
    spark: SparkSession, path: str, updates: DataFrame, keys: list[str], order_by: list[str]
) -> None:
    """Merge updates into a stored keyed table; `date` must be among the keys.

    Only the days that the updates touch are read and rewritten. Updates are computed once, into the
    shared folder, which is removed at the end, also after an error. The merged days are written beside
    the table's own and take their place when all of them are there. Running the merge again with the same
    updates gives the same table. A null date is an error, raised before anything is written to the table.
    """
    if "date" not in keys:
        raise ValueError("days can be merged on their own only if date is part of the key")
    columns = StructType([*updates.schema.fields, StructField("day", StringType())])
    staged = new_folder(spark, "keyed-updates")
    try:
        updates.withColumn("day", _day()).write.parquet(staged)
        kept_updates = spark.read.schema(columns).parquet(staged)
        stored = spark.read.schema(columns).parquet(path)
        merged = upsert(touched_days(stored, kept_updates), kept_updates, keys, order_by)
        # Dynamic overwriting reads the old days to their end before it removes them.
        _in_days(merged).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    finally:
        remove_folder(spark, staged)


def touched_days(stored: DataFrame, updates: DataFrame) -> DataFrame:
    """Stored rows of the days that `updates` have; the folders of other days are not opened.

    The days are broadcast: dates have eight digits, so there are never more than 3.7 million. The
    comparison, which every day passes, tells Spark that the list is worth pruning folders by.
    """
    days = updates.select("day").distinct().filter(F.col("day") >= "")
    return stored.join(F.broadcast(days), "day", "left_semi")


def _day() -> Column:
    no_date = F.raise_error(F.lit("a row of a keyed table needs a date"))
    return F.coalesce(day_of("date"), no_date.cast("string"))


def write_cells(df: DataFrame, path: str, columns: list[str] | None = None, files: int | None = None) -> None:
    """Write a table with unique `row_key` as cells, sorted by (row_key, qualifier) across all files.

    Rows are range-partitioned while they are still whole and split into cells afterwards, so the
    shuffle moves each row once instead of once per column. Values are UTF-8 bytes.
    """
    ranged = df.repartitionByRange(*([files] if files else []), "row_key")
    cells = to_cells(ranged, columns).sortWithinPartitions("row_key", "qualifier")
    cells.withColumn("value", F.col("value").cast("binary")).write.mode("overwrite").parquet(path)


def _in_days(df: DataFrame):
    return df.hint("rebalance", "day").write.partitionBy("day")
