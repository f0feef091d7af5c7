"""A table in files of key ranges, with the bounds of each file beside it.

    rows/version=*     rows sorted by key across all files
    bounds             file, first and last key, rows; written last, so it always names whole files
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.scratch import names_below, remove_folder


def write_key_ranges(df: DataFrame, path: str, key: str = "row_key", files: int | None = None) -> None:
    """Write a table sorted by `key` across its files, replacing it. Rows with a null key come first.

    Bounds between files come from a sample of (key, hash of the row), so files are nearly even: a key that holds
    a third of the rows is cut over as many files as it fills, and rows of one key stand in files next to each other.
    """
    spark, rows = df.sparkSession, f"{path}/rows/version={uuid.uuid4().hex}"
    order = [F.col(key), F.xxhash64(*df.columns)]
    df.repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(*order).write.parquet(rows)
    own_file = F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1)
    bounds = (
        spark.read.schema(df.schema).parquet(rows).select(own_file.alias("file"), F.col(key).alias("key"))
        .groupBy("file").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.count_if(F.col("key").isNull()).alias("nulls"), F.count("*").alias("rows"))
    )
    version = rows.rsplit("/", 1)[1]
    bounds.withColumn("file", F.concat(F.lit(f"{version}/"), "file")).coalesce(1).write.mode("overwrite").parquet(f"{path}/bounds")
    for old in names_below(spark, f"{path}/rows"):
        if old != version:
            remove_folder(spark, f"{path}/rows/{old}")


def key_range_files(spark: SparkSession, path: str, low=None, high=None) -> list[str]:
    """The files that may have keys from `low` to `high`, both included; None leaves an end open."""
    bounds = spark.read.parquet(f"{path}/bounds")
    if low is not None:
        bounds = bounds.where(F.col("last") >= F.lit(low))
    if high is not None:
        bounds = bounds.where(F.col("first") <= F.lit(high))
    return sorted(f"{path}/rows/{row.file}" for row in bounds.select("file").collect())


def read_key_range(spark: SparkSession, path: str, schema, low=None, high=None, key: str = "row_key") -> DataFrame:
    """The rows with keys from `low` to `high`, both included; only files whose bounds meet them are opened.

    With both ends open it is the whole table, null keys included. The names of the files come to the driver, as in
    every read by name; within a file the statistics of row groups leave out what lies outside.
    """
    files = key_range_files(spark, path, low, high)
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    if low is not None:
        rows = rows.where(F.col(key) >= F.lit(low))
    return rows if high is None else rows.where(F.col(key) <= F.lit(high))
