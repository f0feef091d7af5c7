"""Keyed tables: the newest row per key, and rows taken apart into cells."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.functions import exact_row_key, row_key
from playtrail.operators.topn import top_n_per_group
from playtrail.schema import BROWSE_COLUMNS

# Rows of the browse log that a put would overwrite share these columns.
BROWSE_KEY = ["date", "ip", "gameId"]


def with_row_key(df: DataFrame, exact: bool = False) -> DataFrame:
    """Add `row_key`; the exact form is unique per (date, ip, gameId), the plain one nearly so."""
    return df.withColumn("row_key", exact_row_key() if exact else row_key())


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The row with the highest `order_by` per key; full ties go to the highest remaining columns.

    Every task drops all but its newest row per key before the shuffle, so copies of one key, however
    many, don't meet in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    order: list[Column] = [F.desc_nulls_last(c) for c in [*order_by, *rest]]
    return top_n_per_group(df, keys, order, 1, rank="_newest").drop("_newest")


def upsert(existing: DataFrame, updates: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Existing rows and updates merged to the newest row per key; updates win where `order_by` ties."""
    both = existing.withColumn("_is_update", F.lit(0)).unionByName(updates.withColumn("_is_update", F.lit(1)))
    return latest_per_key(both, keys, [*order_by, "_is_update"]).drop("_is_update")


def to_cells(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per non-key column: `row_key`, `qualifier`, `value`."""
    columns = columns or BROWSE_COLUMNS
    as_text = df.select("row_key", *[F.col(c).cast("string").alias(c) for c in columns])
    return as_text.unpivot("row_key", columns, "qualifier", "value")


def from_cells(cells: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Put cells of text back together into browse rows, in one shuffle on the row key.

    A key with two cells of one column stands for two rows, which can't be told apart any more: an error.
    """
    columns = columns or BROWSE_COLUMNS
    own = {c: F.col("qualifier") == c for c in columns}
    values = [F.max(F.when(is_own, F.col("value"))).alias(c) for c, is_own in own.items()]
    most = F.greatest(F.lit(0), *[F.count_if(is_own) for is_own in own.values()]).alias("_cells")
    rows = cells.groupBy("row_key").agg(*values, most)
    message = F.concat(F.lit("several cells of one column under the key "), F.col("row_key"))
    alone = F.when(F.col("_cells") <= 1, True).otherwise(F.raise_error(message).cast("boolean"))
    rows = rows.filter(alone).drop("_cells")
    return rows.withColumn("gameId", F.col("gameId").try_cast("int")) if "gameId" in columns else rows
