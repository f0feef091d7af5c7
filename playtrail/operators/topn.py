"""Ranked cuts."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, order: list[Column], n: int | None = None) -> DataFrame:
    """Globally sorted rows; with `n`, every task keeps only its own best `n` before they meet."""
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(n)


def top_n_per_group(
    df: DataFrame, keys: list[str], order: list[Column], n: int | None = None, rank: str = "rank"
) -> DataFrame:
    """Number the rows of each group and keep the first `n` (all of them when `n` is None).

    `order` must break all ties. Spark cuts to `n` rows per group before the shuffle as well as after
    it, so a group that holds most of the rows still moves only `n` rows per task.
    """
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered if n is None else numbered.filter(F.col(rank) <= n)
