"""Storing browse logs: the clean Parquet copy, and text that can be read back."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.functions import browse_line, month_of, year_of
from playtrail.operators.once import computed_once
from playtrail.schema import PARSED_LOG
from playtrail.sources.browse_log import parse_lines


def clean_log(spark: SparkSession, source: str | list[str], target: str, rebalance: bool = False) -> None:
    """Parse a raw text log into a Parquet table in `status`/`year`/`month` folders, replacing it.

    The text is read once: clean rows and rejected lines go to folders of the same table. Log files
    that are in order of time need no shuffle, as each task then writes one or two months. For files
    that mix months, `rebalance` gathers each month first and splits the large ones evenly.
    """
    parsed = parse_lines(spark.read.text(source))
    rejected = F.col("reject_reason").isNotNull()
    stored = parsed.select(
        *[c for c in parsed.columns if c not in ("line", "reject_reason")],
        F.when(rejected, F.col("line")).alias("line"),
        "reject_reason",
        F.when(rejected, "rejected").otherwise("clean").alias("status"),
        F.when(~rejected, year_of("date")).alias("year"),
        F.when(~rejected, month_of("date")).alias("month"),
    ).select(*PARSED_LOG.fieldNames())
    if rebalance:
        stored = stored.hint("rebalance", "status", "year", "month")
    writer = stored.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("status", "year", "month").parquet(target)


def write_browse_log(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write browse rows as text lines, the form `read_browse_log` reads.

    A row that its line would not give back, such as one with a tab in a name or without an address,
    is an error.
    """
    line, fits = browse_line("event_time" in df.columns)
    # The line is built once, whatever looks at it.
    lines = computed_once(df.select(line.alias("value"), fits.alias("fits")))
    message = F.concat(F.lit("a browse row that text can't hold: "), F.coalesce("value", F.lit("null")))
    checked = F.when(F.col("fits"), F.col("value")).otherwise(F.raise_error(message).cast("string"))
    lines.select(checked.alias("value")).write.mode(mode).text(path)
