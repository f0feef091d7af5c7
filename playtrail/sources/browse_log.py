"""Reading browse logs: raw text and the stored clean copy."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.functions import browse_fields
from playtrail.operators.once import computed_once
from playtrail.schema import BROWSE_COLUMNS, PARSED_LOG


def parse_lines(lines: DataFrame) -> DataFrame:
    """Parse a `value` column of text lines; every line comes out, bad ones with a `reject_reason`."""
    split_lines = lines.select(F.col("value").alias("line"), F.split("value", "\t").alias("fields"))
    columns = browse_fields(F.col("fields"))
    parsed = split_lines.select(
        "line", F.size("fields").alias("field_count"), *[c.alias(name) for name, c in columns.items()]
    )
    reason = (
        F.when(F.col("field_count") < 5, "fewer than five fields")
        .when(F.col("date").isNull(), "unreadable time")
        .when(F.col("phoneModel").isNull(), "unreadable device")
        .when(F.col("gameId").isNull(), "unreadable game id")
    )
    return parsed.select(*BROWSE_COLUMNS, "event_time", "line", reason.alias("reject_reason"))


def read_browse_log(spark: SparkSession, path: str, mode: str = "drop") -> DataFrame:
    """Typed rows of a raw text log.

    `drop` leaves bad lines out (get them with `rejected_lines`), `failfast` stops at the first one.
    """
    parsed = computed_once(parse_lines(spark.read.text(path)))
    if mode == "drop":
        parsed = parsed.filter(F.col("reject_reason").isNull())
    elif mode == "failfast":
        message = F.concat(F.lit("bad browse log line, "), F.col("reject_reason"), F.lit(": "), F.col("line"))
        good = F.when(F.col("reject_reason").isNull(), F.lit(True))
        parsed = parsed.filter(good.otherwise(F.raise_error(message).cast("boolean")))
    else:
        raise ValueError(f"mode must be 'drop' or 'failfast', not {mode!r}")
    return parsed.select(*BROWSE_COLUMNS, "event_time")


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a raw text log that can't be read, each with its reason."""
    bad = computed_once(parse_lines(spark.read.text(path))).filter(F.col("reject_reason").isNotNull())
    return bad.select("line", F.col("reject_reason").alias("reason"))


def read_clean_log(spark: SparkSession, path: str) -> DataFrame:
    """Clean rows of a stored log; a filter on `year` or `month` reads only those folders."""
    stored = spark.read.schema(PARSED_LOG).parquet(path).filter(F.col("status") == "clean")
    return stored.select(*BROWSE_COLUMNS, "event_time", "year", "month")


def read_rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """Rejected lines kept beside the clean rows of a stored log."""
    stored = spark.read.schema(PARSED_LOG).parquet(path).filter(F.col("status") == "rejected")
    return stored.select("line", F.col("reject_reason").alias("reason"))
