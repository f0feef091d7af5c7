"""Running totals per time bucket and sliding windows.

Both are built-in aggregates: each micro-batch is summed within its tasks before the shuffle, so even
when all events fall into the current bucket, only one row per task and bucket moves.
"""

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from playtrail.functions import bucket

_UTC = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00"}
_WINDOW = {"day": "1 day", "hour": "1 hour", "minute": "1 minute"}
_BUCKET_FORMAT = {"day": "yyyyMMdd", "hour": "yyyyMMddHH", "minute": "yyyyMMddHHmm"}


def running_downloads(
    downloads: DataFrame, grain: str = "day", pooled: bool = False, watermark: str | None = None
) -> DataFrame:
    """Downloads per day, hour or minute: `bucket`, `downloads`.

    Without `watermark` every bucket is kept for good. With one (such as "1 hour"), buckets are event
    time windows whose state is dropped once the watermark has passed, and so are events that come
    later than that. Such windows start at UTC midnight, so for days and hours the session's time
    zone must be UTC.
    """
    return _by_bucket(downloads, grain, pooled, watermark, [F.count("*").alias("downloads")])


def running_payments(
    payments: DataFrame, grain: str = "day", pooled: bool = False, watermark: str | None = None
) -> DataFrame:
    """Per bucket: `orders`, `paid` orders, `fee_total` of all orders and `fee_paid` of the paid ones."""
    return _by_bucket(payments, grain, pooled, watermark, _payment_sums())


def sliding_downloads(
    downloads: DataFrame, length: str = "10 seconds", slide: str = "5 seconds", watermark: str | None = None
) -> DataFrame:
    """Downloads in overlapping event time windows: `window_start`, `window_end`, `downloads`."""
    windows = _windows(downloads, length, slide, watermark)
    return _window_ends(windows.agg(F.count("*").alias("downloads")))


def sliding_payments(
    payments: DataFrame, length: str = "10 seconds", slide: str = "5 seconds", watermark: str | None = None
) -> DataFrame:
    """The sums of `running_payments` in overlapping event time windows."""
    return _window_ends(_windows(payments, length, slide, watermark).agg(*_payment_sums()))


def _payment_sums() -> list[Column]:
    return [
        F.count("*").alias("orders"),
        F.sum("paid").alias("paid"),
        F.sum("fee").alias("fee_total"),
        F.sum(F.col("fee") * F.col("paid")).alias("fee_paid"),
    ]


def _by_bucket(
    events: DataFrame, grain: str, pooled: bool, watermark: str | None, sums: list[Column]
) -> DataFrame:
    if watermark is None:
        return events.groupBy(bucket("time", grain, pooled).alias("bucket")).agg(*sums)
    if pooled:
        raise ValueError("pooled buckets have no end, so a watermark can't close them")
    zone = events.sparkSession.conf.get("spark.sql.session.timeZone")
    if grain != "minute" and zone not in _UTC:
        raise ValueError(f"days and hours behind a watermark need a session in UTC, not in {zone}")
    totals = _windows(events, _WINDOW[grain], _WINDOW[grain], watermark).agg(*sums)
    name = F.date_format("window.start", _BUCKET_FORMAT[grain])
    return totals.select(name.alias("bucket"), *[c for c in totals.columns if c != "window"])


def _windows(events: DataFrame, length: str, slide: str, watermark: str | None) -> GroupedData:
    if watermark is not None:
        events = events.withWatermark("event_time", watermark)
    return events.groupBy(F.window("event_time", length, slide).alias("window"))


def _window_ends(totals: DataFrame) -> DataFrame:
    return totals.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in totals.columns if c != "window"],
    )
