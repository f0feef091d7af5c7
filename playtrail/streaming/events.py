"""Download and payment events out of JSON messages.

Everything here works on batch and streaming DataFrames alike.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.functions import compact_timestamp, day_of, hour_of, minute_of
from playtrail.operators.once import computed_once

# All values are read as text and cast afterwards, so that `"193"` and `193` are the same fee.
_DOWNLOAD = "time string, user_id string, game_id string"
_PAYMENT = f"{_DOWNLOAD}, flag string, order_id string, fee string"

# Flag of an order that was paid; a fixed value of the message format.
PAID = "1"

_DOWNLOAD_COLUMNS = ["time", "event_time", "user_id", "game_id"]
_PAYMENT_COLUMNS = [*_DOWNLOAD_COLUMNS, "order_id", "paid", "fee"]


def parse_downloads(messages: DataFrame, topic: str | None = None) -> DataFrame:
    """Downloads: time, its day, hour and minute parts, event_time, user_id, game_id."""
    read = computed_once(_read(messages, topic, payment=False).select(*_DOWNLOAD_COLUMNS))
    return read.filter(_reason(payment=False).isNull()).select(*_time_columns(), "user_id", "game_id")


def parse_payments(messages: DataFrame, topic: str | None = None) -> DataFrame:
    """Orders: as downloads, plus order_id, paid (1 or 0) and fee. A message without fee has fee 0."""
    read = computed_once(_read(messages, topic, payment=True).select(*_PAYMENT_COLUMNS))
    return read.filter(_reason(payment=True).isNull()).select(
        *_time_columns(), "user_id", "game_id", "order_id", "paid", "fee"
    )


def rejected_messages(messages: DataFrame, topic: str | None = None, payment: bool = False) -> DataFrame:
    """Messages that can't be counted, each with its reason."""
    read = _read(messages, topic, payment).select("topic", "value", _reason(payment).alias("reason"))
    return computed_once(read).filter(F.col("reason").isNotNull())


def parse_messages(messages: DataFrame, download_topic: str, payment_topic: str) -> DataFrame:
    """The messages of both topics, parsed once: `kind` (downloads or payments), `topic`, `value`, `reason`, and the
    columns of orders.

    `reason` is null for those that count; a download has no fee and isn't paid. Other topics are left out.
    """
    payment = F.col("kind") == "payments"
    kind = F.when(F.col("topic") == payment_topic, "payments").when(F.col("topic") == download_topic, "downloads")
    read = computed_once(_read(messages, None, payment=True).select(kind.alias("kind"), "topic", "value", *_PAYMENT_COLUMNS))
    reason = F.when(payment, _reason(payment=True)).otherwise(_reason(payment=False))
    none = F.lit(0).cast("bigint")
    return read.where("kind is not null").select(
        "kind", "topic", "value", reason.alias("reason"), *_time_columns(), "user_id", "game_id", "order_id",
        F.when(payment, F.col("paid")).otherwise(none).alias("paid"), F.when(payment, F.col("fee")).otherwise(none).alias("fee"),
    )


def _read(messages: DataFrame, topic: str | None, payment: bool) -> DataFrame:
    if topic is not None:
        messages = messages.filter(F.col("topic") == topic)
    message = F.from_json("value", _PAYMENT if payment else _DOWNLOAD)
    columns = [
        F.substring("m.time", 1, 14).alias("time"),
        compact_timestamp("m.time").alias("event_time"),
        F.col("m.user_id").try_cast("bigint").alias("user_id"),
        F.col("m.game_id").try_cast("bigint").alias("game_id"),
    ]
    if payment:
        columns += [
            "m.order_id",
            F.when(F.col("m.flag") == PAID, 1).otherwise(0).cast("bigint").alias("paid"),
            # Fractions are cut off.
            F.coalesce(F.col("m.fee"), F.lit("0")).try_cast("decimal(38,10)").try_cast("bigint").alias("fee"),
        ]
    return messages.select("topic", "value", message.alias("m")).select("topic", "value", *columns)


def _reason(payment: bool) -> Column:
    reason = F.when(F.col("event_time").isNull(), "unreadable time").when(
        F.col("user_id").isNull(), "unreadable user"
    )
    return reason.when(F.col("fee").isNull(), "unreadable fee") if payment else reason


def _time_columns() -> list:
    return [
        "time",
        day_of("time").alias("day"),
        hour_of("time").alias("hour"),
        minute_of("time").alias("minute"),
        "event_time",
    ]
