"""The given tables in the shape of the logs: what a visit, a download and an order look like there."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playtrail.schema import BROWSE_COLUMNS

DOWNLOADS = "downloads"
PAYMENTS = "payments"
OTHERS = "others"

# Address block of the users: each owns 8192 addresses from 10.0.0.0 on.
_FIRST_ADDRESS = 167772160
_ADDRESSES_PER_USER = 8192


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up in the files once and remembered."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def browse_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a visit; `event_id` gives the order of arrival."""
    number = F.pmod(
        F.lit(_FIRST_ADDRESS).cast("bigint") + F.col("user_id") * _ADDRESSES_PER_USER + 5,
        F.lit(2**32).cast("bigint"),
    )
    octets = [F.shiftright(number, shift).bitwiseAND(F.lit(255)).cast("string") for shift in (24, 16, 8, 0)]
    visits = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat_ws(".", *octets).alias("ip"),
        F.date_format("ts", "yyyyMMddHHmm").alias("date"),
        F.concat(F.lit("Android "), (F.col("user_id") % 8).cast("string")).alias("androidVersion"),
        F.when(F.col("event_type") == "error", "_").otherwise(F.col("event_type")).alias("phoneModel"),
        F.get_json_object("props", "$.k").cast("int").alias("gameId"),
        F.date_trunc("second", "ts").alias("event_time"),
    )
    names = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("gameId"), F.col("p_name").alias("gameName")
    )
    return visits.join(names, "gameId", "left").select("event_id", *BROWSE_COLUMNS, "event_time")


def city_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One range per nation, as wide as its share of the users."""
    users = table(spark, sf_dir, "events").select(F.count_distinct("user_id").alias("n"))
    share = users.select(F.greatest(F.lit(1), F.expr("n div 30"))).scalar()
    width = share * _ADDRESSES_PER_USER
    first = F.lit(_FIRST_ADDRESS).cast("bigint") + F.col("n_nationkey") * width
    return table(spark, sf_dir, "nation").select(
        first.alias("ip_lo"), (first + width - 1).alias("ip_hi"), F.col("n_name").alias("city")
    )


def nested_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations' ranges, one around them all, one per region over half of it, and one per supplier somewhere inside them."""
    nations = city_ranges(spark, sf_dir)
    share = nations.agg(F.max(F.col("ip_hi") - F.col("ip_lo") + 1).alias("width"))
    around = share.select(
        F.lit(_FIRST_ADDRESS).cast("bigint").alias("ip_lo"), (F.lit(_FIRST_ADDRESS) + 40 * F.col("width")).alias("ip_hi"), F.lit("elsewhere").alias("city")
    )
    regions = table(spark, sf_dir, "region").join(share).select(
        (F.lit(_FIRST_ADDRESS) + F.col("r_regionkey") * 5 * F.col("width")).alias("ip_lo"),
        (F.lit(_FIRST_ADDRESS) + (F.col("r_regionkey") * 5 + 20) * F.col("width")).alias("ip_hi"),
        F.col("r_name").alias("city"),
    )
    start = F.lit(_FIRST_ADDRESS) + F.pmod(F.col("s_suppkey") * 247_711, 30 * F.col("width"))
    width = F.lit(1) + F.pmod(F.col("s_suppkey") * 7919, 2 * F.col("width"))
    suppliers = table(spark, sf_dir, "supplier").join(share).select(start.alias("ip_lo"), (start + width).alias("ip_hi"), F.col("s_name").alias("city"))
    return nations.unionByName(around).unionByName(regions).unionByName(suppliers)


def daily_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits keyed by day, so that some of them share a key."""
    return browse_view(spark, sf_dir).withColumn("date", F.substring("date", 1, 8)).drop("event_time")



def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every visit as a text line, damaged in a way that depends on its event type."""
    visits = browse_view(spark, sf_dir)
    time_text = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")
    kind = F.col("phoneModel")
    fields = [
        F.col("ip"),
        F.when(kind == "view", time_text).otherwise(F.concat(F.lit("["), time_text, F.lit("]"))),
        F.when(kind == "_", F.concat(F.lit("("), "androidVersion", F.lit(")"))).otherwise(
            F.concat(F.lit("("), "androidVersion", F.lit(","), "phoneModel", F.lit(")"))
        ),
        F.col("gameName"),
        F.when(kind == "signup", "x").when(kind == "purchase", None).otherwise(F.col("gameId").cast("string")),
    ]
    return visits.select(F.concat_ws("\t", *fields).alias("value"))


def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks as download messages, purchases and errors as paid and unpaid orders, the rest as a topic of its own."""
    events = table(spark, sf_dir, "events")
    time = F.date_format("ts", "yyyyMMddHHmmss").alias("time")
    game_id = F.get_json_object("props", "$.k").cast("int").alias("game_id")
    order = F.to_json(
        F.struct(
            F.when(F.col("event_type") == "purchase", "1").otherwise("0").alias("flag"),
            F.col("event_id").cast("string").alias("order_id"),
            F.floor("value").cast("bigint").alias("fee"),
            time,
            "user_id",
            game_id,
        )
    )
    is_download = F.col("event_type") == "click"
    return events.select(
        F.when(is_download, DOWNLOADS).when(F.col("event_type").isin("purchase", "error"), PAYMENTS)
        .otherwise(OTHERS).alias("topic"),
        F.when(is_download, F.to_json(F.struct(time, "user_id", game_id))).otherwise(order).alias("value"),
    )


def broken_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an order message, damaged in a way that depends on its event type."""
    kind = F.col("event_type")
    user = F.when(kind == "signup", None).otherwise(F.col("user_id"))
    time = F.when(kind == "view", "soon").otherwise(F.date_format("ts", "yyyyMMddHHmmss"))
    fee = F.when(kind == "click", "free").otherwise(F.floor("value").cast("string"))
    text = F.to_json(F.struct(F.col("event_id").cast("string").alias("order_id"), fee.alias("fee"),
                              time.alias("time"), user.alias("user_id")))
    return table(spark, sf_dir, "events").select(
        F.lit(PAYMENTS).alias("topic"),
        F.when(kind == "error", F.concat(F.lit("order "), F.col("event_id").cast("string")))
        .otherwise(text).alias("value"),
    )


def blocked_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users below nine tenths of the user count."""
    events = table(spark, sf_dir, "events")
    limit = events.select(F.count_distinct("user_id") * 9).scalar()
    return events.filter(F.col("user_id") * 10 < limit).select("user_id").distinct()
