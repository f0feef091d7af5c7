"""Leaving out blocked users."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a list's filter for each user, and bytes of the filter at most.
_BITS_PER_USER, MAX_FILTER_BYTES = 16, 1 << 25
# Bits of one row of the filter, a fixed value of Spark's bitmap functions.
_ROW_BITS = 32768


def exclude_users(events: DataFrame, blocked: DataFrame, salt: int = 8) -> DataFrame:
    """Events whose `user_id` isn't in `blocked`, on batch and streaming DataFrames.

    No join hint: Spark broadcasts a blocklist below its own size threshold, and looks at the size
    again in every micro-batch when `blocked` reads a table. A longer list is shuffled by user, which
    a streaming query can't rebalance at run time. Hence `salt`: each user's events go to that many
    tasks, told by a hash of the whole event wherever it comes from, which all get a copy of the
    user's entry. With `salt=1` there are no copies.
    """
    users = blocked.select(F.col("user_id").cast("bigint").alias("user_id"))
    if salt <= 1:
        return events.join(users, "user_id", "left_anti").select(*events.columns)
    salted = events.withColumn("_salt", F.pmod(F.xxhash64(*events.columns), F.lit(salt)))
    copies = users.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return salted.join(copies, ["user_id", "_salt"], "left_anti").select(*events.columns)


def flag_blocked(events: DataFrame, blocked: DataFrame, salt: int = 8) -> DataFrame:
    """The events with a column `blocked`: whether their `user_id` is in the list. Join and salt as in `exclude_users`."""
    users = blocked.select(F.col("user_id").cast("bigint").alias("user_id")).distinct()
    if salt <= 1:
        listed = users.withColumn("_listed", F.lit(True))
        joined = events.join(listed, "user_id", "left")
    else:
        salted = events.withColumn("_salt", F.pmod(F.xxhash64(*events.columns), F.lit(salt)))
        copies = users.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))).withColumn("_listed", F.lit(True))
        joined = salted.join(copies, ["user_id", "_salt"], "left")
    return joined.select(*events.columns, F.col("_listed").isNotNull().alias("blocked"))


@dataclass(frozen=True)
class LongList:
    """A blocklist that is too long to broadcast, with a filter of bounded size that tells who can't be in it."""

    users: DataFrame
    bits: int
    rows: DataFrame  # `_row` and `_bits`, of the parts of the filter that have a bit set


def measure_blocklist(blocked: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES) -> LongList:
    """Build the filter of a list, with 16 bits a user up to the bound; a fuller one lets more events through to the join.

    One job counts the list. The filter's rows are aggregated in Spark and broadcast by the joins that use them.
    """
    users = blocked.select(F.col("user_id").cast("bigint").alias("user_id")).where("user_id is not null")
    wanted = max(users.count() * _BITS_PER_USER, _ROW_BITS)
    bits = min(1 << (wanted - 1).bit_length(), 1 << ((max_filter_bytes * 8).bit_length() - 1))
    place = users.select(_place(bits).alias("place"))
    rows = place.groupBy(F.bitmap_bucket_number("place").alias("_row")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("_bits"))
    return LongList(users, bits, rows)


def _place(bits: int) -> Column:
    """The bit of a user, numbered from 1 as the bitmap functions do."""
    return F.xxhash64("user_id").bitwiseAND(F.lit(bits - 1)) + 1


def with_possible_members(events: DataFrame, blocked: LongList) -> DataFrame:
    """The events with `possible`: false only where the user isn't in the list. No event is shuffled."""
    places = events.withColumn("_place", _place(blocked.bits)).withColumn("_row", F.bitmap_bucket_number("_place"))
    joined = places.join(F.broadcast(blocked.rows), "_row", "left")
    position = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(bitmap_bit_position(_place) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.pow(F.lit(2), position % 8).cast("int")) != 0
    return joined.select(*events.columns, F.coalesce(is_set, F.lit(False)).alias("possible"))


def exclude_listed(events: DataFrame, blocked: LongList, salt: int = 8) -> DataFrame:
    """As `exclude_users`, for a long list: only events whose user may be in it are shuffled to the exact join.

    The events are read once for those and once for the rest; persist them first if they are costly.
    """
    told = with_possible_members(events, blocked)
    certain = told.where(~F.col("possible")).drop("possible")
    return certain.unionByName(exclude_users(told.where("possible").drop("possible"), blocked.users, salt))
