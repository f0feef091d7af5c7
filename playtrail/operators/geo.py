"""Address to city: a range join against a table of `ip_lo`, `ip_hi`, `city`.

Ranges and addresses are cut into equal buckets of the address space, which turns the range condition
into an equality plus a check of the ends. A bucket is 2^bucket_bits addresses wide, so it never holds
more ranges or more distinct addresses than that, however the data is spread.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtrail.functions import ipv4_number

# Rough size of one range in a broadcast hash table, without the city's own bytes.
_LAST_ADDRESS = 2**32 - 1
_ROW_OVERHEAD_BYTES = 96
_NOWHERE_BUCKETS = 65536
_ADDRESS_BITS = 32
_PART_BITS = 16


@dataclass(frozen=True)
class CityRanges:
    """Ranges cut into buckets, together with their measured size."""

    pieces: DataFrame
    bucket_bits: int
    rows: int
    size_bytes: int
    broadcast_limit_bytes: int

    @property
    def fits_broadcast(self) -> bool:
        return self.size_bytes <= self.broadcast_limit_bytes


def most_specific_ranges(ranges: DataFrame) -> DataFrame:
    """Disjoint ranges `ip_lo, ip_hi, city` that say the same as overlapping ones, of which the narrowest counts.

    Of equally wide ranges the one that starts later counts, then the first city in text order, null last.
    Open and reversed ranges are left out (`measure_ranges` with `nested` raises instead).

    A sweep over all ends cuts the addresses into stretches that no range begins or ends within. Which range
    counts there needs no list of open ranges: each range is the sum of at most 62 aligned blocks of a power of
    two, each block keeps its narrowest range, and a stretch looks at the 33 blocks around its first address. So
    ranges nested however deep meet in equality joins only.
    """
    sound = ranges.select(F.col("ip_lo").cast("bigint"), F.col("ip_hi").cast("bigint"), "city").where("ip_lo <= ip_hi")
    order = F.struct(
        (F.col("ip_hi") - F.col("ip_lo")).alias("width"), (-F.col("ip_lo")).alias("start"), F.col("city").isNull().alias("no_city"), "city"
    )
    levels = F.explode(F.sequence(F.lit(0), F.lit(_ADDRESS_BITS))).alias("level")
    whole = sound.select("*", levels).select(
        "level", order.alias("order"),
        F.expr("shiftright(ip_lo + shiftleft(1L, level) - 1, level)").alias("first"),
        F.expr("shiftright(ip_hi + 1, level)").alias("behind"),
    ).where("first < behind")
    # The blocks at either end that no larger block takes up.
    ends = F.array_compact(F.array(F.when(F.col("first") % 2 == 1, F.col("first")), F.when(F.col("behind") % 2 == 1, F.col("behind") - 1)))
    blocks = whole.select("level", F.explode(ends).alias("block"), "order").groupBy("level", "block").agg(F.min("order").alias("order"))

    points = sound.select(F.explode(F.array("ip_lo", F.col("ip_hi") + 1)).alias("point")).distinct()
    in_part = points.withColumn("part", F.shiftright("point", _PART_BITS))
    # At most 65,537 parts, whatever the number of ranges: what follows a part's last point is looked up among them.
    parts = in_part.groupBy("part").agg(F.min("point").alias("first")).withColumn("following", F.lead("first").over(Window.orderBy("part")))
    own = F.lead("point").over(Window.partitionBy("part").orderBy("point"))
    stretches = in_part.withColumn("own", own).join(parts.select("part", "following"), "part").select(
        "point", (F.coalesce("own", "following") - 1).alias("last")
    ).where("last is not null")
    around = stretches.select("*", levels).withColumn("block", F.expr("shiftright(point, level)"))
    found = around.join(blocks, ["level", "block"]).groupBy("point", "last").agg(F.min("order").alias("order"))
    return found.select(F.col("point").alias("ip_lo"), F.col("last").alias("ip_hi"), "order.city")


def measure_ranges(
    ranges: DataFrame, bucket_bits: int = 12, broadcast_limit_bytes: int = 128 * 1024 * 1024, nested: bool = False
) -> CityRanges:
    """Cut the ranges into buckets, check that they are sound and measure them.

    Small jobs over the range table: ends that are no addresses, overlapping, reversed or open ranges raise ValueError, and
    the size decides later whether the table may be broadcast. With `nested`, ranges may overlap and the most
    specific one counts.
    """
    outside = (F.col("ip_lo") < 0) | (F.col("ip_hi") > _LAST_ADDRESS)
    if ranges.select(F.coalesce(F.bool_or(outside), F.lit(False))).first()[0]:
        raise ValueError("the range table holds ends outside 0 to 2^32 - 1")
    if nested:
        unsound = F.col("ip_lo").isNull() | F.col("ip_hi").isNull() | (F.col("ip_lo") > F.col("ip_hi"))
        if ranges.select(F.coalesce(F.bool_or(unsound), F.lit(False))).first()[0]:
            raise ValueError("the range table holds ranges without ends or with ip_lo above ip_hi")
        # Used by the measuring below and by every join: cut once.
        ranges = most_specific_ranges(ranges).persist()
    pieces = ranges.select(
        F.explode_outer(
            F.sequence(F.shiftright("ip_lo", bucket_bits), F.shiftright("ip_hi", bucket_bits))
        ).alias("bucket"),
        "ip_lo", "ip_hi", "city",
    )
    by_bucket = Window.partitionBy("bucket").orderBy("ip_lo", "ip_hi")
    open_or_reversed = (
        F.col("ip_lo").isNull() | F.col("ip_hi").isNull() | (F.col("ip_lo") > F.col("ip_hi"))
    )
    overlap = F.lag("ip_hi").over(by_bucket) >= F.col("ip_lo")
    row_size = F.lit(_ROW_OVERHEAD_BYTES) + F.coalesce(F.octet_length("city"), F.lit(0))
    found = (
        pieces.select(
            open_or_reversed.alias("open_or_reversed"),
            F.coalesce(overlap, F.lit(False)).alias("overlap"),
            row_size.cast("bigint").alias("row_size"),
        )
        .agg(
            F.count_if("open_or_reversed").alias("bad"),
            F.count_if("overlap").alias("overlapping"),
            F.count("*").alias("rows"),
            F.coalesce(F.sum("row_size"), F.lit(0)).alias("size_bytes"),
        )
        .first()
    )
    if found["bad"]:
        raise ValueError("the range table holds ranges without ends or with ip_lo above ip_hi")
    if found["overlapping"]:
        raise ValueError("the range table holds overlapping ranges")
    return CityRanges(pieces, bucket_bits, found["rows"], found["size_bytes"], broadcast_limit_bytes)


def with_city(df: DataFrame, ranges: CityRanges | DataFrame, ip: str = "ip") -> DataFrame:
    """Add `city`; it is null where no range holds the address.

    A range table that was measured small is broadcast and the rows stay where they are. A larger
    one meets the rows in a join shuffled by bucket. A bucket that holds far more rows than others,
    such as that of one very busy address, is then split by Spark at run time.
    """
    if isinstance(ranges, DataFrame):
        ranges = measure_ranges(ranges)
    number = ipv4_number(ip)
    # Unreadable addresses match nothing. They get buckets below zero, spread so as not to pile up.
    nowhere = -1 - F.pmod(F.xxhash64(ip), F.lit(_NOWHERE_BUCKETS))
    located = df.withColumn("_number", number).withColumn(
        "_bucket", F.coalesce(F.shiftright("_number", ranges.bucket_bits), nowhere)
    )
    pieces = ranges.pieces.select(
        F.col("bucket").alias("_range_bucket"),
        F.col("ip_lo").alias("_ip_lo"),
        F.col("ip_hi").alias("_ip_hi"),
        "city",
    )
    if ranges.fits_broadcast:
        pieces = F.broadcast(pieces)
    in_range = (F.col("_bucket") == F.col("_range_bucket")) & F.col("_number").between(
        F.col("_ip_lo"), F.col("_ip_hi")
    )
    return located.join(pieces, in_range, "left").select(*df.columns, "city")
