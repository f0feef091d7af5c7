"""Parts of the compact time strings `yyyyMMddHHmm[ss]` that every log row carries."""

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("day", "hour", "minute")

# How many leading characters of a compact time name each bucket.
_BUCKET_LENGTH = {"day": 8, "hour": 10, "minute": 12}


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def year_of(time) -> Column:
    return F.substring(_col(time), 1, 4).try_cast("int")


def month_of(time) -> Column:
    return F.substring(_col(time), 5, 2).try_cast("int")


def day_of(time) -> Column:
    return F.substring(_col(time), 1, 8)


def hour_of(time) -> Column:
    return F.substring(_col(time), 9, 2)


def minute_of(time) -> Column:
    return F.substring(_col(time), 11, 2)


def bucket(time, grain: str, pooled: bool = False) -> Column:
    """The time bucket a row counts towards.

    By default the bucket is a point in time (`yyyyMMdd`, `yyyyMMddHH`, `yyyyMMddHHmm`). `pooled`
    gives the bare hour or minute instead, which adds up equal hours of all days.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
    if pooled:
        return {"day": day_of, "hour": hour_of, "minute": minute_of}[grain](time)
    return F.substring(_col(time), 1, _BUCKET_LENGTH[grain])


def compact_timestamp(time) -> Column:
    """Timestamp of a `yyyyMMddHHmmss` string, null if it is none; missing seconds count as zero.

    Re-punctuating and casting stays on Spark's fixed-format parser, with no formatter object and
    no exception per bad row.
    """
    # `rpad` also cuts. Too short a time gets letters where digits belong, so the cast fails.
    minute = F.rpad(_col(time), 12, "x")
    seconds = F.rpad(F.substring(_col(time), 13, 2), 2, "0")

    def part(start: int, length: int = 2) -> Column:
        return F.substring(minute, start, length)

    iso = F.concat(
        part(1, 4), F.lit("-"), part(5), F.lit("-"), part(7), F.lit(" "),
        part(9), F.lit(":"), part(11), F.lit(":"), seconds,
    )
    return iso.try_cast("timestamp")
