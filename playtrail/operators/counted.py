"""The browse reports from partial counts: equal to those over the log, read from a fraction of it.

Counts are sums of `times` per day and key; those of more days, or of a day that came in parts, add up.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.functions import month_of, year_of
from playtrail.operators.geo import CityRanges, measure_ranges, with_city
from playtrail.operators.reports import _merge_names
from playtrail.operators.topn import top_n, top_n_per_group


def games_by_month_from_counts(counts: DataFrame, month: int, n: int | None = None, year: int | None = None) -> DataFrame:
    """As `top_games_by_month`, from counts per day and game."""
    held = counts.where(month_of("day") == month)
    if year is not None:
        held = held.where(year_of("day") == year)
    named = held.groupBy("gameId", "gameName").agg(F.sum("times").alias("times"))
    games = _merge_names(named, ["gameId"])
    labelled = games.select(F.lit(month).cast("int").alias("month"), "gameName", "gameId", "times")
    return top_n(labelled, [F.desc("times"), F.asc("gameId")], n)


def games_by_city_from_counts(
    counts: DataFrame, ranges: CityRanges | DataFrame, n: int | None = 3, drop_unmatched: bool = False
) -> DataFrame:
    """As `top_games_by_city`, from counts per day, address and game: the city of each address is looked up once."""
    if isinstance(ranges, DataFrame):
        ranges = measure_ranges(ranges)
    per_address = counts.groupBy("ip", "gameId", "gameName").agg(F.sum("times").alias("times"))
    located = with_city(per_address, ranges)
    if drop_unmatched:
        located = located.where(F.col("city").isNotNull())
    named = located.groupBy("city", "gameId", "gameName").agg(F.sum("times").alias("times"))
    games = _merge_names(named, ["city", "gameId"])
    ranked = top_n_per_group(games, ["city"], [F.desc("times"), F.asc("gameId")], n)
    return ranked.select("city", "gameId", "gameName", "times", "rank")


def phone_models_from_counts(counts: DataFrame, n: int | None = None) -> DataFrame:
    """As `phone_model_times`, from counts per day and phone model."""
    return top_n(counts.groupBy("phoneModel").agg(F.sum("times").alias("times")), [F.desc("times"), F.asc("phoneModel")], n)


def hours_from_counts(counts: DataFrame) -> DataFrame:
    """As `visits_by_hour`, from counts per day and hour."""
    return counts.groupBy("hour").agg(F.sum("times").alias("times")).orderBy("hour")
