"""The four browse reports, each as DataFrame operations and as SQL text with equal results.

Visits are counted per (game id, game name) first and the names are merged afterwards. Text can be a
grouping key of a hash aggregate but not its running value: `min(gameName)` over the log itself would
make Spark sort every row, here it only ever sees the few counted groups.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.functions import hour_of, month_of, year_of
from playtrail.operators.geo import CityRanges, measure_ranges, with_city
from playtrail.operators.topn import top_n, top_n_per_group

# The value that stands for a phone model nobody knows; a fixed value of the log format.
UNKNOWN_PHONE_MODEL = "_"


def top_games_by_month(
    df: DataFrame, month: int, n: int | None = None, year: int | None = None, use_sql: bool = False
) -> DataFrame:
    """Visits per game in one calendar month (of all years unless `year` is given), most visited first."""
    df = _with_part(df, "month", month_of("date"))
    if year is not None:
        df = _with_part(df, "year", year_of("date")).filter(F.col("year") == year)
    if use_sql:
        limit = "" if n is None else f"LIMIT {int(n)}"
        return df.sparkSession.sql(
            f"""
            SELECT CAST(:month AS INT) AS month, min(gameName) AS gameName, gameId, sum(times) AS times
            FROM (SELECT gameId, gameName, count(*) AS times FROM {{visits}}
                  WHERE month = :month GROUP BY gameId, gameName)
            GROUP BY gameId ORDER BY times DESC, gameId {limit}
            """,
            args={"month": month},
            visits=df,
        )
    games = _merge_names(
        df.filter(F.col("month") == month).groupBy("gameId", "gameName").agg(F.count("*").alias("times")),
        ["gameId"],
    )
    labelled = games.select(F.lit(month).cast("int").alias("month"), "gameName", "gameId", "times")
    return top_n(labelled, [F.desc("times"), F.asc("gameId")], n)


def top_games_by_city(
    df: DataFrame, ranges: CityRanges | DataFrame | None = None, n: int | None = 3, use_sql: bool = False,
    drop_unmatched: bool = False,
) -> DataFrame:
    """The `n` most visited games of each city, numbered from 1; `n=None` numbers all of them.

    `ranges` says which addresses belong to which city; leave it out if `df` has a `city` already.
    Addresses outside all ranges form a group of their own, with a null city.
    """
    visits = _city_visits(df, ranges)
    if drop_unmatched:
        visits = visits.filter(F.col("city").isNotNull())
    if use_sql:
        cut = "" if n is None else f"WHERE rank <= {int(n)}"
        return df.sparkSession.sql(
            f"""
            SELECT city, gameId, gameName, times, rank FROM (
              SELECT city, gameId, gameName, times,
                     row_number() OVER (PARTITION BY city ORDER BY times DESC, gameId) AS rank
              FROM (SELECT city, gameId, min(gameName) AS gameName, sum(times) AS times
                    FROM (SELECT city, gameId, gameName, sum(times) AS times FROM {{visits}}
                          GROUP BY city, gameId, gameName)
                    GROUP BY city, gameId)) {cut}
            """,
            visits=visits,
        )
    per_name = visits.groupBy("city", "gameId", "gameName").agg(F.sum("times").alias("times"))
    games = _merge_names(per_name, ["city", "gameId"])
    ranked = top_n_per_group(games, ["city"], [F.desc("times"), F.asc("gameId")], n)
    return ranked.select("city", "gameId", "gameName", "times", "rank")


def phone_model_times(
    df: DataFrame, n: int | None = None, use_sql: bool = False, drop_unknown: bool = False
) -> DataFrame:
    """Visits per phone model, most used first. The unknown model counts as one unless dropped."""
    if drop_unknown:
        df = df.filter(~F.col("phoneModel").eqNullSafe(UNKNOWN_PHONE_MODEL))
    if use_sql:
        limit = "" if n is None else f"LIMIT {int(n)}"
        return df.sparkSession.sql(
            f"""
            SELECT phoneModel, count(*) AS times FROM {{visits}}
            GROUP BY phoneModel ORDER BY times DESC, phoneModel {limit}
            """,
            visits=df,
        )
    counted = df.groupBy("phoneModel").agg(F.count("*").alias("times"))
    return top_n(counted, [F.desc("times"), F.asc("phoneModel")], n)


def visits_by_hour(df: DataFrame, use_sql: bool = False) -> DataFrame:
    """Visits per hour of the day, in order; hours without visits don't appear."""
    df = df.select(hour_of("date").alias("hour"))
    if use_sql:
        return df.sparkSession.sql(
            "SELECT hour, count(*) AS times FROM {visits} GROUP BY hour ORDER BY hour", visits=df
        )
    return df.groupBy("hour").agg(F.count("*").alias("times")).orderBy("hour")


def _with_part(df: DataFrame, name: str, value) -> DataFrame:
    """Use the stored folder column where there is one, so that a filter on it skips folders."""
    return df if name in df.columns else df.withColumn(name, value)


def _city_visits(df: DataFrame, ranges: CityRanges | DataFrame | None) -> DataFrame:
    """Rows of (city, gameId, gameName, times), counted as far as is useful before the city is known."""
    if ranges is None:
        return df.select("city", "gameId", "gameName", F.lit(1).cast("bigint").alias("times"))
    if isinstance(ranges, DataFrame):
        ranges = measure_ranges(ranges)
    if ranges.fits_broadcast:
        located = with_city(df.select("ip", "gameId", "gameName"), ranges)
        return located.select("city", "gameId", "gameName", F.lit(1).cast("bigint").alias("times"))
    # The lookup has to shuffle: count per address first, so that a busy address is one row per game.
    per_address = df.groupBy("ip", "gameId", "gameName").agg(F.count("*").alias("times"))
    return with_city(per_address, ranges).select("city", "gameId", "gameName", "times")


def _merge_names(counted: DataFrame, keys: list[str]) -> DataFrame:
    """One row per game: a game that was logged under several names gets the first in text order."""
    return counted.groupBy(*keys).agg(F.min("gameName").alias("gameName"), F.sum("times").alias("times"))
