"""Mixing sources to target weights: whole copies first, then Pareto order sampling for the rest."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playtrail.llm.text import n_words, stored, whole

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_COPIES = 2
SEED = "mix-8"
ROWS_PER_SLICE = 2_000
LONG_TEXT = 100
MAX_ODDS = 1e12
MAX_BROADCAST_SOURCES = 100_000


def long_text_preference(size: Column) -> Column:
    """Texts of a hundred words or more are twice as likely to be drawn. Whole numbers keep sums exact."""
    return F.when(size >= LONG_TEXT, 2).otherwise(1).cast("bigint")


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT, max_copies: int = MAX_COPIES
) -> DataFrame:
    """`source, source_size` with a `target`: the budget shared by weight, the excess over the cap shared again.

    Sharing again until no source is above its cap comes to one level: sources in order of cap per
    weight are capped as long as the level from the others lies above their own. One short row a source.
    """
    ranked = sizes.withColumn(
        "weight",
        F.element_at(
            F.array(*(F.lit(w) for w in weights)),
            (F.pmod(F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1).cast("int"),
        ).cast("bigint"),
    ).withColumn("cap", F.col("source_size") * max_copies)
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(everything) * (share_percent / 100) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    levelled = ranked.withColumns({"left": left, "weights": F.sum("weight").over(after)})
    capped = F.col("cap") * F.col("weights") <= F.col("left") * F.col("weight")
    # The first source below its cap sets the level for all that follow.
    levelled = levelled.withColumn("capped", capped)
    level = F.first(F.when(~F.col("capped"), F.struct("left", "weights")), ignorenulls=True).over(everything)
    return levelled.withColumn("level", level).select(
        *sizes.columns,
        F.when(F.col("capped"), F.col("cap").cast("double"))
        .otherwise(F.col("level.left") * F.col("weight") / F.col("level.weights"))
        .alias("target"),
    )


def uniform(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in (0, 1) from the seed, the id and, for rows without id, the text."""
    told = F.coalesce(doc_id.cast("string"), F.concat(F.lit("-"), F.md5(text)))
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.lit("/"), told)), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))


def _drawn(sources: DataFrame) -> DataFrame:
    """For each source its whole copies, the size that is still missing, and the odds of an average row."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.floor(ratio)
    missing = F.col("target") - copies * F.col("source_size")
    share = F.when(F.col("source_size") > 0, missing / F.col("source_size")).otherwise(0.0)
    slices = F.greatest(F.ceil(F.col("rows") / ROWS_PER_SLICE), F.lit(1))
    return sources.select("*", copies.alias("whole"), missing.alias("missing"), share.alias("share"), slices.alias("slices"))


def _odds(share: Column) -> Column:
    return F.when(share >= 1, MAX_ODDS).otherwise(F.least(share / (1 - share), F.lit(MAX_ODDS)))


def _ranked(rows: DataFrame) -> DataFrame:
    """`rank`, Pareto's measure, and `slice`, which rises with it and is even over the rows of a source."""
    own = _odds(F.col("share") * F.col("liked") * F.col("source_size") / F.col("liked_size"))
    odds = F.col("uniform") / (1 - F.col("uniform"))
    rank = F.when(own > 0, odds / own)
    even = F.col("rank") * _odds(F.col("share"))
    part = F.floor(even / (1 + even) * F.col("slices"))
    return rows.withColumn("rank", rank).withColumn("slice", part)


def _small(sources: DataFrame, n_sources: int) -> DataFrame:
    """Marked for broadcast up to a hundred bytes for each of `MAX_BROADCAST_SOURCES`."""
    return F.broadcast(sources) if n_sources <= MAX_BROADCAST_SOURCES else sources


def mix(
    df: DataFrame,
    weights=WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    max_copies: int = MAX_COPIES,
    seed: str = SEED,
    preference=long_text_preference,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """All rows and columns of `df` with `size`, `source_size`, `target`, `copies` and `taken`.

    Every row gets the whole copies in target / source size, at most `max_copies`. The rest of the target
    is drawn: rows are ranked by Pareto's measure, the odds of a uniform number divided by the odds of the
    row's inclusion, and taken in that order up to the size that is missing; the row that crosses it is
    taken if that comes nearer. `preference` tilts inclusion among the rows of a source.

    Ranks are summed in slices first, so that only the slice where a source meets its target is put in
    order row by row; a source of any size spreads over many tasks, and texts are never shuffled.
    Null sources are a source of their own, the last. Null and empty texts have size 0. Rows that
    repeat an id are drawn together, rows without id by their text. An empty table gives no rows;
    columns of `df` with the name of an added one give way.
    """
    added = ("size", "source_size", "target", "copies", "taken")
    columns = [c for c in df.columns if c not in added]
    size = n_words(whole(text))
    given = df.select(
        F.struct(*columns).alias("row"), F.col(source).alias("source"), size.alias("size"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        uniform(F.col(doc_id), whole(text), seed).alias("uniform"),
    ).withColumn("liked", preference(F.col("size")))
    rows = stored(given.drop("row"), "mix-rows")

    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("liked")).alias("liked_size"), F.count("*").alias("rows")
    )
    targets = source_targets(sizes, weights, share_percent, max_copies)
    sources = stored(_drawn(targets), "mix-sources")
    n_sources = sources.count()

    def ranked(some: DataFrame, stats: DataFrame) -> DataFrame:
        stats = _small(stats.withColumnRenamed("source", "of_source"), n_sources)
        return _ranked(some.join(stats, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source"))

    in_order = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, W.currentRow)
    slices = ranked(rows, sources).where("rank is not null").groupBy("source", "slice", "missing").agg(F.sum("size").alias("in_slice"))
    met = slices.withColumn("so_far", F.sum("in_slice").over(in_order)).where("so_far >= missing and missing > 0")
    cuts = met.groupBy("source").agg(F.min(F.struct("slice", (F.col("so_far") - F.col("in_slice")).alias("before"))).alias("cut"))
    cut_sources = stored(
        sources.join(_small(cuts.withColumnRenamed("source", "cut_source"), n_sources), F.col("source").eqNullSafe(F.col("cut_source")), "left")
        .select(*sources.columns, F.col("cut.slice").alias("cut"), F.col("cut.before").alias("before")),
        "mix-cuts",
    )
    by_rank = W.partitionBy("source").orderBy("rank", "id").rowsBetween(W.unboundedPreceding, -1)
    earlier = F.col("before") + F.coalesce(F.sum("size").over(by_rank), F.lit(0))
    last = (
        ranked(rows, cut_sources).where("slice = cut").withColumn("earlier", earlier)
        .where("earlier + size / 2 <= missing").groupBy("source").agg(F.max(F.struct("rank", "id")).alias("last"))
    )
    final = stored(
        cut_sources.join(_small(last.withColumnRenamed("source", "last_source"), n_sources), F.col("source").eqNullSafe(F.col("last_source")), "left")
        .drop("last_source"),
        "mix-last",
    )
    # Without a slice that meets the target, all rows are taken.
    within = F.when(F.col("cut").isNull(), True).otherwise(
        (F.col("slice") < F.col("cut")) | ((F.col("slice") == F.col("cut")) & F.coalesce(F.struct("rank", "id") <= F.col("last"), F.lit(False)))
    )
    extra = F.coalesce(F.col("rank").isNotNull() & (F.col("missing") > 0) & within, F.lit(False)).cast("int")
    copies = (F.col("whole").cast("int") + extra).alias("copies")
    return ranked(given, final).select(
        *(F.col("row")[c].alias(c) for c in columns), "size", "source_size", "target", copies, (F.col("size") * copies).alias("taken")
    )


def mixed(df: DataFrame, **settings) -> DataFrame:
    """The mix itself: every row of `df` as often as it is taken, with the columns of `df`."""
    taken = mix(df, **settings).withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies"))))
    return taken.select(*df.columns)
