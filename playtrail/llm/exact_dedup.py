"""Exact duplicates: a two-pass Bloom filter finds the hashes that may repeat, and only their rows shuffle."""

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.llm.repeats import MAX_FILTER_BYTES, bit_map, cell, filter_bits, in_map
from playtrail.llm.text import stored, whole, without_space

BITS_PER_ROW = 16

_SHA, _HASH, _LENGTH = "__exact_sha", "__exact_hash", "__exact_length"


def _with_hash(df: DataFrame, text: str) -> DataFrame:
    """The SHA-256 of the text without white space, a short hash of that, and the text's length."""
    digest = F.unhex(F.sha2(without_space(whole(text)), 256))
    return df.withColumns({_SHA: digest, _LENGTH: F.length(whole(text)).cast("bigint")}).withColumn(
        _HASH, F.xxhash64(_SHA)
    )


def _cells(hashed: Column, bits: int) -> list[Column]:
    """The two places of a hash in a filter of that many bits, a power of two."""
    return [cell(hashed, bits), F.shiftrightunsigned(hashed, 64 - (bits.bit_length() - 1))]


def _may_repeat(keys: DataFrame, max_bytes: int) -> Column:
    """First pass: the places that two or more rows hit. Second pass, the column: whether a row's both places are such.

    The filter's size follows the number of rows up to `max_bytes`. A fuller filter only lets more rows
    through to the exact comparison.
    """
    bits = filter_bits(keys.count(), BITS_PER_ROW, max_bytes)
    hits = keys.select(F.explode(F.array(*_cells(F.col(_HASH), bits))).alias("cell")).groupBy("cell").count()
    places = bit_map(hits.where("count > 1").select("cell"), bits)

    @F.pandas_udf("boolean")
    def probe(first: pd.Series, second: pd.Series) -> pd.Series:
        return pd.Series(in_map(places.value, first.to_numpy()) & in_map(places.value, second.to_numpy()))

    return probe(*_cells(F.col(_HASH), bits))


def _best(doc_id: str) -> Column:
    """Sorts the row that stays first: most code points, then the smallest id, null last."""
    return F.struct((-F.col(_LENGTH)).alias("less"), F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"))


def exact_groups(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", max_filter_bytes: int = MAX_FILTER_BYTES
) -> DataFrame:
    """`doc_id, keep_id, group_size, kept, text_sha256`, one row for each row of `df`.

    Texts are equal when identical without white space; null counts as empty, so all empty texts are one
    group. The longest text of a group stays, then the smallest id (null last); of repeated rows, which
    tie in both, exactly one is `kept`. An empty table gives no rows; other columns are ignored.
    """
    hashed = _with_hash(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__exact_text")), "__exact_text")
    keys = stored(
        hashed.select("doc_id", _SHA, _HASH, _LENGTH, F.monotonically_increasing_id().alias("row")), "exact-keys"
    )
    marked = stored(keys.withColumn("again", _may_repeat(keys, max_filter_bytes)), "exact-marked")
    best = F.min(F.struct(_best("doc_id").alias("best"), "row"))
    groups = marked.where("again").groupBy(_SHA).agg(best.alias("keep"), F.count("*").alias("group_size"))
    repeated = marked.where("again").join(groups, _SHA).select(
        "doc_id", F.col("keep.best.id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"), _SHA
    )
    single = marked.where("not again").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), _SHA
    )
    return single.unionByName(repeated).withColumn("text_sha256", F.lower(F.hex(_SHA))).drop(_SHA)


def drop_exact_copies(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", max_filter_bytes: int = MAX_FILTER_BYTES
) -> DataFrame:
    """The rows of `df` that stay, with all their columns; rules and cases as in `exact_groups`.

    Rows whose hash occurs once go straight through. Of the others, the winners are told by
    (group, id, length), and rows that are the same in all three come down to one.
    """
    hashed = _with_hash(df, text)
    keys = stored(hashed.select(F.col(doc_id).alias("doc_id"), _SHA, _HASH, _LENGTH), "exact-keys")
    repeats = _may_repeat(keys, max_filter_bytes)
    marked = hashed.withColumn("__exact_again", repeats)
    winners = (
        keys.where(repeats).groupBy(_SHA).agg(F.min(_best("doc_id")).alias("best"))
        .select(F.col(_SHA).alias("win_sha"), F.col("best.id").alias("win_id"), (-F.col("best.less")).alias("win_length"))
    )
    again = marked.where("__exact_again")
    wins = (
        (F.col(_SHA) == F.col("win_sha"))
        & F.col(doc_id).eqNullSafe(F.col("win_id"))
        & (F.col(_LENGTH) == F.col("win_length"))
    )
    repeated_groups = again.join(winners, wins, "left_semi").dropDuplicates([_SHA, doc_id, _LENGTH])
    return marked.where("not __exact_again").unionByName(repeated_groups).select(*df.columns)
