"""Sharding by a two-pass external shuffle: seeded hashes scatter rows into buckets of memory size, and each
bucket is shuffled by Fisher-Yates and written."""

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playtrail.llm.text import whole

N_SHARDS = 16
SEED = 20
BUCKET_BYTES = 24 << 20
# Bounds the table of bucket starts, which is broadcast: 24 bytes a bucket. Buckets grow beyond it.
MAX_BUCKETS = 1 << 20

_SHARD, _BUCKET = "__shard_number", "__shard_bucket"


def text_size(text: str | Column) -> Column:
    """UTF-8 bytes of the text and one for its end; null has none."""
    return (F.octet_length(whole(text)) + 1).cast("bigint")


def shard_of(doc_id: str | Column, n_shards: int, seed: int = SEED) -> Column:
    """The shard with the largest hash of (seed, id, shard): id and shard count decide alone, shards are about
    equal in rows, and one more shard takes rows only into itself. Rows without id share a shard."""
    key = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    draws = [F.struct(F.xxhash64(F.lit(seed), key, F.lit(n)).alias("draw"), F.lit(n).alias("n")) for n in range(n_shards)]
    return F.greatest(*draws)["n"] if n_shards > 1 else F.lit(0)


def shuffled_shards(
    df: DataFrame,
    n_shards: int = N_SHARDS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All rows and columns of `df` with `shard` and `slot`, a gapless place from 0 in the shard.

    First pass: bytes are summed, which gives the number of buckets, and rows are scattered into
    (shard, bucket) by seeded hashes of id and text; a bucket is one partition. Second pass: the bucket,
    put into a fixed order first, is shuffled by Fisher-Yates with a seed of its own, so that a rerun or
    a repeated task gives the same order. Buckets hold about `bucket_bytes` (more above
    `MAX_BUCKETS` of them). Copies with different ids are scattered like other rows. Null ids and texts count as empty; an empty
    table gives no rows; columns named `shard` or `slot` give way to the new ones.
    """
    columns = [c for c in df.columns if c not in ("shard", "slot")]
    total = df.agg(F.sum(text_size(text))).first()[0] or 0
    per_shard = max(1, ceil(total / n_shards / max(bucket_bytes, total / MAX_BUCKETS)))
    scatter = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))
    shard = shard_of(doc_id, n_shards, seed)
    bucket = (shard * per_shard + F.pmod(scatter, F.lit(per_shard))).cast("int")
    placed = df.select(F.struct(*columns).alias("row"), scatter.alias("draw"), bucket.alias(_BUCKET))

    # The places of a bucket follow those of its shard's earlier buckets. One short row a bucket.
    earlier = W.partitionBy(_SHARD).orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)
    starts = (
        df.select(bucket.alias(_BUCKET)).groupBy(_BUCKET).count()
        .withColumn(_SHARD, F.floor(F.col(_BUCKET) / per_shard).cast("int"))
        .select(_BUCKET, _SHARD, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("start"))
    )
    # One bucket a partition: `shuffle` draws from its seed and the number of the partition.
    dealt = (
        placed.repartitionById(n_shards * per_shard, F.col(_BUCKET))
        .groupBy(_BUCKET)
        .agg(F.sort_array(F.collect_list(F.struct("draw", "row"))).alias("rows"))
        .select(_BUCKET, F.posexplode(F.shuffle("rows", seed)).alias("place", "item"))
    )
    return dealt.join(F.broadcast(starts), _BUCKET).select(
        *(F.col("item.row")[c].alias(c) for c in columns),
        F.col(_SHARD).alias("shard"),
        (F.col("start") + F.col("place")).cast("bigint").alias("slot"),
    )


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Every shard as a folder of Parquet files; `slot` keeps the order of the rows."""
    shuffled.write.partitionBy("shard").parquet(path)
