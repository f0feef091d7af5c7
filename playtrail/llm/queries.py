"""The text operators as queries over the given tables, each over the whole of its table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.llm.chat import format_chats, loss_text, read_back
from playtrail.llm.exact_dedup import exact_groups
from playtrail.llm.hard_negatives import hard_negatives
from playtrail.llm.line_dedup import repeated_lines
from playtrail.llm.mixing import mix
from playtrail.llm.ngram_join import near_groups
from playtrail.llm.pieces import encode
from playtrail.llm.pii import find_pii
from playtrail.llm.quality import quality
from playtrail.llm.ranked_search import search
from playtrail.llm.sharding import N_SHARDS, SEED, shard_of, shuffled_shards, text_size
from playtrail.llm.substring_dedup import repeated_passages
from playtrail.llm.text import documents, whole
from playtrail.llm.toxicity import THRESHOLD, held_out, score, train


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = documents(spark, sf_dir)
    model = train(texts, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(texts, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffled_shards(documents(spark, sf_dir)).select(
        "doc_id",
        text_size("text").alias("size"),
        F.crc32(whole("text")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        shard_of("doc_id", N_SHARDS + 1, SEED).alias("grown_shard"),
    )


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(documents(spark, sf_dir), min_words=1).select("doc_id", "n_lines", "n_removed", "kept_sha256")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    noisy = given.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(noisy, anchors=F.col("vec_id") % 50 == 0)


# A conversation that says what the template's own marks say.
_PLANTED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    chats = format_chats(given.unionByName(spark.createDataFrame(_PLANTED, "conv_id bigint, turn bigint, role string, text string")))
    back = chats.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("learned"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def llm_queries() -> dict:
    found = [
        op1_pii,
        op2_substring_dedup,
        op3_toxicity,
        op4_quality_rules,
        op5_sharding,
        op6_ngram_join,
        op7_line_dedup,
        op8_mixing,
        op9_exact_dedup,
        op10_sentencepiece,
        op11_hard_negatives,
        op12_chat_formatting,
        op13_ranked_search,
    ]
    return {query.__name__: query for query in found}
