"""From raw documents to token ids: quality rules, exact copies, near copies, the mix of sources, pieces."""

from pyspark.sql import DataFrame, SparkSession

from playtrail.llm.exact_dedup import drop_exact_copies
from playtrail.llm.mixing import mixed
from playtrail.llm.ngram_join import drop_near_copies
from playtrail.llm.pieces import encode
from playtrail.llm.quality import quality
from playtrail.llm.text import documents, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality(docs).where("kept").select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that similar sets of five-word shingles connect."""
    return drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document."""
    return encode(docs)


# What the stages do hangs on hashes and merges that SQL can't express; tests hold them against plain code.
STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram join", near_stage),
    ("mixing sources", mixing_stage),
    ("piece encoding", encoding_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in their order, each written to the shared folder and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
