"""Message streams: a DataFrame of `topic` and `value`, whatever brings the messages in."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.schema import TOPIC_MESSAGE


def kafka_options(
    brokers: str, topics: list[str], group_id: str | None = None, starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source. After a restart the checkpoint decides where to go on."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_kafka(spark: SparkSession, **settings) -> DataFrame:
    """Subscribe to topics; needs Spark's Kafka connector among the session's packages."""
    raw = spark.readStream.format("kafka").options(**kafka_options(**settings)).load()
    return raw.select("topic", F.col("value").cast("string").alias("value"))


def read_topic_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Messages that land as Parquet files of `topic` and `value` in a folder."""
    reader = spark.readStream.schema(TOPIC_MESSAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
