"""The whole streaming run: every running figure of the two message topics at once."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playtrail.streaming.blocklist import flag_blocked
from playtrail.streaming.events import parse_messages
from playtrail.streaming.runs import FOLD_EVERY, changes_of, read_run_rows, write_batch, write_settings
from playtrail.streaming.tables import MICRO_BATCH, start_batches

WINDOW_KEYS = ("window_start", "window_end")
# The tables of a run: rows as they come, and totals.
ROW_TABLES = (
    "downloads_not_blocked", "payments_not_blocked", "downloads_rejected", "payments_rejected",
)
TOTAL_TABLES = (
    "downloads", "payments", "downloads_not_blocked_totals", "payments_not_blocked_totals",
    "downloads_sliding", "payments_sliding",
)
_EVENT = ["time", "day", "hour", "minute", "event_time", "user_id", "game_id"]


def start_live(
    messages: DataFrame, blocked: DataFrame, root: str, checkpoints: str,
    download_topic: str, payment_topic: str, grain: str = "day", pooled: bool = False,
    every: str = MICRO_BATCH, available_now: bool = False, salt: int = 8, fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Start the one query that fills every table below `root`.

    A batch is read, parsed and held against the blocklist once. Its rows are written in one go and the changes
    of all its totals in another; then one mark makes them visible in every table together. The query has no
    state: an event counts however late it comes, and every window is there when the run ends. A repeated batch
    changes nothing.

    `read_rows` reads a table of rows, `read_daily` one of totals in `grain` or of ten-second windows. All
    other grains and windows are there as well, for `read_totals` and `read_windows`.
    """
    write_settings(messages.sparkSession, root, grain=grain, pooled=pooled)
    kind = F.col("kind")
    open_table = F.concat(kind, F.lit("_not_blocked"))
    counted = F.when(F.col("blocked"), F.array(kind)).otherwise(F.array(kind, F.concat(open_table, F.lit("_totals"))))

    def write(batch: DataFrame, batch_id: int) -> None:
        events = flag_blocked(parse_messages(batch, download_topic, payment_topic), blocked, salt).persist()
        try:
            fine = F.col("reason").isNull()
            table = F.when(fine, open_table).otherwise(F.concat(kind, F.lit("_rejected")))
            rows = events.where(~fine | ~F.col("blocked")).withColumn("table", table)
            kept = rows.withColumn("value", F.when(~fine, F.col("value"))).drop("kind", "blocked")
            write_batch(batch.sparkSession, root, batch_id, changes_of(events.where(fine), counted, F.array(kind)), kept, fold_every)
        finally:
            events.unpersist()

    return start_batches(messages, write, checkpoints, every, available_now)


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of one table of a run (`<root>/<table>`), of all batches that are whole."""
    root, table = path.rstrip("/").rsplit("/", 1)
    if table.endswith("_rejected"):
        columns = ["topic", "value", "reason"]
    else:
        columns = [*_EVENT, "order_id", "paid", "fee"] if table.startswith("payments") else _EVENT
    return read_run_rows(spark, root, table).select(*columns)
