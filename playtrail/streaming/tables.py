"""Tables that streaming queries keep up to date."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from playtrail.functions import day_of
from playtrail.streaming import runs

MICRO_BATCH = "5 seconds"

_PARTITIONS = "spark.sql.shuffle.partitions"


def keep_snapshot(
    totals: DataFrame, path: str, checkpoint: str, every: str = MICRO_BATCH, available_now: bool = False,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keep a Parquet table with the current value of every key; `read_snapshot` reads it.

    Batches carry absolute totals. They are written in turn to two folders, each by the tasks that hold
    the totals, and a batch counts once a mark says that its folder is whole. One that breaks off
    leaves the batch before it in the other folder, and one that is repeated overwrites its own, so
    nothing is lost or counted twice. Meant for totals per time bucket, whose keys stay few however
    many events there are; `state_partitions` says how many tasks share these keys.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _unmark(spark, path, batch_id)
        number = F.lit(batch_id).cast("bigint").alias("batch_id")
        batch.select("*", number).write.mode("overwrite").parquet(f"{path}/rows/slot={batch_id % 2}")
        _mark(spark, path, batch_id)

    writer = totals.writeStream.outputMode("complete").foreachBatch(write)
    return _start(totals, writer, checkpoint, every, available_now, state_partitions)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest whole batch that `keep_snapshot` has written."""
    rows = spark.read.parquet(f"{path}/rows").filter(F.col("batch_id") == _newest_mark(spark, path))
    return rows.drop("batch_id", "slot")


def keep_daily(
    totals: DataFrame, path: str, checkpoint: str, every: str = MICRO_BATCH, available_now: bool = False,
    state_partitions: int | None = None, keys: tuple[str, ...] = ("bucket",), day: Column | None = None,
) -> StreamingQuery:
    """Keep a Parquet table of streaming totals by rewriting only the days that a batch changes.

    For totals whose state is dropped behind a watermark. New rows replace those with the same keys;
    `read_daily` reads the table, `replace_days` says how it is written.
    """
    day = day_of("bucket") if day is None else day

    def write(batch: DataFrame, batch_id: int) -> None:
        def replaced(earlier: DataFrame, changed: DataFrame) -> DataFrame:
            kept = earlier.join(changed.select("day", *keys), ["day", *keys], "left_anti")
            return kept.select(*changed.columns).unionByName(changed)

        replace_days(batch.withColumn("day", day), batch_id, path, replaced, keys)

    writer = totals.writeStream.outputMode("update").foreachBatch(write)
    return _start(totals, writer, checkpoint, every, available_now, state_partitions)


def keep_sums(
    events: DataFrame, total: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, every: str = MICRO_BATCH,
    available_now: bool = False, keys: tuple[str, ...] = ("bucket",), day: Column | None = None,
) -> StreamingQuery:
    """Keep a Parquet table of totals by adding each batch's own totals to the days they fall into.

    The query has no state and no watermark: an event may come however late, its day is read, added to
    and written again. `total` sums a batch to `keys` and columns that can be added up.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        add_sums(total(batch), batch_id, path, keys, day)

    return start_batches(events, write, checkpoint, every, available_now)


def keep_totals(
    events: DataFrame, table: str, root: str, checkpoint: str, every: str = MICRO_BATCH, available_now: bool = False,
    fold_every: int = runs.FOLD_EVERY,
) -> StreamingQuery:
    """Keep the totals of parsed downloads or payments in every grain, and their panes.

    `read_totals` and `read_windows` read them. The query has no state and no watermark: an event counts
    in its own time, however late it comes. A table whose name begins with "downloads" has a count only.
    """
    if table.startswith("downloads"):
        events = events.withColumns({"paid": F.lit(0).cast("bigint"), "fee": F.lit(0).cast("bigint")})

    def write(batch: DataFrame, batch_id: int) -> None:
        changes = runs.changes_of(batch, F.array(F.lit(table)))
        runs.write_batch(batch.sparkSession, root, batch_id, changes, fold_every=fold_every)

    return start_batches(events, write, checkpoint, every, available_now)


def start_batches(
    rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str, available_now: bool
) -> StreamingQuery:
    """Start a query without state that hands each batch of rows to `write`."""
    return _start(rows, rows.writeStream.outputMode("append").foreachBatch(write), checkpoint, every, available_now, None)


def add_sums(
    sums: DataFrame, batch_id: int, path: str, keys: tuple[str, ...] = ("bucket",), day: Column | None = None
) -> None:
    """Add the sums of one batch to a table that `read_daily` reads. A repeated batch adds nothing twice."""
    names = [c for c in sums.columns if c not in keys]

    def added(earlier: DataFrame, changed: DataFrame) -> DataFrame:
        both = earlier.select(*changed.columns).unionByName(changed)
        return both.groupBy("day", *keys).agg(*[F.sum(c).alias(c) for c in names]).select(*changed.columns)

    replace_days(sums.withColumn("day", day_of("bucket") if day is None else day), batch_id, path, added, keys)


def replace_days(
    rows: DataFrame, batch_id: int, path: str, merge: Callable[[DataFrame, DataFrame], DataFrame],
    keys: tuple[str, ...], spread: int = 8,
) -> None:
    """Rewrite the days of `rows` in a table of `day` folders as `merge(earlier rows of these days, rows)`.

    A day has two folders: a batch writes to the one that doesn't hold the newest rows, which stay
    whole until a mark says that all of the batch is written. A repeated batch starts from the same
    rows and picks the same folders again. The rows of a day are written by `spread` tasks.
    """
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c != "day"]
    layout = StructType([rows.schema[c] for c in columns])
    layout = layout.add("batch_id", LongType()).add("day", StringType()).add("slot", IntegerType())
    table = f"{path}/rows"
    spark.createDataFrame([], layout).write.mode("append").partitionBy("day", "slot").parquet(table)
    _unmark(spark, path, batch_id)
    changed = rows.persist()
    try:
        # Days have eight digits, so there are at most 3.7 million: small enough to broadcast. The
        # comparison, which every day passes, tells Spark that the list is worth pruning folders by.
        days = F.broadcast(changed.select("day").distinct().filter(F.col("day") >= ""))
        stored = spark.read.schema(layout).parquet(table).filter(F.col("batch_id") < batch_id)
        touched = stored.join(days, "day", "left_semi")
        newest = touched.groupBy("day").agg(F.max_by("slot", "batch_id").alias("slot"))
        earlier = touched.join(F.broadcast(newest), ["day", "slot"], "left_semi")
        free_slot = newest.select("day", (1 - F.col("slot")).alias("slot"))
        number = F.lit(batch_id).cast("bigint").alias("batch_id")
        merged = merge(earlier, changed).join(F.broadcast(free_slot), "day", "left")
        merged = merged.select(*columns, number, "day", F.coalesce("slot", F.lit(0)).alias("slot"))
        writer = merged.repartition("day", F.pmod(F.xxhash64(*keys), F.lit(spread))).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("day", "slot").parquet(table)
    finally:
        changed.unpersist()
    _mark(spark, path, batch_id)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """The newest rows of each day, up to the newest batch that is whole.

    `path` is a table of its own, or `<root>/<table>` of a run, which is read in the grain it was started with.
    """
    run = runs.read_table(spark, path)
    if run is not None:
        return run
    rows = spark.read.parquet(f"{path}/rows").filter(F.col("batch_id") <= _newest_mark(spark, path))
    newest = rows.groupBy("day").agg(F.max_by("slot", "batch_id").alias("slot"))
    return rows.join(newest, ["day", "slot"], "left_semi").drop("batch_id", "day", "slot")


def _newest_mark(spark: SparkSession, path: str) -> int:
    """The newest whole batch, -1 before there is one."""
    marks = spark.read.schema("batch_id bigint").parquet(f"{path}/whole/slot=*")
    return marks.select(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]


def _mark(spark: SparkSession, path: str, batch_id: int, number: int | None = None) -> None:
    mark = spark.range(0, 1, 1, 1).select(F.lit(batch_id if number is None else number).cast("bigint").alias("batch_id"))
    mark.write.mode("overwrite").parquet(f"{path}/whole/slot={batch_id % 2}")


def _unmark(spark: SparkSession, path: str, batch_id: int) -> None:
    """Take back the mark of a batch that is about to be written again."""
    none = spark.range(0, 1, 1, 1).select(F.lit(-1).cast("bigint").alias("batch_id"))
    none.write.mode("ignore").parquet(f"{path}/whole/slot=none")
    if _newest_mark(spark, path) >= batch_id:
        _mark(spark, path, batch_id, batch_id - 2)


def append_rows(
    rows: DataFrame, path: str, checkpoint: str, every: str = MICRO_BATCH, available_now: bool = False,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append rows to a Parquet table exactly once. Windows are appended when their watermark passes."""
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    return _start(rows, writer, checkpoint, every, available_now, state_partitions)


def _start(
    df: DataFrame, writer, checkpoint: str, every: str, available_now: bool, state_partitions: int | None
) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    if state_partitions is None:
        return writer.start()
    # A query takes its settings along when it starts, and keeps its number of state partitions in
    # the checkpoint. The session gets its own setting back.
    conf = df.sparkSession.conf
    before = conf.get(_PARTITIONS)
    conf.set(_PARTITIONS, str(state_partitions))
    try:
        return writer.start()
    finally:
        conf.set(_PARTITIONS, before)
