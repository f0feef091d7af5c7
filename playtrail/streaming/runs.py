"""The tables of a streaming run: the rows of each batch, and totals as a log of changes.

A batch writes its rows in one go and the changes of all its totals in another, each to a folder of
its own, and counts for every table at once when its mark is set. Nothing that is there is read or
written again, so a batch costs the same however much the run has gathered. Totals are added up when they
are read; every so often the changes since the last time are folded into the days that they touch.

Events are added to one pane of five seconds and one minute each. Hours and days come from the minutes
of the batch, sliding windows from the panes when they are read.

    rows/batch=*/table=*        rows of all tables, by batch
    changes/batch=*             changes of all totals, by batch
    base/day=*/upto=*           totals of a day with all changes up to a batch
    marks/*, folded/*           empty files named after the newest whole batch, and the newest folded one
"""

import json
from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.functions import GRAINS, bucket
from playtrail.scratch import names_below, remove_folder

PANE_SECONDS = 5
# Batches between two foldings. Readers add up so many folders of changes at most.
FOLD_EVERY = 50

_SUMS = ["events", "paid", "fee_total", "fee_paid"]
_KEYS = ["table", "grain", "bucket", "start", "day"]
_CHANGES = "table string, grain string, bucket string, start bigint, day string, events bigint, paid bigint, fee_total bigint, fee_paid bigint"
_PANE = "pane"
_BASE_TASKS = 8


def changes_of(events: DataFrame, tables: Column, paned: Column | None = None) -> DataFrame:
    """The totals of a batch in every grain: one row for each table, grain and bucket that it changes.

    `events` have `time`, `event_time`, `paid` and `fee`; `tables` names the tables that an event counts in,
    `paned` those that need panes (all of them if left out). Events are summed to panes within their tasks;
    the coarser grains are made of what that leaves.
    """
    second = F.unix_seconds("event_time")
    finest = events.groupBy(
        tables.alias("tables"),
        (tables if paned is None else paned).alias("paned"),
        bucket("time", "minute").alias("minute"),
        (second - F.pmod(second, F.lit(PANE_SECONDS))).alias("start"),
    ).agg(
        F.count("*").alias("events"),
        F.sum("paid").alias("paid"),
        F.sum("fee").alias("fee_total"),
        F.sum(F.col("fee") * F.col("paid")).alias("fee_paid"),
    )
    no_start = F.lit(None).cast("bigint")

    def key(grain: str, name: Column, start: Column) -> Column:
        return F.struct(F.lit(grain).alias("grain"), name.alias("bucket"), start.alias("start"))

    coarse = F.array(*[key(grain, bucket("minute", grain), no_start) for grain in GRAINS])
    fine = F.array(key(_PANE, F.lit(None).cast("string"), F.col("start")))
    day = bucket("minute", "day").alias("day")
    one_table = finest.select("*", F.explode("tables").alias("table"))
    grains = F.when(F.array_contains("paned", F.col("table")), F.concat(coarse, fine)).otherwise(coarse)
    keyed = one_table.select("table", day, *_SUMS, F.explode(grains).alias("key"))
    return _added(keyed.select("table", "key.*", "day", *_SUMS))


def _added(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*_KEYS).agg(*[F.sum(name).alias(name) for name in _SUMS])


# Marks


def _folder(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _newest(spark: SparkSession, path: str) -> int:
    return max((int(name) for name in names_below(spark, path) if name.isdigit()), default=-1)


def _set_mark(spark: SparkSession, path: str, number: int) -> None:
    """Creates the new mark, then takes away all but the one before it. A file that exists is whole: it is empty."""
    older = sorted(int(name) for name in names_below(spark, path) if name.isdigit() and int(name) < number)
    system, mark = _folder(spark, f"{path}/{number}")
    system.create(mark, True).close()
    for stale in older[:-1]:
        remove_folder(spark, f"{path}/{stale}")


def newest_batch(spark: SparkSession, root: str) -> int:
    """The newest batch that all tables of the run show, -1 before there is one."""
    return _newest(spark, f"{root}/marks")


# Writing


def write_batch(
    spark: SparkSession, root: str, batch_id: int, changes: DataFrame | None = None, rows: DataFrame | None = None, fold_every: int = FOLD_EVERY
) -> bool:
    """Write the `changes` of a batch (`changes_of`) and its `rows` (with a column `table`), then set its mark.

    Whatever breaks off before the mark shows in no table, and the batch's next try replaces it. A batch
    that has its mark is not written again, which the return value tells: streams repeat a batch with the same input.
    """
    newest = newest_batch(spark, root)
    if batch_id < newest:
        raise ValueError(f"{root} is at batch {newest}, the stream at {batch_id}: a folder belongs to one checkpoint")
    if batch_id == newest:
        return False
    if rows is not None:
        rows.write.mode("overwrite").partitionBy("table").parquet(f"{root}/rows/batch={batch_id}")
    if changes is not None:
        changes.select("table", "grain", "bucket", "start", "day", *_SUMS).write.mode("overwrite").parquet(f"{root}/changes/batch={batch_id}")
    _set_mark(spark, f"{root}/marks", batch_id)
    if changes is not None and batch_id - _newest(spark, f"{root}/folded") >= fold_every:
        fold(spark, root)
    return True


def fold(spark: SparkSession, root: str) -> None:
    """Fold the changes that are whole into the days they touch; other days are neither read nor written.

    Readers go on with the state before until the mark is set. A folding that broke off leaves folders that the
    next one supersedes: it touches the same days and has a higher number. What the state before the present
    one needed is deleted, so a reader has one folding's time to finish.
    """
    before, upto = _newest(spark, f"{root}/folded"), newest_batch(spark, root)
    if upto <= before:
        return
    changed = _changes(spark, root, before, upto)
    # At most 3.7 million, as days have eight digits. The comparison, which all pass, lets Spark prune folders by them.
    days = changed.select("day").distinct().where("day >= ''")
    earlier = _base(spark, root, before)
    if earlier is not None:
        changed = earlier.join(F.broadcast(days), "day", "left_semi").select(*changed.columns).unionByName(changed)
    spread = F.pmod(F.xxhash64("table", "grain", "bucket", "start"), F.lit(_BASE_TASKS))
    totals = _added(changed).withColumn("upto", F.lit(upto).cast("bigint")).repartition("day", spread)
    totals.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "upto").parquet(f"{root}/base")
    _set_mark(spark, f"{root}/folded", upto)
    for row in days.toLocalIterator():
        versions = sorted(int(name.removeprefix("upto=")) for name in names_below(spark, f"{root}/base/day={row.day}") if name.startswith("upto="))
        for stale in [v for v in versions if v <= before][:-1]:
            remove_folder(spark, f"{root}/base/day={row.day}/upto={stale}")
    for name in names_below(spark, f"{root}/changes"):
        if name.startswith("batch=") and int(name.removeprefix("batch=")) <= before:
            remove_folder(spark, f"{root}/changes/{name}")


# Reading


def _changes(spark: SparkSession, root: str, after: int, upto: int) -> DataFrame:
    """The changes of the batches behind `after`, up to `upto`."""
    if not any(name.startswith("batch=") for name in names_below(spark, f"{root}/changes")):
        return spark.createDataFrame([], _CHANGES)
    read = spark.read.schema(f"{_CHANGES}, batch bigint").parquet(f"{root}/changes")
    return read.where((F.col("batch") > after) & (F.col("batch") <= upto)).drop("batch")


def _base(spark: SparkSession, root: str, upto: int) -> DataFrame | None:
    """The folded totals as of `upto`, None if nothing was folded."""
    if upto < 0 or not any(name.startswith("day=") for name in names_below(spark, f"{root}/base")):
        return None
    columns = [part for part in _CHANGES.split(", ") if not part.startswith("day")]
    read = spark.read.schema(", ".join([*columns, "day string", "upto bigint"])).parquet(f"{root}/base")
    held = read.where(F.col("upto") <= upto)
    newest = held.groupBy("day").agg(F.max("upto").alias("upto"))
    return held.join(F.broadcast(newest), ["day", "upto"], "left_semi").drop("upto")


def _totals(spark: SparkSession, root: str, table: str, grain: str, days: list[str] | None = None) -> DataFrame:
    folded = _newest(spark, f"{root}/folded")
    changes, base = _changes(spark, root, folded, newest_batch(spark, root)), _base(spark, root, folded)
    found = changes if base is None else changes.unionByName(base.select(*changes.columns))
    found = found.where((F.col("table") == table) & (F.col("grain") == grain))
    return found if days is None else found.where(F.col("day").isin(days))


def _sums(table: str) -> list[Column]:
    if table.startswith("downloads"):
        return [F.sum("events").alias("downloads")]
    return [F.sum("events").alias("orders"), *[F.sum(name).alias(name) for name in _SUMS[1:]]]


def read_totals(
    spark: SparkSession, root: str, table: str, grain: str = "day", pooled: bool = False, days: list[str] | None = None
) -> DataFrame:
    """`bucket` and the sums of a table in any grain, up to the newest whole batch.

    `pooled` adds up equal hours or minutes of all days. `days` reads only these days (`yyyyMMdd`); of the
    folded totals no other folder is opened.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
    found = _totals(spark, root, table, grain, days)
    name = F.col("bucket") if not pooled or grain == "day" else F.substring("bucket", {"hour": 9, "minute": 11}[grain], 2)
    return found.groupBy(name.alias("bucket")).agg(*_sums(table))


def read_windows(
    spark: SparkSession, root: str, table: str, length: int = 10, slide: int = 5, days: list[str] | None = None
) -> DataFrame:
    """`window_start, window_end` and the sums of sliding windows, `length` and `slide` in seconds.

    Windows start at multiples of `slide` since the epoch; both are multiples of the pane's five seconds.
    Each pane is added to the windows it lies in.
    """
    if min(length, slide) <= 0 or length % PANE_SECONDS or slide % PANE_SECONDS:
        raise ValueError(f"length and slide must be multiples of {PANE_SECONDS} seconds")
    panes = _totals(spark, root, table, _PANE, days).groupBy("start").agg(*[F.sum(name).alias(name) for name in _SUMS])
    last = F.col("start") - F.pmod("start", F.lit(slide))
    # The last window that starts by the pane, and those before it that still reach it.
    first = last - F.floor((F.lit(length - PANE_SECONDS) - (F.col("start") - last)) / slide).cast("bigint") * slide
    reached = panes.where(F.col("start") - last < length).withColumn("window", F.explode(F.sequence(first, last, F.lit(slide).cast("bigint"))))
    summed = reached.groupBy("window").agg(*_sums(table))
    times = [F.timestamp_seconds("window").alias("window_start"), F.timestamp_seconds(F.col("window") + length).alias("window_end")]
    return summed.select(*times, *[c for c in summed.columns if c != "window"])


def read_run_rows(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows of one table, of all batches that are whole."""
    rows = spark.read.parquet(f"{root}/rows")
    return rows.where((F.col("batch") <= newest_batch(spark, root)) & (F.col("table") == table)).drop("batch", "table")


# What a run was started with


def write_settings(spark: SparkSession, root: str, **settings) -> None:
    system, path = _folder(spark, f"{root}/settings.json")
    out = system.create(path, True)
    out.write(bytearray(json.dumps(settings).encode()))
    out.close()


def read_settings(spark: SparkSession, root: str) -> dict | None:
    """The settings of the run whose folder this is, None if it isn't one."""
    system, path = _folder(spark, f"{root}/settings.json")
    if not system.exists(path):
        return None
    return json.loads(spark.read.text(f"{root}/settings.json", wholetext=True).first()[0])


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The totals `<root>/<table>` in the grain that the run was started with, or its ten-second windows; None if there is no run."""
    root, table = path.rstrip("/").rsplit("/", 1)
    settings = read_settings(spark, root)
    if settings is None:
        return None
    if table.endswith("_sliding"):
        return read_windows(spark, root, table.removesuffix("_sliding"))
    return read_totals(spark, root, table, settings["grain"], settings["pooled"])
