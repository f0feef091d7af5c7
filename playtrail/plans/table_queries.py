"""Every operator of the library as a query over the given tables: `(spark, sf_dir) -> DataFrame`.

Queries about text, stored tables and streams write what they need into the shared folder, run the
real readers and writers on it and return the table that comes out.
"""

from collections.abc import Callable
from functools import partial, reduce
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.operators import (
    from_cells,
    games_by_city_from_counts,
    games_by_month_from_counts,
    hours_from_counts,
    measure_ranges,
    phone_model_times,
    phone_models_from_counts,
    top_games_by_city,
    top_games_by_month,
    visits_by_hour,
    with_city,
    with_row_key,
)
from playtrail.operators.keyed import BROWSE_KEY, latest_per_key
from playtrail.plans.batch import run_batch
from playtrail.plans.live import ROW_TABLES, TOTAL_TABLES, read_rows, start_live
from playtrail.plans.table_views import (
    DOWNLOADS,
    PAYMENTS,
    blocked_users,
    broken_lines,
    broken_messages,
    browse_view,
    city_ranges,
    daily_view,
    nested_ranges,
    table,
    topic_messages,
)
from playtrail.schema import BROWSE_COLUMNS
from playtrail.scratch import new_folder
from playtrail.sinks import (
    STAT_TABLES,
    add_new_files,
    clean_log,
    key_range_files,
    merge_keyed_table,
    read_counts,
    read_growing_log,
    read_key_range,
    read_stat,
    write_browse_log,
    write_cells,
    write_key_ranges,
    write_keyed_table,
    write_stat,
)
from playtrail.sources import (
    read_browse_log,
    read_cells,
    read_clean_log,
    read_keyed_table,
    read_rejected_lines,
    read_topic_files,
)
from playtrail.streaming import (
    append_rows,
    exclude_listed,
    exclude_users,
    keep_daily,
    keep_snapshot,
    keep_sums,
    keep_totals,
    measure_blocklist,
    parse_downloads,
    parse_payments,
    read_daily,
    read_snapshot,
    read_totals,
    read_windows,
    rejected_messages,
    running_downloads,
    running_payments,
)

Query = Callable[[SparkSession, str], DataFrame]

MONTH = 1  # the month the test events fall into
TOP_N = 10
GRAIN_FORMS = (("day", False), ("hour", False), ("minute", False), ("hour", True), ("minute", True))
TOTALS_PARTITIONS = 8  # totals are few and summed before they are shuffled


# Reports


def _by_month(n: int | None, use_sql: bool, spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_games_by_month(browse_view(spark, sf_dir), MONTH, n, use_sql=use_sql)


def _by_city(n: int | None, use_sql: bool, spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_games_by_city(browse_view(spark, sf_dir), city_ranges(spark, sf_dir), n, use_sql=use_sql)


def _by_phone_model(use_sql: bool, spark: SparkSession, sf_dir: str) -> DataFrame:
    return phone_model_times(browse_view(spark, sf_dir), use_sql=use_sql)


def _by_hour(use_sql: bool, spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits_by_hour(browse_view(spark, sf_dir), use_sql=use_sql)


def ip_to_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = browse_view(spark, sf_dir).select("event_id", "ip")
    return with_city(visits, city_ranges(spark, sf_dir))


def ip_to_city_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way for range tables that are too large to broadcast."""
    ranges = measure_ranges(city_ranges(spark, sf_dir), broadcast_limit_bytes=0)
    return with_city(browse_view(spark, sf_dir).select("event_id", "ip"), ranges)


def ip_to_city_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges inside ranges and across their ends: the narrowest counts."""
    ranges = measure_ranges(nested_ranges(spark, sf_dir), nested=True)
    return with_city(browse_view(spark, sf_dir).select("event_id", "ip"), ranges)


def top_games_by_city_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = measure_ranges(city_ranges(spark, sf_dir), broadcast_limit_bytes=0)
    return top_games_by_city(browse_view(spark, sf_dir), ranges)


# Text and stored logs


def browse_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "browse-text")
    write_browse_log(browse_view(spark, sf_dir), path)
    return _plain_times(read_browse_log(spark, path))


def browse_log_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, stored = new_folder(spark, "broken-text"), new_folder(spark, "broken-clean")
    broken_lines(spark, sf_dir).write.text(text)
    clean_log(spark, text, stored)
    return read_rejected_lines(spark, stored)


def clean_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, stored = new_folder(spark, "browse-text"), new_folder(spark, "browse-clean")
    write_browse_log(browse_view(spark, sf_dir), text)
    clean_log(spark, text, stored, rebalance=True)
    return _plain_times(read_clean_log(spark, stored))


def _growing_log(spark: SparkSession, sf_dir: str) -> str:
    """A log that came in two loads of new files, and a third one without."""
    text, target = new_folder(spark, "growing-text"), new_folder(spark, "growing-log")
    visits = browse_view(spark, sf_dir)
    came_first = F.col("phoneModel").isin("click", "view")
    for part in (visits.where(came_first), visits.where(~came_first)):
        write_browse_log(part, text)
        add_new_files(spark, text, target, rebalance=True)
    if add_new_files(spark, text, target):
        raise RuntimeError("files were parsed twice")
    return target


def growing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(read_growing_log(spark, _growing_log(spark, sf_dir)))


def games_by_city_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = read_counts(spark, _growing_log(spark, sf_dir), "games")
    return games_by_city_from_counts(counts, city_ranges(spark, sf_dir), None)


def games_by_month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return games_by_month_from_counts(read_counts(spark, _growing_log(spark, sf_dir), "games"), MONTH)


def phone_models_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phone_models_from_counts(read_counts(spark, _growing_log(spark, sf_dir), "phone_models"))


def visits_by_hour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hours_from_counts(read_counts(spark, _growing_log(spark, sf_dir), "hours"))


def games_of_newest_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The games of the last day of the log, from that day's counts alone."""
    target = _growing_log(spark, sf_dir)
    newest = read_growing_log(spark, target).agg(F.max(F.substring("date", 1, 8))).first()[0]
    counts = read_counts(spark, target, "games", days=[newest])
    return games_by_month_from_counts(counts, int(newest[4:6])).drop("month").withColumn("day", F.lit(newest))


def _batch(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The result tables of a whole batch run."""
    text, stored, root = (new_folder(spark, label) for label in ("batch-text", "batch-clean", "batch-stat"))
    write_browse_log(browse_view(spark, sf_dir), text)
    run_batch(spark, text, stored, city_ranges(spark, sf_dir), MONTH, stat_root=root)
    return {report: read_stat(spark, report, root) for report in STAT_TABLES}


def batch_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch run, summed up: rows and visits of each result table."""
    summaries = [
        rows.agg(F.lit(report).alias("report"), F.count("*").alias("result_rows"), F.sum("times").alias("visits"))
        for report, rows in _batch(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, summaries)


def batch_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of every result table of the batch run."""
    return reduce(DataFrame.unionByName, [_as_values(report, rows) for report, rows in _batch(spark, sf_dir).items()])


# Keyed tables


def row_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = with_row_key(browse_view(spark, sf_dir))
    return keyed.select("event_id", "row_key")


def _keyed_table(spark: SparkSession, sf_dir: str) -> str:
    """Store the visits of some event types, then merge the others into them."""
    visits = daily_view(spark, sf_dir)
    stored_first = F.col("phoneModel").isin("click", "view", "signup")
    path = new_folder(spark, "keyed")
    write_keyed_table(visits.filter(stored_first), path, BROWSE_KEY, ["event_id"])
    merge_keyed_table(spark, path, visits.filter(~stored_first), BROWSE_KEY, ["event_id"])
    return path


def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_keyed_table(spark, _keyed_table(spark, sf_dir)).select("event_id", *BROWSE_COLUMNS)


def keyed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The games report over a keyed table, which counts each key once."""
    log = read_keyed_table(spark, _keyed_table(spark, sf_dir), "by_month")
    return top_games_by_month(log, MONTH)


def keyed_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visits of one week out of a table that is kept by ranges of its key."""
    first = daily_view(spark, sf_dir).agg(F.min("date")).first()[0]
    # A full day behind the first; row keys begin with the date.
    low, high = (f"{int(first) + k}" for k in (1, 8))
    path = new_folder(spark, "key-ranges")
    keyed = with_row_key(daily_view(spark, sf_dir)).select("row_key", "event_id", *BROWSE_COLUMNS)
    write_key_ranges(keyed, path, files=16)
    if len(key_range_files(spark, path, low, high)) > 12:
        raise RuntimeError("a range of a week opens most of the table")
    return read_key_range(spark, path, keyed.schema, low, high).drop("row_key")


def _stored_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "cells")
    newest = latest_per_key(daily_view(spark, sf_dir), BROWSE_KEY, ["event_id"])
    write_cells(with_row_key(newest, exact=True), path)
    return read_cells(spark, path)


def cells_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_cells(_stored_cells(spark, sf_dir))


# Result tables


def _stat_sink(report: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write one report twice and read its table."""
    queries = {
        "by_month": partial(_by_month, None, False),
        "by_city": partial(_by_city, 3, False),
        "by_phone_model": partial(_by_phone_model, False),
        "by_hour": partial(_by_hour, False),
    }
    root = new_folder(spark, "stat")
    for _ in range(2):
        write_stat(queries[report](spark, sf_dir), report, root)
    return read_stat(spark, report, root)


# Streams


def _stream_of(messages: DataFrame, batches: int = 3) -> DataFrame:
    """Land messages as files and stream them back in a few micro-batches."""
    spark = messages.sparkSession
    path = new_folder(spark, "messages")
    per_file = max(1, ceil(messages.count() / batches))
    messages.write.option("maxRecordsPerFile", per_file).parquet(path)
    files = len(spark.read.parquet(path).inputFiles())
    return read_topic_files(spark, path, max(1, ceil(files / batches)))


def _finish(start: Callable, rows: DataFrame, label: str, state_partitions: int | None = None) -> str:
    spark = rows.sparkSession
    path, checkpoint = new_folder(spark, label), new_folder(spark, f"{label}-checkpoint")
    query = start(rows, path, checkpoint, available_now=True, state_partitions=state_partitions)
    query.awaitTermination()
    return path


def _snapshot_of(totals: DataFrame, label: str, state_partitions: int | None = TOTALS_PARTITIONS) -> DataFrame:
    path = _finish(keep_snapshot, totals, label, state_partitions)
    return _plain_times(read_snapshot(totals.sparkSession, path))


def _appended(rows: DataFrame, label: str) -> DataFrame:
    return _plain_times(rows.sparkSession.read.parquet(_finish(append_rows, rows, label)))


def _blocked_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "blocked")
    blocked_users(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def _downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_downloads(_stream_of(topic_messages(spark, sf_dir)), DOWNLOADS)


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_payments(_stream_of(topic_messages(spark, sf_dir)), PAYMENTS)


def _totals_of(events: DataFrame, table: str) -> str:
    """Where a run keeps the totals of these events in every grain."""
    spark = events.sparkSession
    root, checkpoint = new_folder(spark, table), new_folder(spark, f"{table}-checkpoint")
    keep_totals(events, table, root, checkpoint, available_now=True).awaitTermination()
    return root


def _downloads_by(grain: str, pooled: bool, spark: SparkSession, sf_dir: str) -> DataFrame:
    if pooled:
        return _snapshot_of(running_downloads(_downloads(spark, sf_dir), grain, pooled), "downloads")
    return read_totals(spark, _totals_of(_downloads(spark, sf_dir), "downloads"), "downloads", grain)


def _payments_by(grain: str, pooled: bool, spark: SparkSession, sf_dir: str) -> DataFrame:
    if pooled:
        return _snapshot_of(running_payments(_payments(spark, sf_dir), grain, pooled), "payments")
    return read_totals(spark, _totals_of(_payments(spark, sf_dir), "payments"), "payments", grain)


def _every_grain(table: str, events: Callable, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals of one run in all grains, also pooled ones."""
    root = _totals_of(events(spark, sf_dir), table)
    found = [
        read_totals(spark, root, table, grain, pooled).select(F.lit(f"{grain}_pooled" if pooled else grain).alias("grain"), "*")
        for grain, pooled in GRAIN_FORMS
    ]
    return reduce(DataFrame.unionByName, found)


def _kept_sums(events: DataFrame, total: Callable, label: str, **settings) -> DataFrame:
    """Totals that each batch adds to, of which it writes only the days it changes."""
    spark = events.sparkSession
    path, checkpoint = new_folder(spark, label), new_folder(spark, f"{label}-checkpoint")
    keep_sums(events, total, path, checkpoint, available_now=True, **settings).awaitTermination()
    return _plain_times(read_daily(spark, path))


def downloads_by_hour_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = partial(running_downloads, grain="hour")
    return _kept_sums(_downloads(spark, sf_dir), total, "downloads-sums")


def _whole_span(spark: SparkSession, sf_dir: str) -> str:
    """A day more than the time the events span: in whatever order they come, none is behind such a watermark."""
    seconds = F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))
    return f"{86_400 + (table(spark, sf_dir, 'events').agg(seconds).first()[0] or 0)} seconds"


def payments_by_minute_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals behind a watermark, of which each batch writes only the days it changes."""
    totals = running_payments(_payments(spark, sf_dir), "minute", watermark=_whole_span(spark, sf_dir))
    return read_daily(spark, _finish(keep_daily, totals, "payments-daily", TOTALS_PARTITIONS))


def downloads_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(read_windows(spark, _totals_of(_downloads(spark, sf_dir), "downloads"), "downloads"))


def payments_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(read_windows(spark, _totals_of(_payments(spark, sf_dir), "payments"), "payments"))


def downloads_not_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = exclude_users(_downloads(spark, sf_dir), _blocked_table(spark, sf_dir))
    return _appended(kept.select("time", "day", "hour", "minute", "user_id"), "downloads-open")


def downloads_not_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blocklist as one that is too long to broadcast: a filter first, the exact join for what it lets through."""
    blocked = measure_blocklist(_blocked_table(spark, sf_dir).hint("merge"))
    kept = exclude_listed(_downloads(spark, sf_dir), blocked)
    return _appended(kept.select("time", "day", "hour", "minute", "user_id"), "downloads-not-listed")


def payments_not_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = exclude_users(_payments(spark, sf_dir), _blocked_table(spark, sf_dir), salt=1)
    return _appended(kept.select("order_id", "day", "hour", "minute", "user_id", "paid", "fee"), "payments-open")


def downloads_by_day_not_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = exclude_users(_downloads(spark, sf_dir), _blocked_table(spark, sf_dir))
    return _snapshot_of(running_downloads(kept), "downloads-open-totals", None)


def payments_by_day_not_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = exclude_users(_payments(spark, sf_dir), _blocked_table(spark, sf_dir))
    return _snapshot_of(running_payments(kept), "payments-open-totals", None)


def topic_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _stream_of(broken_messages(spark, sf_dir))
    return _appended(rejected_messages(messages, PAYMENTS, payment=True).select("value", "reason"), "rejects")


def _live(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables of a whole streaming run over three batches, folded once in between."""
    root, checkpoints = new_folder(spark, "live"), new_folder(spark, "live-checkpoints")
    messages, blocked = _stream_of(topic_messages(spark, sf_dir)), _blocked_table(spark, sf_dir)
    start_live(messages, blocked, root, checkpoints, DOWNLOADS, PAYMENTS, available_now=True, fold_every=2).awaitTermination()
    rows = {name: read_rows(spark, f"{root}/{name}") for name in ROW_TABLES}
    return rows | {name: read_daily(spark, f"{root}/{name}") for name in TOTAL_TABLES}


def live_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole streaming run, summed up: rows and events of its tables."""
    summaries = []
    for name, rows in _live(spark, sf_dir).items():
        events = F.count("*") if name in ROW_TABLES else F.sum("downloads" if "downloads" in rows.columns else "orders")
        summaries.append(rows.agg(F.lit(name).alias("output"), F.count("*").alias("result_rows"), events.alias("events")))
    return reduce(DataFrame.unionByName, summaries)


def _as_values(name: str, rows: DataFrame) -> DataFrame:
    """The rows of a table as text: its name, and every column's value by its name."""
    shown = [F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kind.startswith("timestamp") else F.col(c).cast("string") for c, kind in rows.dtypes]
    values = [F.concat(F.lit(f"{c}="), F.coalesce(value, F.lit("null"))) for c, value in sorted(zip(rows.columns, shown, strict=True), key=lambda x: x[0])]
    return rows.select(F.lit(name).alias("output"), F.concat_ws(";", *values).alias("row"))


def live_run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of every table of the streaming run."""
    return reduce(DataFrame.unionByName, [_as_values(name, rows) for name, rows in _live(spark, sf_dir).items()])


def stat_sink_empty_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month table after its month was filled and then written again without rows."""
    root = new_folder(spark, "stat")
    report = _by_month(None, False, spark, sf_dir)
    write_stat(report, "by_month", root, MONTH)
    write_stat(report.filter(F.col("times") < 0), "by_month", root, MONTH)
    return read_stat(spark, "by_month", root)


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the given tables have them."""
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


def table_queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "top_games_by_month": partial(_by_month, TOP_N, False),
        "games_by_month_all": partial(_by_month, None, False),
        "report_month_sql": partial(_by_month, TOP_N, True),
        "top_games_by_city": partial(_by_city, 3, False),
        "games_by_city_ranked": partial(_by_city, None, False),
        "report_city_sql": partial(_by_city, 3, True),
        "top_games_by_city_shuffled": top_games_by_city_shuffled,
        "phone_model_times": partial(_by_phone_model, False),
        "report_phone_sql": partial(_by_phone_model, True),
        "visits_by_hour": partial(_by_hour, False),
        "report_hour_sql": partial(_by_hour, True),
        "browse_log_parse": browse_log_parse,
        "browse_log_rejects": browse_log_rejects,
        "clean_roundtrip": clean_roundtrip,
        "ip_to_city": ip_to_city,
        "ip_to_city_shuffled": ip_to_city_shuffled,
        "ip_to_city_nested": ip_to_city_nested,
        "row_key": row_keys,
        "keyed_upsert": keyed_upsert,
        "keyed_scan": keyed_scan,
        "keyed_range": keyed_range,
        "cells_unpivot": _stored_cells,
        "cells_pivot": cells_pivot,
        "stat_sink_month": partial(_stat_sink, "by_month"),
        "stat_sink_city": partial(_stat_sink, "by_city"),
        "stat_sink_phone": partial(_stat_sink, "by_phone_model"),
        "stat_sink_hour": partial(_stat_sink, "by_hour"),
        "stat_sink_empty_month": stat_sink_empty_month,
        "growing_log": growing_log,
        "games_by_city_counts": games_by_city_counts,
        "games_by_month_counts": games_by_month_counts,
        "phone_models_counts": phone_models_counts,
        "visits_by_hour_counts": visits_by_hour_counts,
        "games_of_newest_day": games_of_newest_day,
        "batch_reports": batch_reports,
        "batch_report_rows": batch_report_rows,
    }
    for grain, pooled in GRAIN_FORMS:
        suffix = f"{grain}_pooled" if pooled else grain
        found[f"downloads_by_{suffix}"] = partial(_downloads_by, grain, pooled)
        found[f"payments_by_{suffix}"] = partial(_payments_by, grain, pooled)
    found |= {
        "downloads_by_hour_daily": downloads_by_hour_daily,
        "payments_by_minute_daily": payments_by_minute_daily,
        "downloads_sliding": downloads_sliding,
        "payments_sliding": payments_sliding,
        "downloads_not_blocked": downloads_not_blocked,
        "downloads_not_listed": downloads_not_listed,
        "payments_not_blocked": payments_not_blocked,
        "downloads_by_day_not_blocked": downloads_by_day_not_blocked,
        "payments_by_day_not_blocked": payments_by_day_not_blocked,
        "topic_rejects": topic_rejects,
        "live_run": live_run,
        "live_run_rows": live_run_rows,
        "downloads_every_grain": partial(_every_grain, "downloads", _downloads),
        "payments_every_grain": partial(_every_grain, "payments", _payments),
    }
    return found
