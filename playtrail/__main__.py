"""Command line: `spark-submit ... -m playtrail batch ...` or `... live ...`; see the README."""

import argparse

from pyspark.sql import SparkSession

from playtrail.plans import run_batch, start_live
from playtrail.sources import read_kafka, read_topic_files


def _arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="playtrail")
    parser.add_argument("--zone", default="UTC", help="time zone of the session")
    commands = parser.add_subparsers(dest="command", required=True)

    batch = commands.add_parser("batch", help="store a browse log and write its four reports")
    batch.add_argument("--source", required=True, help="raw text log")
    batch.add_argument("--clean", required=True, help="folder of the clean table, replaced")
    batch.add_argument("--ranges", required=True, help="Parquet table of ip_lo, ip_hi, city")
    batch.add_argument("--month", required=True, type=int)
    batch.add_argument("--top", type=int, help="length of the month and phone model reports; all rows if left out")
    batch.add_argument("--keyed", help="count a keyed table, written to this folder, instead of every visit")
    batch.add_argument("--stat", help="folder of the Parquet result tables")
    batch.add_argument("--jdbc", help="URL of the database with the result tables")
    batch.add_argument("--rebalance", action="store_true", help="the log files mix months")

    live = commands.add_parser("live", help="keep totals of the download and payment topics")
    source = live.add_mutually_exclusive_group(required=True)
    source.add_argument("--brokers", help="Kafka bootstrap servers")
    source.add_argument("--files", help="folder of Parquet files with topic and value")
    live.add_argument("--group", help="Kafka consumer group")
    live.add_argument("--downloads", required=True, help="download topic")
    live.add_argument("--payments", required=True, help="payment topic")
    live.add_argument("--blocked", required=True, help="Parquet table of user_id")
    live.add_argument("--out", required=True, help="folder of the tables")
    live.add_argument("--checkpoints", required=True)
    live.add_argument("--grain", choices=["day", "hour", "minute"], default="day")
    live.add_argument("--pooled", action="store_true", help="add up equal hours or minutes of all days")
    live.add_argument("--every", default="5 seconds", help="micro-batch interval")
    live.add_argument("--once", action="store_true", help="stop when everything there is has been read")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"playtrail {args.command}").getOrCreate()
    # Log times have no zone; one with daylight saving would move some of them.
    spark.conf.set("spark.sql.session.timeZone", args.zone)
    if args.command == "batch":
        run_batch(
            spark, args.source, args.clean, spark.read.parquet(args.ranges), args.month,
            stat_root=args.stat, jdbc_url=args.jdbc, keyed_path=args.keyed, n=args.top, rebalance=args.rebalance,
        )
        return
    if args.files:
        messages = read_topic_files(spark, args.files)
    else:
        messages = read_kafka(
            spark, brokers=args.brokers, topics=[args.downloads, args.payments], group_id=args.group
        )
    start_live(
        messages, spark.read.parquet(args.blocked), args.out, args.checkpoints, args.downloads, args.payments,
        args.grain, args.pooled, args.every, args.once,
    ).awaitTermination()  # raises if the query fails


if __name__ == "__main__":
    main()
