from playtrail.__main__ import main
from playtrail.schema import TOPIC_MESSAGE
from playtrail.sinks import read_stat
from playtrail.streaming import read_daily
from tests.conftest import rows_of
from tests.test_browse_log import GOOD
from tests.test_streaming import DOWNLOAD


def test_batch(spark, text_file, tmp_path):
    ranges, clean, stat = (str(tmp_path / name) for name in ("ranges", "clean", "stat"))
    spark.createDataFrame([(0, 2**32 - 1, "A")], "ip_lo bigint, ip_hi bigint, city string").write.parquet(ranges)
    source = text_file(GOOD, GOOD)
    main(["batch", "--source", source, "--clean", clean, "--ranges", ranges, "--month", "3", "--stat", stat])
    assert rows_of(read_stat(spark, "by_city", stat)) == [("A", 205, "象戏", 2, 1)]


def test_live(spark, tmp_path):
    files, blocked, out, checkpoints = (str(tmp_path / name) for name in ("files", "blocked", "out", "checkpoints"))
    spark.createDataFrame([("d", DOWNLOAD)], TOPIC_MESSAGE).write.parquet(files)
    spark.range(3).withColumnRenamed("id", "user_id").write.parquet(blocked)
    main(["live", "--files", files, "--downloads", "d", "--payments", "p", "--blocked", blocked, "--out", out,
          "--checkpoints", checkpoints, "--grain", "hour", "--once"])
    assert rows_of(read_daily(spark, f"{out}/downloads")) == [("2021041709", 1)]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
