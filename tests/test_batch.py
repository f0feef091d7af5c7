import pytest

from playtrail.plans import run_batch
from playtrail.scratch import new_folder, shared_folder
from playtrail.sinks import read_stat
from playtrail.sources import read_rejected_lines
from tests.conftest import rows_of

LINE = "1.0.0.{ip}\t[2018-03-04 {hour}:10:{second}]\t(Android o,{phone})\tg{game}\t{game}"


@pytest.fixture
def ranges(spark):
    return spark.createDataFrame([(1 << 24, (1 << 24) + 255, "A")], "ip_lo bigint, ip_hi bigint, city string")


@pytest.fixture
def log(text_file):
    same_minute = [LINE.format(ip=1, hour="09", second=s, phone="m", game=7) for s in ("01", "02", "03")]
    return text_file(*same_minute, LINE.format(ip=2, hour="10", second="00", phone="_", game=8), "broken")


def test_batch_run_fills_all_result_tables_and_can_run_again(spark, log, ranges, tmp_path):
    clean, root = str(tmp_path / "clean"), str(tmp_path / "stat")
    for _ in range(2):
        run_batch(spark, log, clean, ranges, 3, stat_root=root)
    assert rows_of(read_stat(spark, "by_month", root)) == [(3, "g7", 7, 3), (3, "g8", 8, 1)]
    assert rows_of(read_stat(spark, "by_city", root)) == [("A", 7, "g7", 3, 1), ("A", 8, "g8", 1, 2)]
    assert rows_of(read_stat(spark, "by_phone_model", root)) == [("_", 1), ("m", 3)]
    assert rows_of(read_stat(spark, "by_hour", root)) == [("09", 3), ("10", 1)]
    assert [r.line for r in read_rejected_lines(spark, clean).collect()] == ["broken"]


def test_keyed_run_counts_a_minute_once(spark, log, ranges, tmp_path):
    root = str(tmp_path / "stat")
    run_batch(
        spark, log, str(tmp_path / "clean"), ranges, 3, stat_root=root, keyed_path=str(tmp_path / "keyed")
    )
    assert rows_of(read_stat(spark, "by_hour", root)) == [("09", 1), ("10", 1)]


def test_scratch_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert new_folder(spark, "x").startswith(shared_folder(spark))
