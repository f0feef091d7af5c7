import zlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playtrail.functions import bucket, compact_timestamp, exact_row_key, hour_of, ipv4_number, month_of, row_key


def one(spark, schema, row, *columns):
    return tuple(spark.createDataFrame([row], schema).select(*columns).first())


def test_row_key_is_date_and_unsigned_crc32(spark):
    row = ("201803052231", "44.12.8.90", 205)
    plain, exact = one(spark, "date string, ip string, gameId int", row, row_key(), exact_row_key())
    assert plain == "201803052231_877754284"
    assert exact == "201803052231_877754284_44.12.8.90_205"


def test_row_key_of_empty_text_is_zero(spark):
    (key,) = one(spark, "date string, ip string, gameId string", ("d", "", ""), row_key())
    assert key == "d_0"


def test_row_key_is_ambiguous_where_exact_key_is_not(spark):
    rows = [("d", "1.1.1.1", 23), ("d", "1.1.1.12", 3)]
    df = spark.createDataFrame(rows, "date string, ip string, gameId int")
    assert df.select(row_key()).distinct().count() == 1
    assert df.select(exact_row_key()).distinct().count() == 2


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=12), min_size=1, max_size=20))
def test_row_key_agrees_with_zlib(spark, texts):
    df = spark.createDataFrame([("d", t, 7) for t in texts], "date string, ip string, gameId int")
    expected = [f"d_{zlib.crc32((t + '7').encode())}" for t in texts]
    assert [r[0] for r in df.select(row_key()).collect()] == expected


@pytest.mark.parametrize(
    "ip,number",
    [
        ("0.0.0.0", 0),
        ("10.0.0.5", 167772165),
        ("255.255.255.255", 4294967295),
        ("300.1.1.1", None),
        ("1.1.1", None),
        ("1.1.1.1.1", None),
        ("1.1.1.-1", None),
        ("1..1.1", None),
        ("99999999999.1.1.1", None),
        ("a.b.c.d", None),
        ("", None),
        (None, None),
    ],
)
def test_ipv4_number(spark, ip, number):
    assert one(spark, "ip string", (ip,), ipv4_number("ip")) == (number,)


@pytest.mark.parametrize(
    "time,expected",
    [
        ("20210417093559", "2021-04-17 09:35:59"),
        ("202104170935", "2021-04-17 09:35:00"),
        ("2021041709355", "2021-04-17 09:35:50"),
        ("20210417093559123", "2021-04-17 09:35:59"),
        ("20210417", None),
        ("2019", None),
        ("20211317093559", None),
        ("20210417253559", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_compact_timestamp(spark, time, expected):
    (found,) = one(spark, "time string", (time,), compact_timestamp("time").cast("string"))
    assert found == expected


def test_time_parts(spark):
    found = one(spark, "t string", ("201803052231",), month_of("t"), hour_of("t"))
    assert found == (3, "22")
    assert one(spark, "t string", ("2018xx",), month_of("t")) == (None,)


@pytest.mark.parametrize(
    "grain,pooled,expected",
    [
        ("day", False, "20210417"),
        ("hour", False, "2021041709"),
        ("minute", False, "202104170935"),
        ("day", True, "20210417"),
        ("hour", True, "09"),
        ("minute", True, "35"),
    ],
)
def test_bucket(spark, grain, pooled, expected):
    assert one(spark, "t string", ("20210417093559",), bucket("t", grain, pooled)) == (expected,)


def test_bucket_rejects_other_grains():
    with pytest.raises(ValueError):
        bucket(F.lit("x"), "week")
