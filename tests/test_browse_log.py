import pytest
from pyspark.errors import PySparkException

from playtrail.schema import BROWSE_COLUMNS
from playtrail.sinks import clean_log, write_browse_log
from playtrail.sources import read_browse_log, read_clean_log, read_rejected_lines, rejected_lines
from tests.conftest import plan_of, rows_of

GOOD = "44.12.8.90\t[2018-03-05 22:31:47]\t(Android o,Nine pro)\t象戏\t205"
GOOD_ROW = ("44.12.8.90", "201803052231", "Android o", "Nine pro", "象戏", 205)


def parsed(spark, path):
    return rows_of(read_browse_log(spark, path).select(*BROWSE_COLUMNS))


def test_good_line(spark, text_file):
    path = text_file(GOOD)
    assert parsed(spark, path) == [GOOD_ROW]
    assert str(read_browse_log(spark, path).first().event_time) == "2018-03-05 22:31:47"


@pytest.mark.parametrize(
    "line,change",
    [
        (GOOD + "\textra", {}),
        (GOOD.replace("[", ""), {}),  # only the closing bracket is needed
        (GOOD.replace(":16]", ":16.250]"), {}),
        (GOOD.replace("(Android", "((And(roid"), {}),
        (GOOD.replace("pro)", "pro))"), {}),
        (GOOD.replace("Nine pro", ",x"), {"phoneModel": ""}),
        (GOOD.replace("Nine pro", "Phone, 7"), {"phoneModel": "Phone"}),
        (GOOD.replace("Nine pro", "_"), {"phoneModel": "_"}),
        (GOOD.replace("205", "+205"), {}),
        (GOOD.replace("205", "-205"), {"gameId": -205}),
        (GOOD.replace("205", "0205"), {}),
        (GOOD.replace("象戏", ""), {"gameName": ""}),
        (GOOD.replace("44.12.8.90", ""), {"ip": ""}),
    ],
)
def test_unusual_lines_that_parse(spark, text_file, line, change):
    expected = {**dict(zip(BROWSE_COLUMNS, GOOD_ROW)), **change}
    assert parsed(spark, text_file(line)) == [tuple(expected.values())]


BAD = [
    ("", "fewer than five fields"),
    ("a\tb\tc\td", "fewer than five fields"),
    (GOOD.replace("\t", " "), "fewer than five fields"),
    (GOOD.replace("03-05", "13-05"), "unreadable time"),
    (GOOD.replace("[", "").replace("]", ""), "unreadable time"),
    (GOOD.replace("2018-03-05 22:31:47", "yesterday"), "unreadable time"),
    (GOOD.replace(",", ";"), "unreadable device"),
    (GOOD.replace("Nine pro)", ""), "unreadable device"),
    (GOOD.replace("205", "x"), "unreadable game id"),
    (GOOD.replace("205", " 205"), "unreadable game id"),
    (GOOD.replace("205", "1.0"), "unreadable game id"),
    (GOOD.replace("205", ""), "unreadable game id"),
    (GOOD.replace("205", "99999999999"), "unreadable game id"),
]


def test_bad_lines_are_rejected_with_reason(spark, text_file):
    path = text_file(GOOD, *[line for line, _ in BAD])
    assert parsed(spark, path) == [GOOD_ROW]
    assert rows_of(rejected_lines(spark, path)) == sorted(BAD)


def test_failfast_stops_at_a_bad_line_whatever_is_selected(spark, text_file):
    with pytest.raises(PySparkException, match="unreadable game id"):
        read_browse_log(spark, text_file(GOOD, BAD[-1][0]), mode="failfast").select("gameName").collect()
    assert read_browse_log(spark, text_file(GOOD), mode="failfast").count() == 1
    with pytest.raises(ValueError):
        read_browse_log(spark, text_file(GOOD), mode="ignore")


@pytest.mark.parametrize("rebalance", [False, True])
def test_clean_log_keeps_both_kinds_and_can_run_again(spark, text_file, tmp_path, rebalance):
    path, stored = text_file(GOOD, GOOD.replace("03-05", "04-05"), BAD[1][0]), str(tmp_path / "clean")
    for _ in range(2):
        clean_log(spark, path, stored, rebalance)
    log = read_clean_log(spark, stored)
    assert sorted((r.year, r.month, r.date) for r in log.collect()) == [
        (2018, 3, "201803052231"), (2018, 4, "201804052231")
    ]
    assert rows_of(read_rejected_lines(spark, stored)) == [BAD[1]]


def test_clean_log_of_nothing(spark, text_file, tmp_path):
    clean_log(spark, text_file(), str(tmp_path / "clean"))
    assert read_clean_log(spark, str(tmp_path / "clean")).count() == 0
    assert read_rejected_lines(spark, str(tmp_path / "clean")).count() == 0


def test_month_filter_reads_only_its_folder_and_needed_columns(spark, text_file, tmp_path):
    stored = str(tmp_path / "clean")
    clean_log(spark, text_file(GOOD, GOOD.replace("03-05", "04-05")), stored)
    plan = plan_of(read_clean_log(spark, stored).filter("month = 3").select("gameId"))
    assert "ReadSchema: struct<gameId:int>" in plan
    partition_filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "month" in partition_filters and "status" in partition_filters


def test_text_round_trip_and_append(spark, text_file, tmp_path):
    log = read_browse_log(spark, text_file(GOOD))
    out = str(tmp_path / "out")
    write_browse_log(log, out, "overwrite")
    assert rows_of(read_browse_log(spark, out)) == rows_of(log)
    write_browse_log(log.drop("event_time"), out)
    assert parsed(spark, out) == [GOOD_ROW, GOOD_ROW]
    assert {r.value for r in spark.read.text(out).collect()} == {GOOD, GOOD.replace(":47]", ":00]")}


def test_parser_computes_the_time_once(spark, text_file):
    plan = plan_of(read_browse_log(spark, text_file(GOOD)))
    filters = [part for part in plan.split("\n") if "Filter " in part]
    assert filters and not any("regexp_extract" in line for line in filters)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_times_with_parts_of_one_digit(spark, text_file):
    path = text_file(GOOD.replace("2018-03-05 22:31:47", "2018-3-5 1:2:3"))
    assert read_browse_log(spark, path).first().date == "201803050102"


@pytest.mark.parametrize("change", [{"gameName": "tab\t7"}, {"phoneModel": "m(1),x"}, {"ip": None}])
def test_rows_that_text_can_not_hold_are_refused(spark, tmp_path, change):
    row = {**dict(zip(BROWSE_COLUMNS, GOOD_ROW)), **change}
    schema = "ip string, date string, androidVersion string, phoneModel string, gameName string, gameId int"
    df = spark.createDataFrame([tuple(row[c] for c in BROWSE_COLUMNS)], schema)
    with pytest.raises(PySparkException, match="can't hold"):
        write_browse_log(df, str(tmp_path / "out"))
