from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.functions.fields import is_missing, nan_to_null, to_nullable_int, too_long
from starload.functions.text import null_if_empty, read_fields
from starload.functions.times import datetime_text, in_year, parse_datetime


def one(spark, value, column, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "line, fields",
    [
        ("1,a,b", ["1", "a", "b"]),
        ("", [""]),
        (",", ["", ""]),
        ("1,,", ["1", "", ""]),
        (r"1,a\,b,c", ["1", "a,b", "c"]),
        (r"1,a\\,b", ["1", "a\\", "b"]),
        (r"1,a\\\,b", ["1", "a\\,b"]),
        (r"1,\N,x", ["1", None, "x"]),
        (r"1,x\N,\Ny", ["1", "xN", "Ny"]),
        (r"a\nb\tc\rd\0e\bf\Zg\qh", ["a\nb\tc\rd\x00e\bf\x1agqh"]),
        (r"\\n,\\\n", ["\\n", "\\\n"]),
        (r"\\\\n\\t", ["\\\\n\\t"]),
        ('"1",it\'s "x"', ['"1"', 'it\'s "x"']),
        ("1,line\nfeed,é✓", ["1", "line\nfeed", "é✓"]),
        ("1,end\\", ["1", "end\\"]),
    ],
)
def test_read_fields(spark, line, fields):
    assert one(spark, line, read_fields(F.col("v"))) == fields


def test_read_fields_many_escapes(spark):
    line = r"\,\n\\" * 20_000
    assert one(spark, line + ",x", read_fields(F.col("v"))) == [",\n\\" * 20_000, "x"]


@pytest.mark.parametrize("separator", ["|", ";", "\t", "^", "."])
def test_read_fields_other_separators(spark, separator):
    line = separator.join(["a", rf"b\{separator}c", "", "d\\\\"])
    assert one(spark, line, read_fields(F.col("v"), separator)) == ["a", f"b{separator}c", "", "d\\"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2021-07-27T16:02:08Z", datetime(2021, 7, 27, 16, 2, 8)),
        ("2021-07-27 16:02:08", datetime(2021, 7, 27, 16, 2, 8)),
        ("2021-07-27", datetime(2021, 7, 27)),
        ("2021-7-5 1:02", datetime(2021, 7, 5, 1, 2)),
        ("2021-12-31 23:59:59.5", datetime(2022, 1, 1)),
        ("2021-12-31 23:59:59.499999", datetime(2021, 12, 31, 23, 59, 59)),
        ("2021-03-28T02:30:00Z", datetime(2021, 3, 28, 2, 30)),
        ("2021-02-30", None),
        ("2021-13-01", None),
        ("2021", None),
        ("2021-07", None),
        ("12:00:00", None),
        ("NaT", None),
        ("", None),
        (None, None),
        ("yesterday", None),
    ],
)
def test_parse_datetime(spark, text, expected):
    assert one(spark, text, parse_datetime(F.col("v"))) == expected


def test_times_do_not_pass_through_the_session_zone(spark):
    """02:30 on that day does not exist in this zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        text = "2021-03-28 02:30:00"
        assert one(spark, text, datetime_text(parse_datetime(F.col("v")))) == text
        assert one(spark, "2021-03-28 02:29:59.7", datetime_text(parse_datetime(F.col("v")))) == text
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_datetime_text_keeps_midnight(spark):
    assert one(spark, datetime(2021, 1, 1), datetime_text(F.col("v")), "timestamp_ntz") == "2021-01-01 00:00:00"
    assert one(spark, None, datetime_text(F.col("v")), "timestamp_ntz") is None


def test_in_year_bounds(spark):
    times = [datetime(2020, 12, 31, 23, 59, 59), datetime(2021, 1, 1), datetime(2021, 12, 31, 23, 59, 59),
             datetime(2022, 1, 1), None]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    assert [r["t"] for r in df.where(in_year(F.col("t"), 2021)).collect()] == times[1:3]


def test_null_if_empty(spark):
    assert one(spark, "", null_if_empty(F.col("v"))) is None
    assert one(spark, " ", null_if_empty(F.col("v"))) == " "


@pytest.mark.parametrize("value, missing", [("", True), (None, True), (" ", False), ("0", False)])
def test_missing_text(spark, value, missing):
    assert one(spark, value, is_missing(F.col("v"), T.StringType())) is missing


@pytest.mark.parametrize("value, missing", [(0, True), (None, True), (-1, False)])
def test_missing_number(spark, value, missing):
    assert one(spark, value, is_missing(F.col("v"), T.IntegerType()), "int") is missing


def test_length_counts_characters(spark):
    assert one(spark, "é" * 255, too_long(F.col("v"), 255)) is False
    assert one(spark, "é" * 256, too_long(F.col("v"), 255)) is True
    assert one(spark, None, too_long(F.col("v"), 255)) is False


def test_nullable_numbers(spark):
    assert one(spark, 7.0, to_nullable_int(F.col("v")), "double") == 7
    assert one(spark, float("nan"), to_nullable_int(F.col("v")), "double") is None
    assert one(spark, "x", to_nullable_int(F.col("v"))) is None
    assert one(spark, float("nan"), nan_to_null(F.col("v")), "double") is None
    assert one(spark, 1.5, nan_to_null(F.col("v")), "double") == 1.5
