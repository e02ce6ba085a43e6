from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from fixtures import SUNDAY, YEAR_END
from pyspark.sql import functions as F

from starloom.functions import calendar, codes, coerce, keys, text
from starloom.operators.quality import COMPARISONS, compare
from starloom.schemas import DOUBLE, INT, SCALE0, STRING, table


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_epoch_ignores_the_session_zone(spark, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    assert one(spark, calendar.from_epoch_millis(F.lit(SUNDAY + 796))) == datetime(2018, 11, 4, 0, 0, 0, 796000)
    assert one(spark, calendar.from_epoch_millis(F.lit(str(SUNDAY + 796)))) == datetime(2018, 11, 4, 0, 0, 0, 796000)
    assert one(spark, calendar.from_epoch_seconds(F.lit(SUNDAY + 796))) == datetime(2018, 11, 4)
    assert one(spark, calendar.from_epoch_seconds(F.lit(None).cast("long"))) is None


@pytest.mark.parametrize("weekday,sunday,monday", [("mon0", 6, 0), ("sun1", 1, 2), ("sun0", 0, 1), ("week", 44, 1)])
def test_weekday_numberings(spark, weekday, sunday, monday):
    for ts, expected in ((SUNDAY, sunday), (YEAR_END, monday)):
        start = calendar.from_epoch_millis(F.lit(ts))
        parts = spark.range(1).select(*calendar.calendar_parts(start, weekday)).first().asDict()
        assert parts["weekday"] == expected
    assert parts == {"hour": 0, "day": 31, "week": 1, "month": 12, "year": 2018, "weekday": monday}


def test_sas_date(spark):
    assert one(spark, calendar.from_sas_date(F.lit(20545.0))) == date(2016, 4, 1)
    assert one(spark, calendar.from_sas_date(F.lit(None).cast("double"))) is None


def test_hash_key(spark):
    start = calendar.from_epoch_seconds(F.lit(SUNDAY))
    import hashlib
    assert one(spark, keys.hash_key(F.lit(10), start)) == hashlib.md5(b"102018-11-04 00:00:00").hexdigest()
    assert one(spark, keys.hash_key(F.lit(None).cast("int"), start)) is None


@pytest.mark.parametrize("value,index,kind,expected", [
    ("-74.9, 40.07", 0, "double", -74.9), ("-74.9, 40.07", 1, "double", 40.07),
    ("-74.9", 1, "double", None), ("x, y", 0, "double", None), (None, 0, "double", None), ("a,b", 1, "string", "b"),
])
def test_split_part(spark, value, index, kind, expected):
    assert one(spark, text.split_part(F.lit(value).cast("string"), ",", index, kind)) == expected


def test_split_part_takes_the_separator_literally(spark):
    assert one(spark, text.split_part(F.lit("a.b|c"), ".", 1)) == "b|c"


def test_replace_invalid_keeps_valid_text(spark):
    df = spark.createDataFrame([(bytearray(b"caf\xe9!"),), (bytearray("café �".encode()),)], "b binary")
    fixed = df.select(text.replace_invalid(F.col("b").cast("string")).alias("v"))
    assert [r["v"] for r in fixed.collect()] == ["caf^!", "café �"]


@pytest.mark.parametrize("value,half_up,cut", [(2.5, 3, 2), (-74.9, -75, -74), (-2.5, -3, -2), (200.49, 200, 200)])
def test_scale0(spark, value, half_up, cut):
    assert one(spark, coerce.to_scale0(F.lit(value))) == Decimal(half_up)
    assert one(spark, coerce.to_scale0(F.lit(value), "truncate")) == Decimal(cut)
    with pytest.raises(ValueError):
        coerce.to_scale0(F.lit(1.0), "down")


def test_conform(spark):
    df = spark.createDataFrame([(" 7 ", "12.7", ""), ("", "-0.9", "x")], "a string, b string, c string")
    schema = table(c=STRING, a=INT, b=SCALE0)
    assert rows(coerce.conform(df, schema, rounding="truncate")) == [("", 7, Decimal(12)), ("x", None, Decimal(0))]
    assert rows(coerce.conform(df, schema)) == [("", 7, Decimal(13)), ("x", None, Decimal(-1))]
    by_position = coerce.conform(df, table(x=STRING, y=DOUBLE, z=STRING), by="position")
    assert by_position.columns == ["x", "y", "z"]
    with pytest.raises(ValueError):
        coerce.conform(df, table(x=STRING), by="position")


def test_conform_bad_text(spark):
    df = spark.createDataFrame([("seven",)], "a string")
    assert rows(coerce.conform(df, table(a=INT), on_error="null")) == [(None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        coerce.conform(df, table(a=INT)).collect()


def test_code_labels(spark):
    df = spark.createDataFrame([(1.0,), (9.0,), (4.0,), (None,)], "m double")
    assert [r[0] for r in df.select(codes.label(F.col("m"), codes.TRAVEL_MODES)).collect()] == ["Air", "Not reported", None, None]


@pytest.mark.parametrize("name,expected", [("=", False), ("!=", True), (">", False), ("<", True), ("<=", True), (">=", False)])
def test_comparisons(spark, name, expected):
    assert COMPARISONS[name](1, 2) is expected
    assert one(spark, compare(F.lit(1), name, F.lit(2))) is expected
