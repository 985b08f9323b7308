import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmill import functions as S


def one(spark, column, **values):
    """Evaluate a column over a row of values given as (value, type)."""
    names = ", ".join(f"{n} {kind}" for n, (_, kind) in values.items())
    df = spark.createDataFrame([tuple(v for v, _ in values.values())], names)
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "millis, kept, cut",
    [
        (1541106106796, dt.datetime(2018, 11, 1, 21, 1, 46, 796000), dt.datetime(2018, 11, 1, 21, 1, 46)),
        (0, dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 1)),
        (-1500, dt.datetime(1969, 12, 31, 23, 59, 58, 500000), dt.datetime(1969, 12, 31, 23, 59, 59)),
        (None, None, None),
    ],
)
def test_epoch(spark, millis, kept, cut):
    for kind in ("double", "bigint"):
        value = None if millis is None else (float(millis) if kind == "double" else millis)
        assert one(spark, S.epoch_millis("a"), a=(value, kind)) == kept
        assert one(spark, S.epoch_seconds("a"), a=(value, kind)) == cut
        assert one(spark, S.epoch_to_date("a"), a=(value, kind)) == (kept and kept.date())


def test_sas_days(spark):
    assert one(spark, S.sas_day_to_date("a"), a=(20573.0, "double")) == dt.date(2016, 4, 29)
    assert one(spark, S.sas_day_to_timestamp("a"), a=(20573.0, "double")) == dt.datetime(2016, 4, 29)
    assert one(spark, S.sas_day_to_date("a"), a=(None, "double")) is None


def test_text_dates(spark):
    assert one(spark, S.parse_date("a", "MMddyyyy"), a=("09302016", "string")) == dt.date(2016, 9, 30)
    assert one(spark, S.parse_date("a", "MMddyyyy"), a=("D/S", "string")) is None
    assert one(spark, S.parse_timestamp("a"), a=("2016-09-30 01:02:03", "string")) == dt.datetime(2016, 9, 30, 1, 2, 3)
    assert one(spark, S.parse_timestamp("a"), a=("soon", "string")) is None


@pytest.mark.parametrize("weekday, sunday, monday", [("sun1", 1, 2), ("sun0", 0, 1), ("mon0", 6, 0)])
def test_weekdays(spark, weekday, sunday, monday):
    parts = lambda d: one(spark, S.calendar_parts("a", weekday)["weekday"], a=(d, "timestamp"))
    assert parts(dt.datetime(2018, 11, 4)) == sunday
    assert parts(dt.datetime(2018, 11, 5)) == monday


def test_calendar_parts(spark):
    moment = dt.datetime(2018, 12, 31, 21, 1, 46)
    values = {p: one(spark, c, a=(moment, "timestamp")) for p, c in S.calendar_parts("a").items()}
    assert values == {"hour": 21, "day": 31, "week": 1, "month": 12, "year": 2018, "weekday": 2}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.datetimes(dt.datetime(1971, 1, 1), dt.datetime(2100, 1, 1)), min_size=1, max_size=30))
def test_calendar_parts_agree_with_the_calendar(spark, moments):
    df = spark.createDataFrame([(m,) for m in moments], "a timestamp")
    for weekday, of in (
        ("sun1", lambda m: m.isoweekday() % 7 + 1),
        ("sun0", lambda m: m.isoweekday() % 7),
        ("mon0", lambda m: m.weekday()),
    ):
        parts = S.calendar_parts("a", weekday)
        got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in parts.items()]).collect()]
        assert got == [(m.hour, m.day, m.isocalendar()[1], m.month, m.year, of(m)) for m in moments]


def test_md5_key(spark):
    key = S.md5_key("a", "b")
    want = hashlib.md5(b"9912018-11-01 21:01:46").hexdigest()
    moment = (dt.datetime(2018, 11, 1, 21, 1, 46), "timestamp")
    assert one(spark, key, a=(991, "int"), b=moment) == want
    assert one(spark, key, a=(None, "int"), b=moment) is None
    assert one(spark, S.md5_key("a", "b", sep="-"), a=("x", "string"), b=("y", "string")) == hashlib.md5(b"x-y").hexdigest()


def test_generated_keys_tell_null_positions_apart(spark):
    df = spark.createDataFrame([("x", None), (None, "x"), ("x", ""), (None, None)], "a string, b string")
    for key in (S.hash_key("a", "b"), S.row_key("a", "b")):
        assert df.select(key.alias("k")).distinct().count() == 4


@pytest.mark.parametrize(
    "value, kind, plain, zero_null",
    [
        (346608285.0, "double", 346608285, 346608285),
        (0.0, "double", 0, None),
        ("12", "string", 12, 12),
        ("12.9", "string", 12, 12),
        ("x", "string", None, None),
        (None, "double", None, None),
    ],
)
def test_as_long(spark, value, kind, plain, zero_null):
    assert one(spark, S.as_long("a"), a=(value, kind)) == plain
    assert one(spark, S.as_long("a", zero_is_null=True), a=(value, kind)) == zero_null


def test_rounding(spark):
    assert one(spark, S.rounded_decimal("a"), a=(153.5, "double")) == Decimal(154)
    assert one(spark, S.rounded_decimal("a"), a=(-153.5, "double")) == Decimal(-154)


def test_pairs(spark):
    text = ("-84.5, 33.25", "string")
    assert one(spark, S.pair_part("a", 0), a=text) == "-84.5"
    assert one(spark, S.pair_part("a", 1), a=text) == " 33.25"
    assert one(spark, S.pair_part("a", 1, as_type="double"), a=text) == 33.25
    assert one(spark, S.pair_part("a", 2), a=text) is None


def test_code_text(spark):
    assert one(spark, S.code_text("a"), a=(582.0, "double")) == "582"
    assert one(spark, S.code_text("a"), a=(None, "double")) is None


@pytest.mark.parametrize(
    "number, company, mode, intended, strict",
    [
        ("00296", "VES", 1.0, "00296", "00296"),
        (None, "QFAIR", 1.0, "noQFA1.0", "no"),
        ("", None, 2.0, "no2.0", "no2.0"),
        (None, None, 0.0, "no", "no"),
        (None, None, None, "no", "no"),
    ],
)
def test_fallback_identifier(spark, number, company, mode, intended, strict):
    values = {"a": (number, "string"), "b": (company, "string"), "c": (mode, "double")}
    assert one(spark, S.fallback_identifier("a", "b", "c"), **values) == intended
    assert one(spark, S.fallback_identifier("a", "b", "c", strict=True), **values) == strict


def test_share_percent(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (4,)], "a int")
    assert df.agg(S.share_percent(F.col("a").isNull()).alias("x")).first().x == 25.0
