from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventflow.functions import bucketing as B
from eventflow.schema import EVENT_SCHEMA, make_rows


def ms(*parts, zone=timezone.utc, milli=0):
    return int(datetime(*parts, tzinfo=zone).timestamp() * 1000) + milli


def expand(spark, pattern, headers, **options):
    df = spark.createDataFrame(make_rows([(headers, "")]), EVENT_SCHEMA)
    return df.select(B.bucket_path(pattern, **options)).first()[0]


def at(*parts, **kw):
    return {"timestamp": str(ms(*parts, **kw))}


@pytest.mark.parametrize(
    "unit, value, expected",
    [("second", 60, (15, 12, 0)), ("minute", 5, (15, 10, 0)), ("hour", 2, (14, 0, 0))],
)
def test_round_down(spark, unit, value, expected):
    given = ms(2012, 6, 15, 15, 12, 54, milli=20)
    got = spark.range(1).select(B.round_down(F.lit(given), unit, value)).first()[0]
    assert got == ms(2012, 6, 15, *expected)


def test_round_down_limits(spark):
    with pytest.raises(ValueError):
        B.round_down(F.lit(1), "hour", 25)
    with pytest.raises(ValueError):
        B.round_down(F.lit(1), "day", 1)
    with pytest.raises(Exception):
        spark.range(1).select(B.round_down(F.lit(0), "hour", 1)).collect()


def brute_round(millis, unit, n, zone):
    """The rounded wall time of the zone, as an instant."""
    t = datetime.fromtimestamp(millis / 1000, zone).replace(microsecond=0)
    if unit == "second":
        t = t.replace(second=t.second - t.second % n)
    elif unit == "minute":
        t = t.replace(minute=t.minute - t.minute % n, second=0)
    else:
        t = t.replace(hour=t.hour - t.hour % n, minute=0, second=0, fold=0)
    return int(t.timestamp() * 1000)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.integers(946684800000, 1900000000000), min_size=20, max_size=60),
    st.sampled_from(["second", "minute", "hour"]),
    st.integers(1, 24),
    st.sampled_from(["UTC", "Asia/Kolkata", "America/Sao_Paulo", "Asia/Tokyo"]),
)
def test_round_down_against_calendar(spark, stamps, unit, n, zone):
    if zone == "America/Sao_Paulo":  # midnight clock changes before 2020 are ambiguous
        stamps = [max(s, 1580000000000) for s in stamps]
    df = spark.createDataFrame([(s,) for s in stamps], "ms long")
    got = [r[0] for r in df.select(B.round_down(F.col("ms"), unit, n, zone)).collect()]
    assert got == [brute_round(s, unit, n, ZoneInfo(zone)) for s in stamps]


@pytest.mark.parametrize("hour", range(0, 24))
def test_hour_rounding_over_a_clock_change(spark, hour):
    zone = ZoneInfo("America/New_York")
    for day in ((2024, 3, 10), (2024, 11, 3)):
        given = ms(*day, hour, 30, zone=zone)
        got = spark.range(1).select(B.round_down(F.lit(given), "hour", 12, "America/New_York")).first()[0]
        wall = datetime.fromtimestamp(given / 1000, zone).hour
        assert got == ms(*day, 0 if wall < 12 else 12, zone=zone)


def test_rounded_tokens(spark):
    h = at(2012, 6, 23, 13, 46, 33, milli=234)
    assert expand(spark, "%c", h, round_unit="hour", round_value=12) == "Sat Jun 23 12:00:00 2012"
    assert expand(spark, "%s", h, round_unit="minute", round_value=5) == str(
        ms(2012, 6, 23, 13, 45) // 1000
    )
    assert expand(spark, "%t", h, round_unit="hour") == h["timestamp"]


@pytest.mark.parametrize("day, expected", [((2014, 5, 3), "5-3"), ((2014, 11, 13), "11-13")])
def test_unpadded_date(spark, day, expected):
    assert expand(spark, "%n-%e", at(*day)) == expected


def test_clock_is_read_once(spark):
    clock = F.lit(ms(2024, 1, 1, 2, 59, 59, milli=999))
    assert expand(spark, "%H:%M", {}, clock=clock, round_unit="minute", round_value=10) == "02:50"


def test_zone(spark):
    h = at(2024, 7, 1, 12, 0)
    assert expand(spark, "%H%M %z", h, tz="America/New_York") == "0800 -0400"
    assert expand(spark, "%H%M %z", h, tz="Asia/Kolkata") == "1730 +0530"


def test_headers_literals_and_unknown_letters(spark):
    h = {**at(2024, 1, 2), "a.b-c": "x$1\\", "it's": "q"}
    assert expand(spark, "/%{a.b-c}/it's/%{none}/%d%%%Q", h) == "/x$1\\/it's//02%"
    assert expand(spark, "%{a.b-c}", {"a.b-c": "v"}) == "v"
    assert expand(spark, "no tokens", {}) == "no tokens"


def test_static_names(spark):
    names = B.static_names("h", "1.2.3.4", "h.example.org")
    assert expand(spark, "%[LocalHost] %[ip] %[FQDN]", {}, statics=names) == "h 1.2.3.4 h.example.org"
    with pytest.raises(ValueError):
        B.bucket_path("%[other]")


@pytest.mark.parametrize("headers", [{}, {"timestamp": "soon"}, {"timestamp": None}])
@pytest.mark.parametrize("pattern", ["%Y", "%%", "%Q"])
def test_time_tokens_need_a_timestamp(spark, headers, pattern):
    with pytest.raises(Exception):
        expand(spark, pattern, headers)


def test_index_name(spark):
    df = spark.createDataFrame(
        make_rows([({"timestamp": "0"}, ""), ({"timestamp": " ", "@timestamp": "86400000"}, ""), ({}, "")]),
        EVENT_SCHEMA,
    )
    names = df.select(B.index_name("i", mode="time", clock=F.lit(172800000))).collect()
    assert [r[0] for r in names] == ["i-1970-01-01", "i-1970-01-02", "i-1970-01-03"]
    with pytest.raises(ValueError):
        B.index_name("i", mode="weekly")


def test_dates_share_one_format_call(spark):
    df = spark.createDataFrame(make_rows([(at(2024, 1, 2), "")]), EVENT_SCHEMA)
    plan = df.select(B.bucket_path("%{x}/%Y-%m-%d/%H%M").alias("b"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("date_format") == 1
