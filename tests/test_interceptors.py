"""Single-operator cases with inline expectations."""

import pytest
from pyspark.sql import functions as F

from eventflow.operators import interceptors as I
from eventflow.schema import EVENT_SCHEMA, has_header, make_rows


def events(spark, *rows):
    return spark.createDataFrame(make_rows(rows), EVENT_SCHEMA)


def bodies(df):
    return [bytes(r.body).decode() for r in df.collect()]


def headers(df):
    return [r.headers for r in df.collect()]


@pytest.mark.parametrize(
    "pattern, replacement, given, expected",
    [
        ("^cart", "", "cart of carts", " of carts"),
        ("^<[0-9]+>", "", "<4>Oct  3 04:05:06 172.16.0.9 Stop", "Oct  3 04:05:06 172.16.0.9 Stop"),
        (
            "Cart of ([a-z]+) went to ([a-z]+).",
            "$2 got the cart of $1.",
            "Cart of apples went to berlin.",
            "berlin got the cart of apples.",
        ),
        (
            r"[A-Za-z0-9_.]+@[A-Za-z0-9_-]+\.com",
            "HIDDEN",
            "from ann_1@shop.com to b.c@mail-x.com",
            "from HIDDEN to HIDDEN",
        ),
        ("^[A-Za-z0-9_]+", None, "order_77@shop.com", "@shop.com"),
        ("^[A-Za-z0-9_]+", "", "order_77@shop.com", "@shop.com"),
    ],
)
def test_search_replace(spark, pattern, replacement, given, expected):
    out = events(spark, ({}, given)).transform(I.search_replace(pattern, replacement))
    assert bodies(out) == [expected]


def test_search_replace_needs_a_pattern():
    with pytest.raises(ValueError):
        I.search_replace("")


def test_search_replace_other_charset(spark):
    df = events(spark, ({}, "x")).withColumn("body", F.encode(F.lit("grün-rot"), "ISO-8859-1"))
    out = df.transform(I.search_replace("ü", "ue", charset="ISO-8859-1"))
    assert bodies(out) == ["gruen-rot"]


def test_regex_filter_finds_anywhere(spark):
    df = events(spark, ({}, "an INFO line"), ({}, "WARNING here"), ({}, "some DEBUG line"))
    assert len(bodies(df.transform(I.regex_filter("(INFO.*)|(WARNING.*)")))) == 2
    kept = bodies(df.transform(I.regex_filter(".*DEBUG.*", exclude=True)))
    assert kept == ["an INFO line", "WARNING here"]


def test_regex_extract_groups(spark):
    df = events(spark, ({}, "1:2:3.4foobar5"), ({}, "nothing"))
    out = df.transform(I.regex_extract(r"(\d):(\d):(\d)", ["Num1", "Num2", "Num3"]))
    assert headers(out) == [{"Num1": "1", "Num2": "2", "Num3": "3"}, {}]
    assert bodies(out) == ["1:2:3.4foobar5", "nothing"]


def test_regex_extract_extra_names_and_groups_are_ignored(spark):
    df = events(spark, ({}, "a1b2"))
    assert headers(df.transform(I.regex_extract(r"a(\d)", ["x", "y"]))) == [{"x": "1"}]
    assert headers(df.transform(I.regex_extract(r"a(\d)b(\d)", ["x"]))) == [{"x": "1"}]


def test_regex_extract_null_for_missing_optional_group(spark):
    out = events(spark, ({}, "a")).transform(
        I.regex_extract(r"a(\d)?", ["n"], optional_groups=[1])
    )
    assert headers(out) == [{"n": None}]
    assert out.select(has_header("n")).first()[0]


@pytest.mark.parametrize("pattern, body, want", [
    (r"a(\d)?", "a", {"n": None}),
    (r"a(\d*)", "a", {"n": ""}),
    (r"a(\d)?", "xa a7", {"n": None}),  # of the first match, not of a later one
    (r"(?i)^k=(x)|^v=(y?)", "V=", {"n": None, "m": ""}),
    (r"(a)?(b)?c", "zz\nbc", {"n": None, "m": "b"}),
    (r"(a*)(b)?", "", {"n": "", "m": None}),
    (r"x(?=(y)?)", "x", {"n": None}),
])
def test_regex_extract_null_for_idle_groups(spark, pattern, body, want):
    df = events(spark, ({}, body))
    assert headers(df.transform(I.regex_extract(pattern, ["n", "m"]))) == [want]


def test_regex_extract_dates(spark):
    df = events(spark, ({}, "2012-10-17 14:34:44,338"))
    step = I.regex_extract(r"^(\d\d\d\d-\d\d-\d\d\s\d\d:\d\d)", ["timestamp"])
    assert headers(df.transform(step)) == [{"timestamp": "2012-10-17 14:34"}]
    step = I.regex_extract(
        r"^(\d\d\d\d-\d\d-\d\d\s\d\d:\d\d)(:\d\d,\d\d\d)",
        [("timestamp", I.as_millis("yyyy-MM-dd HH:mm")), "data"],
    )
    assert headers(df.transform(step)) == [{"timestamp": "1350484440000", "data": ":44,338"}]


def test_regex_extract_bad_date_raises(spark):
    df = events(spark, ({}, "2012-99-17"))
    step = I.regex_extract("(.*)", [("t", I.as_millis("yyyy-MM-dd"))])
    with pytest.raises(Exception):
        df.transform(step).collect()


@pytest.mark.parametrize("pattern, names", [("", ["a"]), ("(a)", []), ("(a)", [" "])])
def test_regex_extract_configuration_errors(pattern, names):
    with pytest.raises(ValueError):
        I.regex_extract(pattern, names)


NAMES = {f"my-header{n}": "v" for n in (10, 11, 12, 20, 21)}


@pytest.mark.parametrize(
    "config, left",
    [
        ({"with_name": "my-header11"}, {"10", "12", "20", "21"}),
        ({"from_list": "my-header11 , my-header12"}, {"10", "20", "21"}),
        ({"from_list": "my-header11;my-header12", "separator": ";"}, {"10", "20", "21"}),
        ({"matching": "my-header1.*"}, {"20", "21"}),
        ({"matching": "header1"}, {"10", "11", "12", "20", "21"}),
        ({"with_name": "my-header20", "matching": "my-header1[01]"}, {"12", "21"}),
        ({}, {"10", "11", "12", "20", "21"}),
    ],
)
def test_remove_headers(spark, config, left):
    out = headers(events(spark, (NAMES, "x")).transform(I.remove_headers(**config)))
    assert set(out[0]) == {f"my-header{n}" for n in left}


def test_static_preserves_by_default(spark):
    df = events(spark, ({"key": "old"}, "x"), ({"key": None}, "x"), ({}, "x"))
    assert headers(df.transform(I.add_static())) == [
        {"key": "old"}, {"key": None}, {"key": "value"}
    ]
    assert headers(df.transform(I.add_static(preserve=False))) == [{"key": "value"}] * 3


def test_timestamp_and_host_overwrite_by_default(spark):
    df = events(spark, ({"timestamp": "1", "host": "h"}, "x"))
    step = I.chain([I.add_timestamp(clock=F.lit(99)), I.add_host(host="new")])
    assert headers(df.transform(step)) == [{"timestamp": "99", "host": "new"}]
    step = I.chain([I.add_timestamp(preserve=True), I.add_host(host="new", preserve=True)])
    assert headers(df.transform(step)) == [{"timestamp": "1", "host": "h"}]


def test_timestamp_is_now(spark):
    import time

    before = time.time() * 1000
    stamped = int(headers(events(spark, ({}, "x")).transform(I.add_timestamp()))[0]["timestamp"])
    assert before - 1000 <= stamped <= time.time() * 1000 + 1000


def test_uuid(spark):
    df = events(spark, ({}, "a"), ({}, "b"), ({"id": "kept"}, "c"))
    ids = [h["id"] for h in headers(df.transform(I.add_uuid(prefix="p-")))]
    assert ids[2] == "kept" and ids[0] != ids[1] and ids[0].startswith("p-")


def test_empty_chain_and_short_circuit(spark):
    df = events(spark, ({}, "a"))
    assert bodies(df.transform(I.chain([]))) == ["a"]
    steps = [I.regex_filter("zzz"), I.regex_extract("(a)", [("t", I.as_millis("yyyy"))])]
    assert bodies(df.transform(I.chain(steps))) == []


def test_validate_counts(spark):
    df = events(spark, ({}, "ok"), ({}, "ok"), ({}, "no"), ({}, ""))
    text = F.col("body").cast("string")
    counts = I.validate_events(df, text == "ok", corrupt=text == "")
    assert {r.status: r.events for r in counts.collect()} == {"valid": 2, "invalid": 1, "corrupt": 1}
    good, bad = I.split_valid(df, text == "ok")
    assert (good.count(), bad.count()) == (2, 2)


def test_limit_size(spark):
    out = events(spark, ({}, "abcdef"), ({}, "ab")).transform(I.limit_size(3)).collect()
    assert [bytes(r.body) for r in out] == [b"abc", b"ab"]
    assert [r.headers.get("syslog.status") for r in out] == ["Incomplete", None]


def test_dedupe_keeps_events_without_an_id(spark):
    df = events(spark, ({"id": "1"}, "a"), ({"id": "1"}, "a"), ({}, "b"), ({"id": None}, "b"), ({}, "b"))
    assert sorted(bodies(I.dedupe_events(df))) == ["a", "b", "b", "b"]
