from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from eventflow.functions import syslog as S

HOST = "node-7.shop.test"


def parse(spark, *lines, **options):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "n int, body string")
    return [(r.headers, bytes(r.body).decode()) for r in S.parse_syslog(df, **options).orderBy("n").collect()]


def ms(*parts, milli=0):
    return str(int(datetime(*parts, tzinfo=timezone.utc).timestamp() * 1000) + milli)


@pytest.mark.parametrize(
    "line, stamp, host",
    [
        (f"<10>1 2021-09-07T11:11:11 {HOST} disk is full", ms(2021, 9, 7, 11, 11, 11), HOST),
        (f"<10>1 2021-09-07T11:11:11Z {HOST} disk is full", ms(2021, 9, 7, 11, 11, 11), HOST),
        (f"<10>1 2021-09-07T11:11:11+08:00 {HOST} disk is full", ms(2021, 9, 7, 3, 11, 11), HOST),
        (f"<10>2021-09-07T11:11:11+08:00 {HOST} disk is full", ms(2021, 9, 7, 3, 11, 11), HOST),
        (f"<10>1 - {HOST} disk is full", None, HOST),
        ("<10>1 2021-09-07T11:11:11 - disk is full", ms(2021, 9, 7, 11, 11, 11), None),
        (f"<10>1 2021-09-07T11:11:11.999 {HOST} disk is full", ms(2021, 9, 7, 11, 11, 11, milli=999), HOST),
        (f"<10>1 2021-09-07T11:11:11.999999Z {HOST} disk is full", ms(2021, 9, 7, 11, 11, 11, milli=999), HOST),
        (f"<10>1 2021-09-07T11:11:11.5+01:00 {HOST} disk is full", ms(2021, 9, 7, 10, 11, 11, milli=500), HOST),
    ],
)
def test_rfc5424(spark, line, stamp, host):
    [(headers, body)] = parse(spark, line)
    assert (headers["Facility"], headers["Severity"], headers["priority"]) == ("1", "2", "10")
    assert headers.get("timestamp") == stamp and headers.get("host") == host
    assert ("version" in headers) == line.startswith("<10>1 ")
    assert body == "disk is full" and "syslog.status" not in headers


def test_compat_ignores_the_zone_after_a_fraction(spark):
    [(headers, _)] = parse(spark, f"<10>1 2021-09-07T11:11:11.5+08:00 {HOST} m", compat=True)
    assert headers["timestamp"] == ms(2021, 9, 7, 11, 11, 11, milli=5)
    [(headers, _)] = parse(spark, f"<10>1 2021-09-07T11:11:11+08:00 {HOST} m", compat=True)
    assert headers["timestamp"] == ms(2021, 9, 7, 3, 11, 11)


@pytest.mark.parametrize(
    "stamp, now, year, compat",
    [
        ("Apr  3 11:11:11", (2024, 6, 1), 2024, False),
        ("Apr 13 11:11:11", (2024, 6, 1), 2024, False),
        ("Jun 20 11:11:11", (2024, 6, 1), 2024, False),  # less than a month ahead
        ("Dec 31 23:59:59", (2024, 1, 2), 2023, False),
        ("Jan  1 00:00:01", (2024, 12, 31), 2025, False),
        ("Jan  1 00:00:01", (2024, 12, 31), 2023, True),
    ],
)
def test_rfc3164_year(spark, stamp, now, year, compat):
    clock = F.lit(datetime(*now, tzinfo=timezone.utc)).cast("timestamp")
    [(headers, body)] = parse(spark, f"<10>{stamp} {HOST} disk is full", now=clock, compat=compat)
    assert datetime.fromtimestamp(int(headers["timestamp"]) / 1000, timezone.utc).year == year
    assert headers["host"] == HOST and body == "disk is full"


@pytest.mark.parametrize(
    "line",
    ["<7X> no number", "late <7> start", "<> bad bad data", "<1234>x", "<12", "plain"],
)
def test_bad_priority(spark, line):
    [(headers, body)] = parse(spark, line)
    assert headers == {"Facility": "0", "Severity": "0", "syslog.status": "Invalid"}
    assert body == line


def test_good_priority_but_unknown_shape_keeps_the_raw_line(spark):
    [(headers, body)] = parse(spark, "<13>whatever this is")
    assert headers == {"Facility": "1", "Severity": "5"}
    assert body == "<13>whatever this is"


def test_several_lines_blank_lines_and_good_after_bad(spark):
    raw = f"<10> bad\n\n\n<10>1 2021-09-07T11:11:11 {HOST} one\n<11>1 - {HOST} two\n"
    out = parse(spark, raw)
    assert [b for _, b in out] == ["<10> bad", "one", "two"]
    assert [h["Severity"] for h, _ in out] == ["2", "2", "3"]


def test_over_size_is_cut_and_flagged(spark):
    line = "<10>1 - host " + "x" * 30
    out = parse(spark, line, max_size=20)
    assert out[0][0]["syslog.status"] == "Incomplete" and out[0][1] == "xxxxxxx"
    assert [h["syslog.status"] for h, _ in out[1:]] == ["Invalid", "Invalid"]
    assert "".join(b for _, b in out) == "x" * 30
    assert parse(spark, "<10>1 - h " + "y" * 10, max_size=20)[0][0]["syslog.status"] == "Incomplete"


def test_size_counts_bytes(spark):
    out = parse(spark, "ü" * 8, max_size=10, keep_fields="all")
    assert len(out) == 2


@pytest.mark.parametrize(
    "keep, expected",
    [
        (None, "disk is full"),
        ("none", "disk is full"),
        ("false", "disk is full"),
        ("all", f"<10>1 2021-09-07T11:11:11 {HOST} disk is full"),
        ("true", f"<10>1 2021-09-07T11:11:11 {HOST} disk is full"),
        ("hostname", f"{HOST} disk is full"),
        ("timestamp hostname", f"2021-09-07T11:11:11 {HOST} disk is full"),
        ("priority version", "<10>1 disk is full"),
    ],
)
def test_keep_fields(spark, keep, expected):
    [(_, body)] = parse(spark, f"<10>1 2021-09-07T11:11:11 {HOST} disk is full", keep_fields=keep)
    assert body == expected


def test_body_may_hold_the_internal_separator(spark):
    [(headers, body)] = parse(spark, f"<10>1 - {HOST} a\u0001b\u0001c")
    assert body == "a\u0001b\u0001c" and headers["host"] == HOST


def test_user_format_comes_first(spark):
    fmt = S.SyslogFormat(r"<(\d+)>(x?)\[(.*?)\] (\S+) (.*)", None, None, "yyyy/MM/dd")
    [(headers, body)] = parse(spark, "<10>[2020/01/02] h body", formats=(fmt,))
    assert (headers["timestamp"], headers["host"], body) == (ms(2020, 1, 2), "h", "body")


def test_typed(spark):
    df = spark.createDataFrame([(f"<10>1 2021-09-07T11:11:11Z {HOST} m",), ("bad",)], "body string")
    rows = S.typed_syslog(S.parse_syslog(df)).collect()
    assert tuple(rows[0]) == (1, 2, int(ms(2021, 9, 7, 11, 11, 11)), HOST, "m")
    assert tuple(rows[1]) == (0, 0, 0, "", "bad")


def test_charsets_by_port(spark):
    stamp = "<13>1 2024-05-06T07:08:09Z box "
    rows = [
        (1, f"{stamp}café\n{stamp}zwei".encode("latin-1")), (2, f"{stamp}日本語".encode("shift_jis")),
        (3, f"{stamp}naïve".encode()), (4, f"{stamp}".encode() + b"bad \xff"), (5, f"{stamp}Łódź".encode("cp1250")),
        (2, f"{stamp}ok ".encode() + b"\x81"), (1, None),
    ]
    df = spark.createDataFrame(rows, "p int, body binary")
    out = S.parse_syslog(
        df, charset="UTF-8", port=F.col("p"), port_charsets={1: "latin1", 2: "Shift_JIS", 5: "windows-1250"}
    )
    got = sorted((r.p, bytes(r.body).decode()) for r in out.collect())
    assert got == [(1, "café"), (1, "zwei"), (2, "ok \ufffd"), (2, "日本語"), (3, "naïve"), (4, "bad \ufffd"), (5, "Łódź")]
    whole = S.parse_syslog(df.where("p = 1"), charset="ISO-8859-1")
    assert sorted(bytes(r.body).decode() for r in whole.collect()) == ["café", "zwei"]
    with pytest.raises(LookupError):
        S.parse_syslog(df, charset="no-such")


def test_long_messages_of_other_charsets_are_cut_at_bytes(spark):
    df = spark.createDataFrame([(("<13>" + "é" * 30).encode("latin-1"),)], "body binary")
    out = S.split_messages(df, "body", 12, as_bytes=True).collect()
    assert [len(r.message) for r in out] == [12, 12, 10] and [r.cut for r in out] == [True, True, False]
