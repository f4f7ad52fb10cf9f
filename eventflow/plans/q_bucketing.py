"""Queries over bucket names and time rounding."""

from pyspark.sql import functions as F

from eventflow.functions import bucketing as B
from eventflow.operators import interceptors as I
from eventflow.operators import routing as R
from eventflow.plans import adapters as A
from eventflow.plans.registry import MS, query
from eventflow.schema import header, to_events

TEN_MINUTES = "time_bucket(INTERVAL 10 MINUTE, ts)"


def flagship(events):
    """Filter, stamp, route and bucket activity events; count per channel and bucket."""
    staged = I.chain([I.regex_filter('"k": [1-9]'), I.add_static("dc", "eu")])(events)
    routed = R.multiplex(
        staged,
        "event_type",
        {"click": "web", "view": "web", "purchase": "billing audit", "signup": "audit"},
        default="other",
    )
    bucket = B.bucket_path(
        "%{event_type}/%Y-%m-%d/%H%M", round_unit="minute", round_value=10
    )
    return routed.groupBy("channel", bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.octet_length("body")).alias("bytes")
    )


@query(
    "route_and_bucket_events",
    f"""WITH routed AS (
  SELECT *, unnest(CASE event_type WHEN 'click' THEN ['web'] WHEN 'view' THEN ['web']
    WHEN 'purchase' THEN ['billing', 'audit'] WHEN 'signup' THEN ['audit'] ELSE ['other'] END) AS channel
  FROM events WHERE regexp_matches(props, '"k": [1-9]'))
SELECT channel, event_type || '/' || strftime({TEN_MINUTES}, '%Y-%m-%d/%H%M') AS bucket,
  count(*) AS events, CAST(sum(strlen(props)) AS BIGINT) AS bytes
FROM routed GROUP BY 1, 2""",
)
def route_and_bucket_events(spark, sf):
    return flagship(A.events(spark, sf, keep=()))


@query(
    "bucket_path_tokens",
    f"""SELECT event_id, strftime(ts, '%a %A %b %B') AS names, strftime(ts, '%a %b %-d %H:%M:%S %Y') AS c,
  strftime(ts, '%d ') || day(ts) || strftime(ts, ' %m/%d/%y') AS days,
  strftime(ts, '%H %I %j %-H %-I') AS hours, strftime(ts, '%m %M %-m %p') AS minutes,
  ({MS} // 1000) || ' ' || strftime(ts, '%S') || ' ' || {MS} AS seconds,
  strftime(ts, '%y %Y') || ' +0000 % [' || user_id || '|]' AS years
FROM events""",
)
def bucket_path_tokens(spark, sf):
    patterns = {
        "names": "%a %A %b %B",
        "c": "%c",
        "days": "%d %e %D",
        "hours": "%H %I %j %k %l",
        "minutes": "%m %M %n %p",
        "seconds": "%s %S %t",
        "years": "%y %Y %z %% [%{user_id}|%{absent}]%Q",
    }
    ev = A.events(spark, sf)
    return ev.select("event_id", *[B.bucket_path(p).alias(n) for n, p in patterns.items()])


@query(
    "bucket_path_static_names",
    "SELECT event_id, 'edge-1/10.0.0.9/edge-1.example.org/' || strftime(ts, '%H') AS bucket FROM events",
)
def bucket_path_static_names(spark, sf):
    statics = B.static_names("edge-1", "10.0.0.9", "edge-1.example.org")
    return A.events(spark, sf).select(
        "event_id",
        B.bucket_path("%[localhost]/%[IP]/%[FQDN]/%H", statics=statics).alias("bucket"),
    )


@query(
    "bucket_path_clock",
    "SELECT event_id, event_type || '/' || '2024-02-29/0250' AS bucket FROM events",
)
def bucket_path_clock(spark, sf):
    clock = F.lit(1709175599000)  # 2024-02-29 02:59:59 UTC
    return A.events(spark, sf).select(
        "event_id",
        B.bucket_path(
            "%{event_type}/%Y-%m-%d/%H%M", clock=clock, round_unit="minute", round_value=10
        ).alias("bucket"),
    )


@query(
    "bucket_path_zones",
    """WITH z AS (SELECT event_id, ts + INTERVAL 330 MINUTE AS india,
  ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS ny FROM events)
SELECT event_id, strftime(date_trunc('day', india) + INTERVAL 1 HOUR * (hour(india) // 5 * 5),
  '%Y-%m-%d %H') || ' +0530' AS india, strftime(ny, '%Y-%m-%d %H:%M') || ' -0500' AS new_york FROM z""",
)
def bucket_path_zones(spark, sf):
    return A.events(spark, sf).select(
        "event_id",
        B.bucket_path(
            "%Y-%m-%d %H %z", tz="Asia/Kolkata", round_unit="hour", round_value=5
        ).alias("india"),
        B.bucket_path("%Y-%m-%d %H:%M %z", tz="America/New_York").alias("new_york"),
    )


@query(
    "round_down_timestamps",
    """SELECT event_id,
  epoch_us(date_trunc('minute', ts)) // 1000 + second(ts) // 45 * 45000 AS s45,
  epoch_us(date_trunc('hour', ts)) // 1000 + minute(ts) // 7 * 7 * 60000 AS m7,
  epoch_us(date_trunc('day', ts)) // 1000 + hour(ts) // 5 * 5 * 3600000 AS h5,
  epoch_us(date_trunc('hour', ts)) // 1000 AS h1 FROM events""",
)
def round_down_timestamps(spark, sf):
    ms = header("timestamp").cast("bigint")
    return A.events(spark, sf).select(
        "event_id",
        B.round_down(ms, "second", 45).alias("s45"),
        B.round_down(ms, "minute", 7).alias("m7"),
        B.round_down(ms, "hour", 5).alias("h5"),
        B.round_down(ms, "hour", 0).alias("h1"),
    )


@query(
    "index_names",
    f"""SELECT event_id, 'ev-' || event_type AS simple,
  'ev-' || event_type || '-' || strftime(ts, '%Y-%m-%d') AS daily,
  'ev-' || strftime(ts + INTERVAL 330 MINUTE, '%Y.%m') AS monthly FROM events""",
)
def index_names(spark, sf):
    zone = "Asia/Kolkata"
    return A.events(spark, sf).select(
        "event_id",
        B.index_name("ev-%{event_type}").alias("simple"),
        B.index_name("ev-%{event_type}", mode="time").alias("daily"),
        B.index_name("ev", mode="time", date_format="yyyy.MM", tz=zone).alias("monthly"),
    )


@query(
    "index_names_fallback",
    f"""SELECT o_orderkey, 'orders-' || CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 'O' THEN '2001-09-09' ELSE '1970-01-01' END AS index_name FROM orders""",
)
def index_names_fallback(spark, sf):
    status = F.col("o_orderstatus")
    ev = to_events(
        A.table(spark, sf, "orders"),
        {
            "timestamp": F.when(status == "F", A.epoch_ms("o_orderdate").cast("string")).when(
                status == "O", F.lit(" ")
            ),
            "@timestamp": F.when(status == "O", F.lit("1000000000000")),
        },
        None,
        keep=("o_orderkey",),
        drop_null=True,
    )
    return ev.select(
        "o_orderkey",
        B.index_name("orders", mode="time", clock=F.lit(0)).alias("index_name"),
    )
