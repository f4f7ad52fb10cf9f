"""Queries over parsers and record shaping. Wire forms are derived from the tables."""

from pyspark.sql import functions as F

from eventflow.functions import syslog as S
from eventflow.functions.headers import render
from eventflow.operators.indexing import with_arrival_index
from eventflow.plans import adapters as A
from eventflow.plans.registry import MS, query
from eventflow.schema import body_text, header
from eventflow.sources import messages as M
from eventflow.sources import payloads as P

# --- syslog -----------------------------------------------------------------

PRI = "(16 * (event_id % 5) + event_id % 8)"


def _syslog_lines(spark, sf, stamp, version="1 "):
    df = A.table(spark, sf, "events")
    pri = F.pmod("event_id", F.lit(5)) * 16 + F.pmod("event_id", F.lit(8))
    return df.select(
        "event_id",
        F.concat(
            F.lit("<"), pri.cast("string"), F.lit(">" + version), stamp,
            F.lit(" host-"), F.col("user_id").cast("string"), F.lit(" "),
            F.col("event_type"), F.lit(" "), F.col("props"),
        ).alias("body"),
    )


def _syslog_columns(df, *more):
    h = F.col("headers")
    return df.select(
        "event_id",
        h["Facility"].cast("int").alias("facility"),
        h["Severity"].cast("int").alias("severity"),
        h["priority"].alias("priority"),
        h["version"].alias("version"),
        h["timestamp"].cast("bigint").alias("stamp"),
        h["host"].alias("host"),
        body_text().alias("body"),
        *more,
    )


@query(
    "parse_syslog_rfc5424",
    f"""SELECT event_id, (({PRI}) // 8)::INT AS facility, (({PRI}) % 8)::INT AS severity,
  ({PRI})::VARCHAR AS priority, '1' AS version, {MS} - 8 * 3600000 AS stamp,
  'host-' || user_id AS host, event_type || ' ' || props AS body FROM events""",
)
def parse_syslog_rfc5424(spark, sf):
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+08:00"))
    return _syslog_columns(S.parse_syslog(_syslog_lines(spark, sf, stamp)))


@query(
    "parse_syslog_compat_zone",
    f"""SELECT event_id, (({PRI}) // 8)::INT AS facility, (({PRI}) % 8)::INT AS severity,
  ({PRI})::VARCHAR AS priority, NULL::VARCHAR AS version, {MS} AS stamp,
  'host-' || user_id AS host, event_type || ' ' || props AS body FROM events""",
)
def parse_syslog_compat_zone(spark, sf):
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+08:00"))
    return _syslog_columns(S.parse_syslog(_syslog_lines(spark, sf, stamp, ""), compat=True))


@query(
    "parse_syslog_rfc3164",
    f"""SELECT event_id, (({PRI}) // 8)::INT AS facility, (({PRI}) % 8)::INT AS severity,
  ({PRI})::VARCHAR AS priority, NULL::VARCHAR AS version,
  epoch_us(date_trunc('second', ts)) // 1000 AS stamp,
  'host-' || user_id AS host, event_type || ' ' || props AS body, '514' AS port FROM events""",
)
def parse_syslog_rfc3164(spark, sf):
    # Single-digit days are padded with a second blank.
    stamp = F.concat(
        F.date_format("ts", "MMM "),
        F.lpad(F.date_format("ts", "d"), 2, " "),
        F.date_format("ts", " HH:mm:ss"),
    )
    now = F.timestamp_millis(F.lit(1706745600000))  # 2024-02-01
    parsed = S.parse_syslog(
        _syslog_lines(spark, sf, stamp, ""), now=now, extra_headers={"port": F.lit(514)}
    )
    return _syslog_columns(parsed, header("port").alias("port"))


@query(
    "parse_syslog_keep_fields",
    f"""SELECT event_id, '<' || ({PRI}) || '>' || '1 ' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || ' ' || event_type
  || ' ' || props AS body, epoch_us(date_trunc('second', ts)) // 1000 AS stamp FROM events""",
)
def parse_syslog_keep_fields(spark, sf):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    parsed = S.parse_syslog(
        _syslog_lines(spark, sf, stamp), keep_fields="priority version timestamp"
    )
    return parsed.select(
        "event_id", body_text().alias("body"), header("timestamp").cast("bigint").alias("stamp")
    )


@query(
    "parse_syslog_user_format",
    f"""SELECT event_id, (({PRI}) // 8)::INT AS facility, (({PRI}) % 8)::INT AS severity,
  ({PRI})::VARCHAR AS priority, NULL::VARCHAR AS version,
  epoch_us(date_trunc('second', ts)) // 1000 AS stamp,
  'host-' || user_id AS host, event_type || ' ' || props AS body FROM events""",
)
def parse_syslog_user_format(spark, sf):
    stamp = F.date_format("ts", "dd/MM/yyyy_HH:mm:ss")
    fmt = S.SyslogFormat(
        r"<(\d{1,3})>(\d?)(\d\d/\d\d/\d{4}_\S+) (\S+) (.*)", "_", " ", "dd/MM/yyyy HH:mm:ss"
    )
    return _syslog_columns(
        S.parse_syslog(_syslog_lines(spark, sf, stamp, ""), formats=(fmt,))
    )


@query(
    "parse_syslog_documents",
    r"""WITH l AS (SELECT doc_id, encode(unnest(string_split(text, chr(10)))) AS b FROM documents),
  p AS (SELECT doc_id, unnest(list_transform(range(0, (octet_length(b) + 511) // 512),
    lambda i: b[i * 512 + 1 : i * 512 + 512])) AS piece FROM l WHERE octet_length(b) > 0)
SELECT doc_id, count(*) AS events, count(*) AS invalid, CAST(sum(octet_length(piece)) AS BIGINT) AS bytes,
  CAST(max(octet_length(piece)) AS BIGINT) AS longest FROM p GROUP BY doc_id""",
)
def parse_syslog_documents(spark, sf):
    """Prose is not syslog: every piece must come out raw, flagged, and whole."""
    df = A.table(spark, sf, "documents").select("doc_id", F.col("text").alias("body"))
    parsed = S.parse_syslog(df, max_size=512)
    return parsed.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(header(S.STATUS_HEADER) == S.INVALID).alias("invalid"),
        F.sum(F.octet_length("body")).alias("bytes"),
        F.max(F.octet_length("body")).cast("bigint").alias("longest"),
    )


_LATIN = "[^ -~\u00a1-\u00ff]"


@query(
    "parse_syslog_charsets",
    f"""WITH d AS (SELECT doc_id, (514 + doc_id % 3)::VARCHAR AS port,
    regexp_replace(substr(coalesce(text, ''), 1, 200), '{_LATIN}', '.', 'g') AS t FROM documents)
SELECT doc_id, port, 'host-' || doc_id AS host,
  'x' || CASE port WHEN '516' THEN chr(26085) || chr(26412) ELSE t END || 'x' AS body FROM d""",
)
def parse_syslog_charsets(spark, sf):
    """Ports with UTF-8, ISO-8859-1 and Shift_JIS senders."""
    port = F.lit(514) + F.pmod("doc_id", F.lit(3))
    text = F.regexp_replace(F.substring(F.coalesce("text", F.lit("")), 1, 200), _LATIN, ".")
    sent = (
        F.when(port == 514, text.cast("binary")).when(port == 515, F.encode(text, "ISO-8859-1"))
        .otherwise(F.unhex(F.lit("93FA967B")))
    )
    start = F.concat(F.lit("<13>1 2024-05-06T07:08:09Z host-"), F.col("doc_id").cast("string"), F.lit(" x"))
    raw = F.concat(start.cast("binary"), sent, F.lit("x\n").cast("binary"))
    df = A.table(spark, sf, "documents").select("doc_id", port.alias("port"), raw.alias("body"))
    parsed = S.parse_syslog(
        df, port=F.col("port"), port_charsets={515: "ISO-8859-1", 516: "Shift_JIS"},
        extra_headers={"port": F.col("port").cast("string")},
    )
    return parsed.select(
        "doc_id", header("port").alias("port"), header("host").alias("host"), body_text().alias("body")
    )


@query(
    "typed_syslog_rows",
    f"""SELECT (({PRI}) // 8)::INT AS facility, (({PRI}) % 8)::INT AS severity,
  epoch_us(date_trunc('second', ts)) // 1000 AS timestamp, 'host-' || user_id AS hostname,
  event_type || ' ' || props AS message FROM events""",
)
def typed_syslog_rows(spark, sf):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return S.typed_syslog(S.parse_syslog(_syslog_lines(spark, sf, stamp)))


# --- payloads ---------------------------------------------------------------


def _json_payloads(spark, sf):
    """Requests of up to four turns of a conversation, as a JSON array of events."""
    ev = A.conversations(spark, sf)
    batches = M.events_to_batches(ev, ["conv_id"], "turn", size=4)
    shaped = F.transform(
        "batch",
        lambda e: F.struct(e["headers"].alias("headers"), e["body"].cast("string").alias("body")),
    )
    return batches.select("conv_id", "batch_no", F.to_json(shaped).alias("payload"))


@query(
    "json_event_arrays",
    "SELECT conv_id, turn, role, text AS body FROM conversations",
)
def json_event_arrays(spark, sf):
    events, _ = P.parse_json_events(_json_payloads(spark, sf), keep=("conv_id",))
    return events.select(
        "conv_id",
        header("turn").cast("bigint").alias("turn"),
        header("role").alias("role"),
        body_text().alias("body"),
    )


@query(
    "json_event_arrays_utf16",
    "SELECT conv_id, turn, text AS body FROM conversations",
)
def json_event_arrays_utf16(spark, sf):
    raw = _json_payloads(spark, sf).withColumn("payload", F.encode("payload", "UTF-16"))
    events, _ = P.parse_json_events(raw, charset="UTF-16", keep=("conv_id",))
    return events.select(
        "conv_id",
        header("turn").cast("bigint").alias("turn"),
        body_text("UTF-16").alias("body"),
    )


@query(
    "json_event_rejects",
    "SELECT conv_id, turn // 4 AS batch_no, count(*) AS turns FROM conversations "
    "WHERE conv_id % 3 = 1 GROUP BY 1, 2",
)
def json_event_rejects(spark, sf):
    cut = F.when(
        F.pmod("conv_id", F.lit(3)) == 1, F.expr("substring(payload, 1, length(payload) - 1)")
    ).otherwise(F.col("payload"))
    _, bad = P.parse_json_events(_json_payloads(spark, sf).withColumn("payload", cut))
    turns = A.table(spark, sf, "conversations").groupBy(
        "conv_id", F.floor(F.col("turn") / 4).alias("batch_no")
    ).agg(F.count(F.lit(1)).alias("turns"))
    return turns.join(bad.select("conv_id", "batch_no"), ["conv_id", "batch_no"])


@query(
    "json_event_literal_headers",
    """SELECT conv_id, turn, '[' || turn || ']' AS list, '{}' AS empty, text AS body FROM conversations
WHERE turn % 4 < 2""",
)
def json_event_literal_headers(spark, sf):
    """Texts that look like JSON are values; nested values and text behind the array reject."""
    n = F.pmod("turn", F.lit(4))
    event = F.to_json(F.struct(
        F.create_map(
            F.lit("turn"), F.col("turn").cast("string"), F.lit("list"), F.concat(F.lit("["), "turn", F.lit("]")),
            F.lit("empty"), F.lit("{}"),
        ).alias("headers"),
        F.col("text").alias("body"),
    ))
    nested = F.replace(event, F.lit('"empty":"{}"'), F.lit('"empty":{}'))
    rows = A.table(spark, sf, "conversations").select(
        "conv_id",
        F.when(n < 2, F.concat(F.lit(" ["), event, F.lit("] ")))
        .when(n == 2, F.concat(F.lit("["), nested, F.lit("]")))
        .otherwise(F.concat(F.lit("["), event, F.lit('],"y":[1]'))).alias("payload"),
    )
    events, _ = P.parse_json_events(rows, keep=("conv_id",))
    return events.select(
        "conv_id", header("turn").cast("bigint").alias("turn"), header("list").alias("list"),
        header("empty").alias("empty"), body_text().alias("body"),
    )


@query(
    "blob_requests",
    r"""SELECT page_id, regexp_extract(url, '[?&]page=([^&#]*)', 1) AS page,
  nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref, strlen(html)::BIGINT AS size
FROM pages WHERE regexp_matches(url, '[?&]page=')""",
)
def blob_requests(spark, sf):
    text = F.substring_index(F.substring_index(F.col("url"), "?", -1), "#", 1)
    params = F.when(F.contains("url", F.lit("?")), F.str_to_map(text, F.lit("&"), F.lit("=")))
    df = A.table(spark, sf, "pages").select(
        "page_id",
        F.transform_values(params, lambda _, v: F.array(v, F.lit("second"))).alias("params"),
        F.col("html").cast("binary").alias("payload"),
    )
    good, _ = P.parse_blob_request(df, mandatory=["page"], keep=("page_id",))
    return good.select(
        "page_id",
        header("page").alias("page"),
        header("ref").alias("ref"),
        F.octet_length("body").cast("bigint").alias("size"),
    )


@query(
    "frame_lines",
    r"""WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents),
  b AS (SELECT doc_id, a, list_position(list_transform(a, lambda x: length(x) > 400), true) AS bad FROM p),
  k AS (SELECT doc_id, CASE WHEN coalesce(bad, 0) > 0 THEN a[1:bad - 1] ELSE a[1:len(a) - 1] END AS kept FROM b),
  u AS (SELECT doc_id, unnest(range(0, len(kept))) AS n, kept FROM k)
SELECT doc_id, n::INT AS line_no, kept[n + 1] AS body FROM u""",
)
def frame_lines(spark, sf):
    df = A.table(spark, sf, "documents").select("doc_id", F.col("text").alias("body"))
    events, _ = P.frame_lines(df, max_length=400)
    return events.select("doc_id", "line_no", body_text().alias("body"))


@query(
    "frame_lines_refused",
    r"""WITH b AS (SELECT doc_id, list_position(list_transform(string_split(text, chr(10)),
    lambda x: length(x) > 400), true) AS bad FROM documents)
SELECT doc_id, bad::BIGINT AS failed_line FROM b WHERE bad > 0""",
)
def frame_lines_refused(spark, sf):
    df = A.table(spark, sf, "documents").select("doc_id", F.col("text").alias("body"))
    _, refused = P.frame_lines(df, max_length=400)
    return refused


@query(
    "frame_datagrams",
    "SELECT conv_id, turn, '10.0.0.' || conv_id AS address, split_part(text, chr(10), 1) AS body "
    "FROM conversations",
)
def frame_datagrams(spark, sf):
    df = A.table(spark, sf, "conversations").select(
        "conv_id", "turn",
        F.concat(F.lit("10.0.0."), "conv_id").alias("address"), F.col("text").alias("body"),
    )
    out = P.frame_datagrams(df, keep=("conv_id", "turn"))
    return out.select(
        "conv_id", "turn", header("REMOTE_ADDRESS").alias("address"), body_text().alias("body")
    )


# --- broker and RPC records ---------------------------------------------------


def _topic_records(spark, sf):
    return A.table(spark, sf, "events").select(
        F.when(F.col("event_type") != "view", F.col("user_id").cast("string").cast("binary")).alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.concat(F.lit("t-"), "event_type").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        "event_id",
        "ts",
    )


@query(
    "topic_to_events",
    f"""SELECT event_id, {MS} AS stamped, 't-' || event_type AS topic, (user_id % 4)::VARCHAR AS partition,
  CASE WHEN event_type <> 'view' THEN user_id::VARCHAR END AS key, event_type <> 'view' AS keyed,
  props AS body FROM events""",
)
def topic_to_events(spark, sf):
    records = _topic_records(spark, sf)
    out = M.topic_to_events(records, clock=A.epoch_ms("ts"), keep=("event_id",))
    return out.select(
        "event_id",
        header("timestamp").cast("bigint").alias("stamped"),
        header("topic").alias("topic"),
        header("partition").alias("partition"),
        header("key").alias("key"),
        F.map_contains_key("headers", "key").alias("keyed"),
        body_text().alias("body"),
    )


@query(
    "topic_event_format",
    f"""SELECT event_id, {MS} AS stamped, 'mine' AS topic, (user_id % 4)::VARCHAR AS partition,
  coalesce(CASE WHEN event_type <> 'view' THEN user_id::VARCHAR END, 'old') AS key, props AS body FROM events""",
)
def topic_event_format(spark, sf):
    doc = F.struct(
        F.create_map(
            F.lit("topic"), F.lit("mine"), F.lit("key"), F.lit("old"),
            F.lit("timestamp"), A.epoch_ms("ts").cast("string"),
        ).alias("headers"),
        F.col("value").cast("string").alias("body"),
    )
    records = P.decode_event_format(
        _topic_records(spark, sf).withColumn("value", F.to_json(doc).cast("binary"))
    )
    out = M.topic_to_events(records, event_format=True, clock=F.lit(0), keep=("event_id",))
    return out.select(
        "event_id",
        header("timestamp").cast("bigint").alias("stamped"),
        header("topic").alias("topic"),
        header("partition").alias("partition"),
        header("key").alias("key"),
        body_text().alias("body"),
    )


@query(
    "dirty_reads",
    """WITH r AS (SELECT l_linestatus AS topic, (l_partkey % 3)::INT AS partition, l_orderkey AS "offset",
    row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
      l_extendedprice, l_discount, l_tax, l_returnflag) AS arrival FROM lineitem),
  p AS (SELECT *, lag("offset") OVER (PARTITION BY topic, partition ORDER BY arrival) AS before FROM r)
SELECT topic, partition, count(*) AS records, count(*) FILTER (WHERE before > 0 AND before >= "offset") AS dirty_reads
FROM p GROUP BY topic, partition""",
)
def dirty_reads(spark, sf):
    order = [
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    ]
    records = with_arrival_index(
        A.table(spark, sf, "lineitem").select("l_linestatus", *order), order, "arrival"
    ).select(
        F.col("l_linestatus").alias("topic"),
        F.pmod("l_partkey", F.lit(3)).cast("int").alias("partition"),
        F.col("l_orderkey").alias("offset"),
        "arrival",
    )
    return M.dirty_reads(records, "arrival", slice_width=1000)


@query(
    "amqp_to_events",
    f"""SELECT event_id, '{{app-id=app' || (CASE WHEN event_id % 2 = 0 THEN ', content-type=text/plain' ELSE '' END)
  || ', delivery-mode=2, exchange=ex-' || event_type || ', flag=' ||
  (CASE WHEN event_id % 4 = 0 THEN '' ELSE 'up' END) || ', message-id=' || event_id
  || ', routing-key=rk.' || user_id || ', timestamp=' || {MS} || '}}' AS headers, props AS body FROM events""",
)
def amqp_to_events(spark, sf):
    even = F.pmod("event_id", F.lit(2)) == 0
    df = A.table(spark, sf, "events").select(
        "event_id",
        F.lit("app").alias("app_id"),
        F.lit("").alias("content_encoding"),
        F.when(even, F.lit("text/plain")).alias("content_type"),
        F.lit(2).alias("delivery_mode"),
        F.lit(None).cast("int").alias("priority"),
        F.col("event_id").cast("string").alias("message_id"),
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("ex-"), "event_type").alias("exchange"),
        F.concat(F.lit("rk."), "user_id").alias("routing_key"),
        F.create_map(
            F.lit("flag"), F.when(F.pmod("event_id", F.lit(4)) != 0, F.lit("up"))
        ).alias("headers"),
        F.col("props").cast("binary").alias("body"),
    )
    out = M.amqp_to_events(df, keep=("event_id",))
    return out.select(
        "event_id", render(F.col("headers")).alias("headers"), body_text().alias("body")
    )


@query(
    "jms_to_events",
    """SELECT conv_id, turn, role, CASE WHEN role = 'system' THEN '' ELSE text END AS body FROM conversations""",
)
def jms_to_events(spark, sf):
    role = F.col("role")
    df = A.table(spark, sf, "conversations").select(
        "conv_id", "turn",
        F.create_map(F.lit("role"), role).alias("properties"),
        F.when(role == "assistant", F.lit("bytes")).otherwise(F.lit("text")).alias("type"),
        F.when(role == "user", F.col("text")).alias("text"),
        F.when(role == "assistant", F.col("text").cast("binary")).alias("bytes"),
    )
    out = M.jms_to_events(df, keep=("conv_id", "turn"))
    return out.select("conv_id", "turn", header("role").alias("role"), body_text().alias("body"))


@query(
    "category_to_events",
    """SELECT doc_id, CASE WHEN lang <> 'en' THEN source END AS category, lang <> 'en' AS has_category,
  md5(text) AS digest FROM documents""",
)
def category_to_events(spark, sf):
    df = A.table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("lang") != "en", F.col("source")).alias("category"),
        F.col("text").alias("message"),
    )
    out = M.category_to_events(df, keep=("doc_id",))
    return out.select(
        "doc_id",
        header("category").alias("category"),
        F.map_contains_key("headers", "category").alias("has_category"),
        F.md5("body").alias("digest"),
    )


@query(
    "stream_records_to_events",
    "SELECT doc_id, 7::BIGINT AS stamped, text AS body FROM documents WHERE doc_id % 5 <> 2",
)
def stream_records_to_events(spark, sf):
    broken = F.concat(F.col("text").cast("binary"), F.lit(b"\xc3"))
    df = A.table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.pmod("doc_id", F.lit(5)) == 2, broken)
        .otherwise(F.col("text").cast("binary"))
        .alias("data"),
    )
    out = M.stream_records_to_events(df, clock=F.lit(7), keep=("doc_id",))
    return out.select(
        "doc_id", header("timestamp").cast("bigint").alias("stamped"), body_text().alias("body")
    )


@query(
    "flatten_status",
    """SELECT 'id:' || conv_id || '-' || turn AS id, strftime(TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * turn,
    '%Y-%m-%dT%H:%M:%SZ') AS created_at, conv_id::INT AS user_friends_count, 'loc' AS user_location,
  NULL::VARCHAR AS user_description, turn::INT AS user_statuses_count, 3::INT AS user_followers_count,
  'n' || conv_id AS user_name, role AS user_screen_name, text, turn AS retweet_count, turn > 2 AS retweeted,
  -1::BIGINT AS in_reply_to_user_id, 'web' AS source, conv_id AS in_reply_to_status_id,
  CASE WHEN turn > 0 THEN 'https://m/' || turn END AS media_url_https,
  CASE WHEN turn > 0 THEN 'http://x/' || turn END AS expanded_url FROM conversations""",
)
def flatten_status(spark, sf):
    media = F.struct(
        F.concat(F.lit("https://m/"), "turn").alias("media_url_https"),
        F.concat(F.lit("http://x/"), "turn").alias("expanded_url"),
    )
    other = F.struct(F.lit("no").alias("media_url_https"), F.lit("no").alias("expanded_url"))
    df = A.table(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("turn")).alias("created_at"),
        F.struct(
            F.col("conv_id").alias("friends_count"),
            F.lit("loc").alias("location"),
            F.lit(None).cast("string").alias("description"),
            F.col("turn").alias("statuses_count"),
            F.lit(3).alias("followers_count"),
            F.concat(F.lit("n"), "conv_id").alias("name"),
            F.col("role").alias("screen_name"),
        ).alias("user"),
        "text",
        F.col("turn").alias("retweet_count"),
        (F.col("turn") > 2).alias("retweeted"),
        F.lit(-1).alias("in_reply_to_user_id"),
        F.lit("web").alias("source"),
        F.col("conv_id").alias("in_reply_to_status_id"),
        F.when(F.col("turn") > 0, F.array(media, other))
        .otherwise(F.array().cast("array<struct<media_url_https:string,expanded_url:string>>"))
        .alias("media"),
    )
    return M.flatten_status(df, "id:")


@query(
    "logs_to_events",
    """SELECT doc_id, 'log.' || source AS logger, 'UTF8' AS encoding, 20000::INT AS level, doc_id * 1000 AS ts_ms,
  '10.1.1.1' AS address, unnest(string_split(text, chr(10))) AS body FROM documents""",
)
def logs_to_events(spark, sf):
    df = A.table(spark, sf, "documents").select(
        "doc_id",
        F.concat(F.lit("log."), "source").alias("logger"),
        (F.col("doc_id") * 1000).alias("ts_ms"),
        F.lit(20000).alias("level"),
        F.split("text", "\n", -1).alias("messages"),
    )
    out = M.logs_to_events(df, address=F.lit("10.1.1.1"), prefix="log.", keep=("doc_id",))
    return out.select(
        "doc_id",
        header("log.logger.name").alias("logger"),
        header("log.message.encoding").alias("encoding"),
        header("log.log.level").cast("int").alias("level"),
        header("log.timestamp").cast("bigint").alias("ts_ms"),
        header("log.address").alias("address"),
        body_text().alias("body"),
    )


@query(
    "legacy_to_events",
    f"""SELECT event_id, '{{host=h-' || user_id || ', kind=' || event_type || ', legacy=yes, nanos=' || event_id
  || ', pri=INFO, timestamp=' || {MS} || '}}' AS headers, props AS body FROM events""",
)
def legacy_to_events(spark, sf):
    df = A.table(spark, sf, "events").select(
        "event_id",
        F.concat(F.lit("h-"), "user_id").alias("host"),
        A.epoch_ms("ts").alias("timestamp"),
        F.lit("INFO").alias("priority"),
        F.col("event_id").alias("nanos"),
        F.create_map(F.lit("kind"), F.col("event_type").cast("binary")).alias("fields"),
        F.col("props").cast("binary").alias("body"),
    )
    out = M.legacy_to_events(df, keep=("event_id",))
    return out.select(
        "event_id", render(F.col("headers")).alias("headers"), body_text().alias("body")
    )


@query(
    "event_batches",
    "SELECT conv_id, turn, role, text AS body FROM conversations",
)
def event_batches(spark, sf):
    batches = M.events_to_batches(A.conversations(spark, sf), ["conv_id"], "turn", size=3)
    out = M.batches_to_events(batches, keep=("conv_id",))
    return out.select(
        "conv_id",
        header("turn").cast("bigint").alias("turn"),
        header("role").alias("role"),
        body_text().alias("body"),
    )
