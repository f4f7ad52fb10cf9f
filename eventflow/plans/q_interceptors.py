"""Queries over header and body transforms."""

from pyspark.sql import functions as F

from eventflow.functions.headers import render
from eventflow.operators import interceptors as I
from eventflow.operators.routing import union_flows
from eventflow.operators.triage import undelivered as missing
from eventflow.plans import adapters as A
from eventflow.plans.registry import MS, query
from eventflow.schema import body_text, header, to_events


@query(
    "add_timestamp",
    f"SELECT event_id, {MS} + 5000 AS stamped, {MS} AS kept FROM events",
)
def add_timestamp(spark, sf):
    ev = A.events(spark, sf, ("event_id", "ts"))
    clock = A.epoch_ms("ts") + 5000
    both = ev.transform(I.add_timestamp("arrival", clock=clock)).transform(
        I.add_timestamp(preserve=True, clock=clock)
    )
    return both.select(
        "event_id",
        header("arrival").cast("bigint").alias("stamped"),
        header("timestamp").cast("bigint").alias("kept"),
    )


@query(
    "add_host",
    "SELECT event_id, 'node-7' AS host, event_type AS kept_type, 'node-7' AS replaced FROM events",
)
def add_host(spark, sf):
    ev = A.events(spark, sf)
    out = I.chain(
        [
            I.add_host(host="node-7"),
            I.add_host("event_type", host="node-7", preserve=True),
            I.add_host("user_id", host="node-7"),
        ]
    )(ev)
    return out.select(
        "event_id",
        header("host").alias("host"),
        header("event_type").alias("kept_type"),
        header("user_id").alias("replaced"),
    )


@query(
    "add_static",
    "SELECT event_id, 'NYC' AS dc, event_type AS kept_type, 'x' AS replaced_user FROM events",
)
def add_static(spark, sf):
    out = I.chain(
        [
            I.add_static("dc", "NYC"),
            I.add_static("event_type", "other"),
            I.add_static("user_id", "x", preserve=False),
        ]
    )(A.events(spark, sf))
    return out.select(
        "event_id",
        header("dc").alias("dc"),
        header("event_type").alias("kept_type"),
        header("user_id").alias("replaced_user"),
    )


@query(
    "add_uuid_from_content",
    "SELECT event_id, 'ev-' || sha256(event_id || '|' || user_id || '|' || event_type) AS id "
    "FROM events",
)
def add_uuid(spark, sf):
    out = A.events(spark, sf).transform(
        I.add_uuid(prefix="ev-", content=["event_id", "user_id", "event_type"])
    )
    return out.select("event_id", header("id").alias("id"))


@query(
    "remove_headers",
    f"""SELECT event_id, 'name' AS variant, '{{event_id=' || event_id || ', event_type=' || event_type
    || ', timestamp=' || {MS} || '}}' AS headers FROM events
UNION ALL SELECT event_id, 'list', '{{event_id=' || event_id || ', timestamp=' || {MS} || '}}' FROM events
UNION ALL SELECT event_id, 'pattern', '{{timestamp=' || {MS} || ', user_id=' || user_id || '}}' FROM events""",
)
def remove_headers(spark, sf):
    ev = A.events(spark, sf)
    variants = {
        "name": I.remove_headers("user_id"),
        "list": I.remove_headers(from_list="user_id , event_type"),
        "pattern": I.remove_headers(matching="event_.*"),
    }
    return union_flows(
        *[
            ev.transform(step).select(
                "event_id", F.lit(name).alias("variant"), render(F.col("headers")).alias("headers")
            )
            for name, step in variants.items()
        ]
    )


@query(
    "search_replace_documents",
    r"""SELECT doc_id, regexp_replace(regexp_replace(text,
  '[A-Za-z0-9_.]+@[A-Za-z0-9_-]+[.][a-z]+', 'REDACTED', 'g'), '^([A-Za-z]+) ([a-z]+)', '\2 \1') AS body
FROM documents""",
)
def search_replace(spark, sf):
    out = I.chain(
        [
            I.search_replace(r"[A-Za-z0-9_.]+@[A-Za-z0-9_-]+[.][a-z]+", "REDACTED"),
            I.search_replace("^([A-Za-z]+) ([a-z]+)", "$2 $1"),
        ]
    )(A.documents(spark, sf))
    return out.select("doc_id", body_text().alias("body"))


@query(
    "search_replace_pages",
    r"""SELECT page_id, regexp_replace(html, '<a href="([^"]*)">([^<]*)</a>', '\2 [\1]', 'g') AS body
FROM pages""",
)
def search_replace_pages(spark, sf):
    step = I.search_replace('<a href="([^"]*)">([^<]*)</a>', "$2 [$1]")
    return A.pages(spark, sf).transform(step).select("page_id", body_text().alias("body"))


@query(
    "regex_filter_include",
    "SELECT doc_id, lang, source FROM documents WHERE regexp_matches(text, '(license|License)|@[a-z]+')",
)
def regex_filter_include(spark, sf):
    out = A.documents(spark, sf).transform(I.regex_filter("(license|License)|@[a-z]+"))
    return out.select("doc_id", header("lang").alias("lang"), header("source").alias("source"))


@query(
    "regex_filter_exclude",
    "SELECT lang, count(*) AS events, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents "
    "WHERE NOT regexp_matches(text, '[0-9]{3}') GROUP BY lang",
)
def regex_filter_exclude(spark, sf):
    out = A.documents(spark, sf).transform(I.regex_filter("[0-9]{3}", exclude=True))
    return out.groupBy(header("lang").alias("lang")).agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.octet_length("body")).alias("bytes")
    )


@query(
    "regex_extract_headers",
    r"""SELECT page_id, regexp_extract(html, '<html lang="([a-z]+)">', 1) AS lang,
  regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages""",
)
def regex_extract(spark, sf):
    out = I.chain(
        [
            I.regex_extract('<html lang="([a-z]+)">', ["lang", "ignored"]),
            I.regex_extract("<title>([^<]*)</title>", ["title"]),
        ]
    )(A.pages(spark, sf))
    return out.select("page_id", header("lang").alias("lang"), header("title").alias("title"))


@query(
    "regex_extract_url",
    r"""SELECT page_id, regexp_extract(url, '^(https?)://([^/]+)/', 1) AS scheme,
  regexp_extract(url, '^(https?)://([^/]+)/', 2) AS host,
  nullif(regexp_extract(url, '[?]page=([0-9]+)', 1), '') AS page FROM pages""",
)
def regex_extract_url(spark, sf):
    pages = A.table(spark, sf, "pages")
    urls = to_events(pages, {"page_id": F.col("page_id")}, F.col("url"), keep=("page_id",))
    out = I.chain(
        [
            I.regex_extract("^(https?)://([^/]+)/", ["scheme", "host"]),
            I.regex_extract("[?]page=([0-9]+)", ["page"]),
        ]
    )(urls)
    return out.select(
        "page_id", *[header(n).alias(n) for n in ("scheme", "host", "page")]
    )


@query(
    "regex_extract_millis",
    "SELECT event_id, epoch_us(date_trunc('minute', ts)) // 1000 AS stamped, "
    "CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS kind, "
    "strftime(ts, '%Y-%m-%d %H:%M') AS raw FROM events",
)
def regex_extract_millis(spark, sf):
    df = A.table(spark, sf, "events")
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm"),
        F.when(F.col("event_type") != "click", F.concat(F.lit(" "), "event_type")).otherwise(""),
    )
    ev = to_events(df, {"event_id": F.col("event_id")}, line, keep=("event_id",))
    pattern = r"^(\d{4}-\d\d-\d\d \d\d:\d\d)(?: ([a-z]+))?"
    out = ev.transform(
        I.regex_extract(
            pattern, [("timestamp", I.as_millis("yyyy-MM-dd HH:mm")), "kind"], optional_groups=[2]
        )
    ).transform(I.regex_extract(r"^(\d{4}-\d\d-\d\d \d\d:\d\d)", [("raw", I.as_is)]))
    return out.select(
        "event_id",
        header("timestamp").cast("bigint").alias("stamped"),
        header("kind").alias("kind"),
        header("raw").alias("raw"),
    )


@query(
    "interceptor_chain",
    f"""SELECT event_id, event_type, 'eu' AS dc, regexp_extract(props, '([0-9]+)', 1) AS k,
  regexp_replace(props, '[0-9]', '#', 'g') AS body
FROM events WHERE regexp_matches(props, '"k": [0-9]{{2}}') AND NOT regexp_matches(props, '7')""",
)
def interceptor_chain(spark, sf):
    out = I.chain(
        [
            I.regex_filter('"k": [0-9]{2}'),
            I.regex_filter("7", exclude=True),
            I.add_static("dc", "eu"),
            I.regex_extract("([0-9]+)", ["k"]),
            I.search_replace("[0-9]", "#"),
            I.remove_headers("timestamp"),
        ]
    )(A.events(spark, sf))
    return out.select(
        "event_id",
        header("event_type").alias("event_type"),
        header("dc").alias("dc"),
        header("k").alias("k"),
        body_text().alias("body"),
    )


@query(
    "validate_events",
    """SELECT CASE WHEN length(text) < 40 THEN 'corrupt' WHEN regexp_matches(text, '[.]$') THEN 'valid'
  ELSE 'invalid' END AS status, count(*) AS events FROM documents GROUP BY 1""",
)
def validate_events(spark, sf):
    text = body_text()
    return I.validate_events(
        A.documents(spark, sf), text.rlike(r"[.]\z"), corrupt=F.length(text) < 40
    )


@query(
    "limit_event_size",
    """SELECT doc_id, least(strlen(text), 500) AS size, md5(encode(text)[1:500]) AS digest,
  CASE WHEN strlen(text) > 500 THEN 'Incomplete' END AS status FROM documents""",
)
def limit_event_size(spark, sf):
    out = A.documents(spark, sf).transform(I.limit_size(500))
    return out.select(
        "doc_id",
        F.octet_length("body").cast("bigint").alias("size"),
        F.md5("body").alias("digest"),
        header("syslog.status").alias("status"),
    )


@query("dedupe_events", "SELECT DISTINCT sha256(md5(text)) AS id FROM documents")
def dedupe_events(spark, sf):
    docs = A.documents(spark, sf).withColumn("digest", F.md5("body"))
    ided = docs.transform(I.add_uuid(content=["digest"]))
    return I.dedupe_events(ided).select(header("id").alias("id"))


@query(
    "undelivered_events",
    f"SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'signup') "
    f"OR {MS} % 7 = 0",
)
def undelivered(spark, sf):
    put = A.events(spark, sf)
    done = put.filter(
        ~header("event_type").isin("error", "signup")
        & (F.pmod(header("timestamp").cast("bigint"), F.lit(7)) != 0)
    )
    # At-least-once: the same event may have been delivered twice.
    return missing(put, done.unionByName(done), ["event_id"]).select(
        "event_id", header("event_type").alias("event_type")
    )
