"""Queries over keyed writes, triage, packing and shaped records."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.functions.headers import put, render
from eventflow.operators import merge as U
from eventflow.operators import packing, shred
from eventflow.operators import triage as P
from eventflow.plans import adapters as A
from eventflow.plans.registry import MS, query
from eventflow.schema import body_text, header, to_events
from eventflow.session import shared_dir
from eventflow.sinks import records as R
from eventflow.sinks import tables as S
from eventflow.sinks.databases import Template

# --- keyed writes ---------------------------------------------------------------

_UPDATES = """u AS (SELECT user_id * 11 AS c_custkey, event_id AS seq, k,
    CASE WHEN k % 2 = 0 THEN event_type END AS c_mktsegment, CASE WHEN k % 3 = 0 THEN value END AS c_acctbal
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events)),
f AS (SELECT c_custkey, arg_max(c_mktsegment, seq) FILTER (WHERE c_mktsegment IS NOT NULL) AS c_mktsegment,
    arg_max(c_acctbal, seq) FILTER (WHERE c_acctbal IS NOT NULL) AS c_acctbal FROM u GROUP BY c_custkey)"""


def _updates(spark, sf):
    """Customer changes taken from activity; later ones win, unset fields are null."""
    k = F.get_json_object("props", "$.k").cast("int")
    return A.table(spark, sf, "events").select(
        (F.col("user_id") * 11).alias("c_custkey"),
        F.col("event_id").alias("seq"),
        F.when(F.pmod(k, F.lit(2)) == 0, F.col("event_type")).alias("c_mktsegment"),
        F.when(F.pmod(k, F.lit(3)) == 0, F.col("value")).alias("c_acctbal"),
    )


@query(
    "merge_upsert",
    f"""WITH {_UPDATES}
SELECT coalesce(c.c_custkey, f.c_custkey) AS c_custkey, c.c_name, c.c_nationkey,
  coalesce(f.c_acctbal, c.c_acctbal) AS c_acctbal, coalesce(f.c_mktsegment, c.c_mktsegment) AS c_mktsegment
FROM customer c FULL JOIN f ON c.c_custkey = f.c_custkey""",
)
def merge_upsert(spark, sf):
    return U.merge_upsert(
        A.table(spark, sf, "customer"), _updates(spark, sf), ["c_custkey"], ["seq"]
    )


@query(
    "merge_upsert_orders",
    """WITH u AS (SELECT l_orderkey + 5000 AS o_orderkey, max(struct_pack(a := l_shipdate, b := l_quantity,
    c := l_extendedprice)) AS top, max(l_shipdate) AS o_orderdate FROM lineitem GROUP BY 1)
SELECT coalesce(o.o_orderkey, u.o_orderkey) AS o_orderkey, coalesce(u.top.c, o.o_totalprice) AS o_totalprice,
  o.o_orderstatus FROM orders o FULL JOIN u ON o.o_orderkey = u.o_orderkey""",
)
def merge_upsert_orders(spark, sf):
    updates = A.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") + 5000).alias("o_orderkey"),
        F.col("l_extendedprice").alias("o_totalprice"),
        "l_shipdate", "l_quantity",
        F.col("l_extendedprice").alias("tie"),
    )
    target = A.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return U.merge_upsert(target, updates, ["o_orderkey"], ["l_shipdate", "l_quantity", "tie"])


@query(
    "update_or_insert_actions",
    f"""WITH {_UPDATES}
SELECT f.c_custkey, f.c_mktsegment, f.c_acctbal, CASE WHEN c.c_custkey IS NULL THEN 'insert'
  WHEN f.c_mktsegment IS NULL OR f.c_mktsegment = c.c_mktsegment THEN 'update' ELSE 'skip' END AS action
FROM f LEFT JOIN customer c ON c.c_custkey = f.c_custkey""",
)
def update_or_insert_actions(spark, sf):
    return U.update_or_insert(
        A.table(spark, sf, "customer"), _updates(spark, sf), "c_custkey", ["seq"],
        where=["c_mktsegment"],
    )


@query(
    "apply_updates",
    f"""WITH {_UPDATES}
SELECT coalesce(c.c_custkey, f.c_custkey) AS c_custkey, c.c_name, c.c_nationkey,
  coalesce(f.c_acctbal, c.c_acctbal) AS c_acctbal, coalesce(f.c_mktsegment, c.c_mktsegment) AS c_mktsegment
FROM customer c FULL JOIN f ON c.c_custkey = f.c_custkey""",
)
def apply_updates(spark, sf):
    return U.apply_updates(
        A.table(spark, sf, "customer"), _updates(spark, sf), "c_custkey", ["seq"]
    )


@query(
    "upsert_table",
    f"""WITH {_UPDATES}
SELECT coalesce(c.c_custkey, f.c_custkey) AS c_custkey, coalesce(c.c_nationkey, -1) AS c_nationkey,
  coalesce(f.c_acctbal, c.c_acctbal) AS c_acctbal, coalesce(f.c_mktsegment, c.c_mktsegment) AS c_mktsegment
FROM customer c FULL JOIN f ON c.c_custkey = f.c_custkey""",
)
def upsert_table(spark, sf):
    """The customers as a table by nation; only nations with changed customers are rewritten."""
    path = shared_dir(spark, "customers")
    columns = ["c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey"]
    A.table(spark, sf, "customer").select(*columns).write.partitionBy("c_nationkey").parquet(path)
    updates = _updates(spark, sf).withColumn("c_nationkey", F.lit(-1))
    U.upsert_table(spark, path, updates, ["c_custkey"], ["seq"], ["c_nationkey"])
    return spark.read.parquet(path).select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")


@query(
    "insert_rows",
    "SELECT event_id::INT AS visitNumber, value::VARCHAR AS spent, user_id AS shopperId FROM events",
)
def insert_rows(spark, sf):
    schema = T.StructType.fromDDL("visitNumber int, spent string, shopperId bigint, other date")
    fields = A.table(spark, sf, "events").select(
        F.col("event_id").alias("VISITNUMBER"),
        F.col("value").alias("Spent"),
        F.col("user_id").alias("shopperid"),
        F.col("props").alias("unmapped"),
    )
    return U.insert_rows(fields, schema)


@query(
    "template_bindings",
    "SELECT o_orderkey, o_orderstatus AS p0, o_custkey::INT AS p1, o_totalprice AS p2, "
    "NULL::VARCHAR AS p3 FROM orders",
)
def template_bindings(spark, sf):
    template = Template.parse(
        "UPDATE t SET s = ${O_OrderStatus:varchar}, c = ${o_custkey:integer} "
        "WHERE p > ${o_totalprice:double} AND n = ${nothing:varchar}"
    )
    return template.bindings(A.table(spark, sf, "orders"), keep=("o_orderkey",))


# --- triage ---------------------------------------------------------------------


@query(
    "split_poison",
    """WITH t AS (SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events)
SELECT event_id, CASE WHEN k < 10 THEN 'dropped' WHEN k % 11 = 0 THEN 'poison' ELSE 'ok' END AS status,
  CASE WHEN k >= 10 AND k % 11 <> 0 THEN 'true' END AS done, CASE WHEN k >= 10 AND k % 11 = 0 THEN 'true' END AS poisoned
FROM t""",
)
def split_poison(spark, sf):
    k = F.get_json_object(F.col("body").cast("string"), "$.k").cast("int")
    out = P.split_poison(A.events(spark, sf), F.when(k >= 10, k), F.pmod(k, F.lit(11)) != 0)
    return out.select(
        "event_id", "status",
        header(P.DONE_HEADER).alias("done"), header(P.POISON_HEADER).alias("poisoned"),
    )


_PACK = """WITH RECURSIVE r AS (SELECT doc_id, doc_id % 8 AS lane, strlen(text) AS n, row_number() OVER
    (PARTITION BY doc_id % 8 ORDER BY doc_id) AS rn FROM documents WHERE strlen(text) <= 30000),
f AS (SELECT DISTINCT doc_id % 8 AS lane, 0::BIGINT AS rn, 0::BIGINT AS doc_id, 0::BIGINT AS batch,
    'none' AS kind, 0::BIGINT AS nb, 0::BIGINT AS nc, 0::BIGINT AS nu FROM documents
  UNION ALL
  SELECT r.lane, r.rn, r.doc_id, f.nb, CASE WHEN nu + n <= 40000 THEN 'main' ELSE 'spill' END,
    CASE WHEN nu + n > 40000 OR nc + 1 = 12 THEN nb + 1 ELSE nb END,
    CASE WHEN nu + n > 40000 OR nc + 1 = 12 THEN 0 ELSE nc + 1 END,
    CASE WHEN nu + n > 40000 OR nc + 1 = 12 THEN 0 ELSE nu + n END
  FROM f JOIN r ON r.lane = f.lane AND r.rn = f.rn + 1)"""


@query(
    "pack_batches",
    _PACK
    + """ SELECT doc_id, lane, batch, kind AS batch_kind FROM f WHERE rn > 0
UNION ALL SELECT doc_id, doc_id % 8, NULL, 'dropped' FROM documents WHERE strlen(text) > 30000""",
)
def pack_batches(spark, sf):
    packed = packing.pack_batches(
        A.documents(spark, sf), ["doc_id"], max_count=12, max_bytes=40_000, max_event=30_000,
        lane=F.pmod("doc_id", F.lit(8)),
    )
    return packed.select("doc_id", "lane", "batch", "batch_kind")


@query(
    "pack_batches_by_hash",
    "SELECT count(*) AS events, CAST(sum(strlen(text)) AS BIGINT) AS bytes, true AS within_limits FROM documents",
)
def pack_batches_by_hash(spark, sf):
    """Default lanes: everything is packed once and no request breaks a limit."""
    packed = packing.pack_batches(
        A.documents(spark, sf), ["doc_id"], max_count=20, max_bytes=100_000
    )
    size = F.octet_length("body")
    requests = packed.groupBy("lane", "batch", "batch_kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")
    )
    spill = F.col("batch_kind") == packing.SPILL
    fits = F.when(spill, F.col("n") == 1).otherwise((F.col("n") <= 20) & (F.col("b") <= 100_000))
    return requests.agg(
        F.sum("n").alias("events"), F.sum("b").alias("bytes"), F.bool_and(fits).alias("within_limits")
    )


@query(
    "retry_failed_sends",
    "SELECT event_id, (event_id % 5)::INT AS failures FROM events WHERE event_id % 5 >= 3",
)
def retry_failed_sends(spark, sf):
    """Each event fails as often as its id says; three attempts leave the stubborn ones."""
    staged = A.events(spark, sf).select(
        "event_id", F.pmod("event_id", F.lit(5)).cast("int").alias("failures"),
        F.lit(0).alias("tries"),
    )

    def send(df):
        return df.withColumn("tries", F.col("tries") + 1).withColumn(
            "sent", F.col("tries") > F.col("failures")
        )

    return packing.retry_failed(staged, send, attempts=3).select("event_id", "failures")


# --- relational form --------------------------------------------------------------


def _long_events(spark, sf):
    """Documents with one header longer than the in-row limit."""
    docs = A.documents(spark, sf)
    long = {"opening": F.substring(body_text(), 1, 400), "x" * 260: F.lit("long name")}
    return docs.withColumn("headers", put(F.col("headers"), long))


@query(
    "shred_events",
    """WITH d AS (SELECT doc_id, strlen(text) AS n, length(substr(text, 1, 400)) AS o FROM documents)
SELECT 'event' AS part, count(*) AS n, CAST(sum(least(n, 16384)) AS BIGINT) AS size FROM d
UNION ALL SELECT 'payload_spill', count(*), CAST(sum(n - 16384) AS BIGINT) FROM d WHERE n > 16384
UNION ALL SELECT 'header', count(*) * 5, CAST(sum(least(o, 251)) AS BIGINT) FROM d
UNION ALL SELECT 'name_spill', count(*), CAST(count(*) * 9 AS BIGINT) FROM d
UNION ALL SELECT 'value_spill', count(*), CAST(sum(o - 251) AS BIGINT) FROM d WHERE o > 251""",
)
def shred_events(spark, sf):
    t = shred.shred_events(_long_events(spark, sf), "doc_id")
    opening = F.when(F.col("name") == "opening", F.length("value"))
    sizes = {
        "event": F.sum(F.octet_length("payload")),
        "payload_spill": F.sum(F.octet_length("payload")),
        "header": F.sum(opening),
        "name_spill": F.sum(F.length("name")),
        "value_spill": F.sum(F.length("value")),
    }
    out = None
    for name, size in sizes.items():
        part = t[name].agg(F.count(F.lit(1)).alias("n"), size.alias("size"))
        part = part.select(F.lit(name).alias("part"), "n", "size")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "assemble_events",
    """SELECT doc_id, '{doc_id=' || doc_id || ', lang=' || lang || ', opening=' || substr(text, 1, 400) || ', source='
  || source || ', ' || repeat('x', 260) || '=long name}' AS headers, text AS body FROM documents""",
)
def assemble_events(spark, sf):
    tables = shred.shred_events(_long_events(spark, sf), "doc_id")
    back = shred.assemble_events(tables, "doc_id")
    return back.select(
        "doc_id", render(F.col("headers")).alias("headers"), body_text().alias("body")
    )


# --- records ----------------------------------------------------------------------


@query(
    "topic_records",
    f"""SELECT event_id, CASE WHEN event_type = 'click' THEN 'clicks' ELSE 'ev-' || strftime(ts, '%Y%m%d') END AS topic,
  user_id::VARCHAR AS key, props AS value, CASE WHEN event_type = 'click' THEN (user_id % 6)::INT ELSE 9 END AS partition
FROM events""",
)
def topic_records(spark, sf):
    click = F.col("event_type") == "click"
    ev = to_events(
        A.table(spark, sf, "events"),
        {
            "topic": F.when(click, F.lit("clicks")),
            "timestamp": A.epoch_ms("ts"),
            "key": F.col("user_id"),
            "part": F.when(click, F.pmod("user_id", F.lit(6))),
        },
        F.col("props"),
        keep=("event_id",),
        drop_null=True,
    )
    out = R.to_topic_records(
        ev, "ev-%Y%m%d", partition_header="part", default_partition=9, keep=("event_id",)
    )
    return out.withColumn("value", F.col("value").cast("string"))


@query(
    "topic_records_literal",
    "SELECT event_id, 'ev-%Y' AS topic, NULL::VARCHAR AS key, "
    "'{\"headers\":{\"event_type\":\"' || event_type || '\"},\"body\":\"' || replace(props, '\"', '\\\"') || '\"}' "
    "AS value, NULL::INT AS partition FROM events",
)
def topic_records_literal(spark, sf):
    ev = to_events(
        A.table(spark, sf, "events"), {"event_type": F.col("event_type")}, F.col("props"),
        keep=("event_id",),
    )
    out = R.to_topic_records(
        ev, "ev-%Y", allow_override=False, event_format=True, keep=("event_id",)
    )
    return out.withColumn("value", F.col("value").cast("string"))


@query(
    "carry_over_failures",
    "SELECT event_type AS topic, count(*) + count(*) FILTER (WHERE event_id % 9 = 0) AS records "
    "FROM events GROUP BY event_type",
)
def carry_over_failures(spark, sf):
    """Failed records of one batch lead the next one; nothing is lost."""
    batch = A.table(spark, sf, "events").withColumnRenamed("event_type", "topic")
    failed = batch.filter(F.pmod("event_id", F.lit(9)) == 0)
    return R.carry_over(failed, batch).groupBy("topic").agg(F.count(F.lit(1)).alias("records"))


@query(
    "index_documents",
    "SELECT event_id, 'act-' || strftime(ts, '%Y-%m-%d') AS \"index\", 'kind-' || event_type AS type, "
    "props AS document FROM events",
)
def index_documents(spark, sf):
    return R.to_index_documents(
        A.events(spark, sf), "act", "kind-%{event_type}", keep=("event_id",), mode="time"
    )


@query(
    "regex_columns",
    r"""SELECT page_id, regexp_extract(url, '^(https?)://([^/]+)/([a-z]+)/([0-9]+).*$', 1) AS scheme,
  regexp_extract(url, '^(https?)://([^/]+)/([a-z]+)/([0-9]+).*$', 2) AS host,
  regexp_extract(url, '^(https?)://([^/]+)/([a-z]+)/([0-9]+).*$', 4) AS item
FROM pages WHERE regexp_matches(url, '^(https?)://([^/]+)/([a-z]+)/([0-9]+).*$')""",
)
def regex_columns(spark, sf):
    ev = to_events(A.table(spark, sf, "pages"), {}, F.col("url"), keep=("page_id",))
    out = R.regex_columns(
        ev, "(https?)://([^/]+)/([a-z]+)/([0-9]+).*", ["scheme", "host", "lang", "item"], ("page_id",)
    )
    return out.drop("lang")


@query(
    "classify_responses",
    """WITH s AS (SELECT event_id, 200 + (event_id % 4) * 100 + event_id % 3 AS code FROM events)
SELECT event_id, code <> 200 AND code NOT BETWEEN 300 AND 399 AS backoff,
  CASE WHEN code = 201 THEN true WHEN code BETWEEN 200 AND 299 THEN false ELSE true END AS rollback,
  code BETWEEN 200 AND 299 AND code <> 202 AS counted FROM s""",
)
def classify_responses(spark, sf):
    code = F.lit(200) + F.pmod("event_id", F.lit(4)) * 100 + F.pmod("event_id", F.lit(3))
    rules = R.classify_status(
        code,
        backoff={"200": False, "3XX": False},
        rollback={"2XX": False, "201": True},
        count={"2XX": True, "202": False},
    )
    df = A.table(spark, sf, "events").select("event_id", rules.alias("r"))
    return df.select(
        "event_id", "r.backoff", "r.rollback", F.col("r.count").alias("counted")
    )


V1 = '{"type":"record","name":"visit","fields":[{"name":"code","type":"string"}]}'
V2 = (
    '{"type":"record","name":"visit","fields":[{"name":"code","type":"string"},'
    '{"name":"shopper","type":"int","default":0},{"name":"action","type":["string","null"],"default":"none"}]}'
)
OTHER = '{"type":"record","name":"shop","fields":[{"name":"title","type":"string"}]}'


def dataset_events(spark, sf):
    """Bodies written with three schemas, named by a URL header or given literally."""
    kind = F.pmod("event_id", F.lit(4))
    body = (
        F.when(kind == 0, F.to_json(F.struct(F.col("event_id").cast("string").alias("code"))))
        .when(
            kind == 1,
            F.to_json(
                F.struct(
                    F.col("event_id").cast("string").alias("code"),
                    F.col("user_id").cast("int").alias("shopper"),
                    F.col("event_type").alias("action"),
                )
            ),
        )
        .when(kind == 2, F.to_json(F.struct(F.col("event_type").alias("title"))))
        .otherwise(F.lit("{broken"))
    )
    return to_events(
        A.table(spark, sf, "events"),
        {
            S.LITERAL_HEADER: F.when(kind == 0, F.lit(V1)).otherwise(F.lit(OTHER)),
            S.URL_HEADER: F.when(kind != 0, F.when(kind == 2, F.lit("u")).otherwise(F.lit("v2"))),
        },
        body,
        keep=("event_id",),
        drop_null=True,
    )


WRITERS = {V1: V1, "v2": V2, "u": OTHER}


@query(
    "decode_dataset",
    """SELECT event_id, CASE WHEN event_id % 4 <= 1 THEN event_id::VARCHAR END AS code,
  CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN user_id::INT END AS shopper,
  CASE event_id % 4 WHEN 0 THEN 'none' WHEN 1 THEN event_type END AS action,
  event_id % 4 <= 1 AS decodable FROM events""",
)
def decode_dataset(spark, sf):
    out = S.decode_dataset(dataset_events(spark, sf), S.RecordSchema.parse(V2), WRITERS)
    return out.select(
        "event_id", "row.code", "row.shopper", "row.action", F.col("row").isNotNull().alias("decodable")
    )


VISIT_WRITTEN = json.dumps({
    "type": "record", "name": "visit", "namespace": "written", "fields": [
        {"name": "number", "type": "int"},
        {"name": "shopper", "type": {"type": "record", "name": "person", "fields": [
            {"name": "id", "type": "int"},
            {"name": "marks", "type": {"type": "array", "items": "string"}},
        ]}},
        {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "day", "type": {"type": "int", "logicalType": "date"}},
        {"name": "action", "type": {"type": "enum", "name": "action", "symbols": [
            "click", "view", "purchase", "signup", "error", "logout", "login", "search"]}},
        {"name": "detail", "type": ["null", "int", "string", "boolean"]},
        {"name": "counts", "type": {"type": "map", "values": ["null", "int"]}},
        {"name": "price", "type": {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}},
        {"name": "dropped", "type": ["null", "person"]},
    ],
})
VISIT_TABLE = json.dumps({
    "type": "record", "name": "purchase_visit", "aliases": ["visit"], "fields": [
        {"name": "key", "aliases": ["number"], "type": "long"},
        {"name": "shopper", "type": {"type": "record", "name": "customer", "aliases": ["person"], "fields": [
            {"name": "id", "type": "double"},
            {"name": "marks", "type": {"type": "array", "items": ["null", "string"]}},
            {"name": "level", "type": "int", "default": 7},
        ]}},
        {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "day", "type": {"type": "int", "logicalType": "date"}},
        {"name": "action", "type": {"type": "enum", "name": "kind", "aliases": ["action"],
                                    "symbols": ["click", "view", "other"], "default": "other"}},
        {"name": "detail", "type": ["null", "double", "string"]},
        {"name": "counts", "type": {"type": "map", "values": ["long", "null"]}},
        {"name": "price", "type": {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}},
        {"name": "origin", "type": {"type": "record", "name": "place", "fields": [
            {"name": "city", "type": "string"}, {"name": "codes", "type": {"type": "array", "items": "int"}}]},
         "default": {"city": "nowhere", "codes": [1, 2, 3]}},
    ],
})
#: Its number is a text, which no table type of ours reads.
VISIT_UNREADABLE = json.dumps({"type": "record", "name": "visit", "fields": [{"name": "number", "type": "boolean"}]})


def nested_events(spark, sf):
    """Visits as nested JSON: some hold a choice, an item or a type that must fail."""
    n = F.pmod("event_id", F.lit(8))
    detail = (
        F.when(n == 1, F.col("user_id").cast("string"))
        .when(n == 2, F.concat(F.lit('"'), "event_type", F.lit('"')))
        .when(n == 3, F.lit("true"))  # a choice that the table lacks
        .otherwise(F.lit("null"))
    )
    marks = F.when(n == 4, F.lit('["a",null]')).otherwise(F.concat(F.lit('["'), "event_type", F.lit('","b"]')))
    body = F.concat(
        F.lit('{"number":'), F.col("event_id").cast("string"),
        F.lit(',"shopper":{"id":'), F.col("user_id").cast("string"), F.lit(',"marks":'), marks,
        F.lit('},"at":'), A.epoch_ms("ts").cast("string"),
        F.lit(',"day":'), F.unix_date(F.col("ts").cast("date")).cast("string"),
        F.lit(',"action":"'), "event_type", F.lit('","detail":'), detail,
        F.lit(',"counts":{"k":'), F.when(n == 5, F.lit("1.5")).otherwise(F.get_json_object("props", "$.k")),
        F.lit(',"none":null},"price":'), F.round("value", 2).cast("decimal(9,2)").cast("string"),
        F.lit(',"more":[{}]}'),
    )
    names = {S.URL_HEADER: F.when(n == 6, F.lit("unreadable")).when(n == 7, F.lit("?")).otherwise(F.lit("visit"))}
    return to_events(A.table(spark, sf, "events"), names, body, keep=("event_id",))


@query(
    "decode_dataset_nested",
    """WITH e AS (SELECT *, event_id % 8 IN (0, 1, 2) AS ok, (event_id % 8)::INT AS n FROM events)
SELECT event_id, ok AS decodable, CASE WHEN ok THEN event_id END AS key,
  CASE WHEN ok THEN user_id::DOUBLE END AS shopper, CASE WHEN ok THEN event_type || ',b' END AS marks,
  CASE WHEN ok THEN 7 END AS level, CASE WHEN ok THEN epoch_us(ts) // 1000 END AS at_ms,
  CASE WHEN ok THEN ts::DATE END AS day,
  CASE WHEN ok THEN CASE WHEN event_type IN ('click', 'view') THEN event_type ELSE 'other' END END AS action,
  CASE WHEN n = 1 THEN user_id::DOUBLE END AS detail_number, CASE WHEN n = 2 THEN event_type END AS detail_text,
  CASE WHEN ok THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END AS count_k,
  CASE WHEN ok THEN round(value, 2)::DECIMAL(9, 2)::DOUBLE END AS price, CASE WHEN ok THEN 'nowhere' END AS city,
  CASE WHEN ok THEN 6 END AS codes FROM e""",
)
def decode_dataset_nested(spark, sf):
    writers = {"visit": VISIT_WRITTEN, "unreadable": VISIT_UNREADABLE}
    out = S.decode_dataset(nested_events(spark, sf), S.RecordSchema.parse(VISIT_TABLE), writers)
    return out.select(
        "event_id", F.col("row").isNotNull().alias("decodable"), "row.key", F.col("row.shopper.id").alias("shopper"),
        F.array_join("row.shopper.marks", ",").alias("marks"), "row.shopper.level",
        F.unix_millis("row.at").alias("at_ms"), "row.day", "row.action",
        F.col("row.detail.member0").alias("detail_number"), F.col("row.detail.member1").alias("detail_text"),
        F.col("row.counts")["k"].alias("count_k"), F.col("row.price").cast("double").alias("price"), "row.origin.city",
        F.aggregate("row.origin.codes", F.lit(0), lambda a, x: a + x).alias("codes"),
    )
