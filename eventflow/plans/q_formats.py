"""Queries over text formats of events."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.functions import text as X
from eventflow.operators.triage import typed_rows, typed_rows_by, undecodable
from eventflow.plans import adapters as A
from eventflow.plans.registry import MS, query
from eventflow.schema import body_text, header, to_events
from eventflow.sinks import tables as S
from eventflow.sources import generators as G
from eventflow.sources.payloads import read_lines
from eventflow.sources.tables import rows_to_events

_LINES = """WITH a AS (SELECT doc_id, string_split(text, chr(10)) AS l, ends_with(text, chr(10)) AS nl FROM documents),
  w AS (SELECT doc_id, nl, CASE WHEN nl THEN l[1:len(l) - 1] ELSE l END AS l FROM a),
  u AS (SELECT doc_id, nl, len(l) AS total, unnest(range(0, len(l))) AS i, l FROM w),
  v AS (SELECT doc_id, i, l[i + 1] AS line, (i < total - 1 OR nl) AS ended FROM u)"""


@query(
    "line_events",
    _LINES
    + """, p AS (SELECT doc_id, i, line, unnest(range(0, greatest((length(line) + 119) // 120, 1))) AS k FROM v)
SELECT doc_id, count(*) AS events, CAST(sum(strlen(substr(line, k * 120 + 1, 120))) AS BIGINT) AS bytes,
  count(*) FILTER (WHERE length(line) = 0) AS empty, CAST(max(length(substr(line, k * 120 + 1, 120))) AS INT) AS longest
FROM p GROUP BY doc_id""",
)
def line_events(spark, sf):
    df = A.table(spark, sf, "documents").select("doc_id", "text")
    lines = read_lines(df, "text", max_length=120)
    return lines.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.octet_length("body")).alias("bytes"),
        F.count_if(F.octet_length("body") == 0).alias("empty"),
        F.max(F.length(F.col("body").cast("string"))).alias("longest"),
    )


@query(
    "line_events_text",
    _LINES
    + """, p AS (SELECT doc_id, i, line, unnest(range(0, greatest((length(line) + 99) // 100, 1))) AS k FROM v)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i, k) - 1)::INT AS line_no,
  substr(line, k * 100 + 1, 100) AS body FROM p""",
)
def line_events_text(spark, sf):
    df = A.table(spark, sf, "documents").select("doc_id", "text")
    return read_lines(df, "text", max_length=100).select(
        "doc_id", "line_no", body_text().alias("body")
    )


@query(
    "line_events_compat",
    _LINES
    + """, p AS (SELECT doc_id, (greatest((length(line) + 9) // 10, 1)
    + CASE WHEN length(line) > 0 AND length(line) % 10 = 0 AND ended THEN 1 ELSE 0 END) AS n FROM v)
SELECT doc_id, CAST(sum(n) AS BIGINT) AS events FROM p GROUP BY doc_id""",
)
def line_events_compat(spark, sf):
    df = A.table(spark, sf, "documents").select("doc_id", "text")
    return read_lines(df, "text", max_length=10, compat=True).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("events")
    )


@query(
    "decode_error_policies",
    "SELECT doc_id, text || chr(65533) AS replaced, text AS ignored FROM documents",
)
def decode_error_policies(spark, sf):
    df = A.table(spark, sf, "documents")
    broken = F.concat(F.col("text").cast("binary"), F.lit(b"\xff"))
    return df.select(
        "doc_id",
        X.decode_text(broken, "REPLACE").alias("replaced"),
        X.decode_text(broken, "IGNORE").alias("ignored"),
    )


@query(
    "header_and_text",
    f"""SELECT event_id, '{{event_id=' || event_id || ', event_type=' || event_type || ', timestamp=' || {MS}
  || ', user_id=' || user_id || '}} ' || props AS line FROM events""",
)
def header_and_text(spark, sf):
    return A.events(spark, sf).select(
        "event_id", X.header_and_text(F.col("headers"), F.col("body")).alias("line")
    )


@query(
    "dump_events",
    f"""SELECT event_id, '{{ headers:{{event_id=' || event_id || ', event_type=' || event_type || ', timestamp=' || {MS}
  || ', user_id=' || user_id || '}} body: ' ||
  rpad(regexp_replace(hex(encode(props)), '(..)', '\\1 ', 'g'), 48, ' ') || props || ' }}' AS line FROM events""",
)
def dump_events(spark, sf):
    return A.events(spark, sf).select(
        "event_id", X.dump(F.col("headers"), F.col("body")).alias("line")
    )


@query(
    "table_rows_to_events",
    """SELECT o_orderkey, 5::BIGINT AS stamped, '"' || o_orderkey || '","' || o_custkey || '","' || o_orderstatus || '","'
  || (CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority ELSE '' END) || '"' AS quoted,
  o_orderkey || ';' || o_orderpriority AS plain FROM orders""",
)
def table_rows_to_events(spark, sf):
    df = A.table(spark, sf, "orders").withColumn(
        "maybe", F.when(F.pmod("o_custkey", F.lit(2)) == 0, F.col("o_orderpriority"))
    )
    quoted = rows_to_events(
        df, ["o_orderkey", "o_custkey", "o_orderstatus", "maybe"], clock=F.lit(5),
        keep=("o_orderkey", "o_orderpriority"),
    )
    return quoted.select(
        "o_orderkey",
        header("timestamp").cast("bigint").alias("stamped"),
        body_text().alias("quoted"),
        X.csv_line(["o_orderkey", "o_orderpriority"], quote_all=False, sep=";").alias("plain"),
    )


@query(
    "delimited_rows",
    """SELECT o_orderkey AS id, o_custkey::INT AS cust, o_orderpriority AS priority, NULL::DOUBLE AS absent
FROM orders""",
)
def delimited_rows(spark, sf):
    schema = T.StructType.fromDDL("id bigint, cust int, priority string, absent double")
    ev = A.orders_csv(spark, sf, quote_all=False)
    return S.delimited_rows(ev, ["ID", "cust", "", "priority"], schema)


@query(
    "json_rows",
    "SELECT event_id, user_id, event_type, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events",
)
def json_rows(spark, sf):
    df = A.table(spark, sf, "events")
    doc = F.to_json(
        F.struct(
            "event_id", "user_id", "event_type", "value",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            F.lit("ignored").alias("extra"),
        )
    )
    schema = T.StructType.fromDDL(
        "event_id bigint, user_id bigint, event_type string, value double, k int"
    )
    return S.json_rows(to_events(df, {}, doc), schema)


@query(
    "typed_rows_from_bodies",
    "SELECT conv_id, turn, role FROM conversations WHERE conv_id % 4 <> 1",
)
def typed_rows_from_bodies(spark, sf):
    """Bodies are JSON arrays of records; those of every fourth conversation are cut short
    and yield nothing."""
    rows = typed_rows(_record_arrays(spark, sf), "struct<turn:bigint,role:string>")
    return rows.select("conv_id", "row.turn", "row.role")


@query(
    "typed_rows_udtf",
    "SELECT conv_id, turn, role, length(role)::INTEGER AS size FROM conversations WHERE conv_id % 4 <> 1",
)
def typed_rows_udtf(spark, sf):
    """As typed_rows_from_bodies, by a Python table function."""

    def records(body: bytes):
        import json

        return [(r["turn"], r["role"], len(r["role"])) for r in json.loads(body)]

    rows = typed_rows_by(
        _record_arrays(spark, sf).select("conv_id", "body"), records, "turn bigint, role string, size int"
    )
    return rows.select("conv_id", "turn", "role", "size")


@query(
    "first_row_from_bodies",
    "SELECT conv_id, turn // 3 AS batch_no, min(turn) AS turn FROM conversations "
    "WHERE conv_id % 4 <> 1 GROUP BY 1, 2",
)
def first_row_from_bodies(spark, sf):
    rows = typed_rows(
        _record_arrays(spark, sf), "struct<turn:bigint,role:string>", first_only=True
    )
    return rows.select("conv_id", "batch_no", "row.turn")


@query(
    "undecodable_bodies",
    "SELECT DISTINCT conv_id, turn // 3 AS batch_no FROM conversations WHERE conv_id % 4 = 1",
)
def undecodable_bodies(spark, sf):
    bad = undecodable(_record_arrays(spark, sf), "struct<turn:bigint,role:string>")
    return bad.select("conv_id", "batch_no")


def _record_arrays(spark, sf):
    """JSON arrays of up to three records of a conversation."""
    df = A.table(spark, sf, "conversations")
    grouped = df.groupBy("conv_id", F.floor(F.col("turn") / 3).alias("batch_no")).agg(
        F.to_json(F.array_sort(F.collect_list(F.struct("turn", "role")))).alias("doc")
    )
    cut = F.when(
        F.pmod("conv_id", F.lit(4)) == 1, F.expr("substring(doc, 1, length(doc) - 2)")
    ).otherwise(F.col("doc"))
    return to_events(grouped, {"conv_id": F.col("conv_id")}, cut, keep=("conv_id", "batch_no"))


@query(
    "sequence_events",
    "SELECT (row_number() OVER (ORDER BY o_orderkey) + 99)::VARCHAR AS body FROM orders",
)
def sequence_events(spark, sf):
    """A counter event for every order."""
    total = A.table(spark, sf, "orders").count()
    return G.sequence(spark, total, start=100).select(body_text().alias("body"))


@query(
    "stress_events",
    "SELECT count(*) AS events, CAST(count(*) * 500 AS BIGINT) AS bytes, "
    "count(*) AS intact FROM events",
)
def stress_events(spark, sf):
    """A load event for every activity row."""
    total = A.table(spark, sf, "events").count()
    whole = F.hex("body") == F.lit("7F" * 500)
    return G.stress(spark, total).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.octet_length("body")).alias("bytes"),
        F.count_if(whole).alias("intact"),
    )
