"""Queries over flow accounting."""

from pyspark.sql import functions as F

from eventflow.operators import indexing, metrics as M
from eventflow.operators import routing as R
from eventflow.operators import triage as T
from eventflow.plans import adapters as A
from eventflow.plans.registry import query
from eventflow.schema import header


@query(
    "source_counters",
    """SELECT event_type, count(*) AS received, count(*) FILTER (WHERE value > 50) AS accepted,
  CAST(ceil(count(*) / 100.0) AS BIGINT) AS append_batches FROM events GROUP BY event_type""",
)
def source_counters(spark, sf):
    df = A.table(spark, sf, "events")
    return M.source_counters(df, F.col("value") > 50, ["event_type"])


@query(
    "channel_counters",
    """WITH r AS (SELECT strlen(text) AS n, unnest(CASE lang WHEN 'en' THEN ['a', 'b'] ELSE ['b'] END) AS channel
  FROM documents)
SELECT channel, count(*) AS events, CAST(sum(n) AS BIGINT) AS bytes,
  CAST(sum((n + 99) // 100) AS BIGINT) AS slots FROM r GROUP BY channel""",
)
def channel_counters(spark, sf):
    routed = R.multiplex(A.documents(spark, sf, ()), "lang", {"en": "a b"}, "b")
    return M.channel_counters(routed)


@query(
    "put_take_counters",
    """SELECT event_type, count(*) AS put, count(*) FILTER (WHERE event_id % 10 <> 3 AND event_type <> 'view') AS taken,
  count(*) - count(*) FILTER (WHERE event_id % 10 <> 3 AND event_type <> 'view') AS size
FROM events GROUP BY event_type""",
)
def put_take_counters(spark, sf):
    df = A.table(spark, sf, "events")
    taken = df.filter((F.pmod("event_id", F.lit(10)) != 3) & (F.col("event_type") != "view"))
    return M.put_take_counters(df, taken, ["event_type"])


@query(
    "batch_classes",
    """WITH b AS (SELECT CAST(user_id AS BIGINT) AS batch, count(*) AS n FROM events GROUP BY 1),
  a AS (SELECT c_custkey AS batch, coalesce(n, 0) AS n FROM customer LEFT JOIN b ON c_custkey = batch)
SELECT CASE WHEN n = 0 THEN 'empty' WHEN n < 70 THEN 'underflow' ELSE 'complete' END AS batch_class,
  count(*) AS batches, CAST(sum(n) AS BIGINT) AS events FROM a GROUP BY 1""",
)
def batch_classes(spark, sf):
    df = A.table(spark, sf, "events").withColumnRenamed("user_id", "batch")
    known = A.table(spark, sf, "customer").select(F.col("c_custkey").alias("batch"))
    return M.batch_classes(df, "batch", 70, known)


@query(
    "drain_batches",
    """WITH n AS (SELECT (row_number() OVER (ORDER BY event_id) - 1) // 300 AS batch FROM events),
  s AS (SELECT batch, count(*) AS n FROM n GROUP BY batch)
SELECT CASE WHEN n < 300 THEN 'underflow' ELSE 'complete' END AS batch_class, count(*) AS batches,
  CAST(sum(n) AS BIGINT) AS events FROM s GROUP BY 1""",
)
def drain_batches(spark, sf):
    indexed = indexing.with_arrival_index(A.events(spark, sf), ["event_id"], "i")
    return M.batch_classes(indexed.withColumn("b", F.floor(F.col("i") / 300)), "b", 300)


@query(
    "error_counters",
    """WITH t AS (SELECT event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events)
SELECT event_type, count(*) AS attempted, count(*) FILTER (WHERE k < 10) AS deserialization_errors,
  count(*) FILTER (WHERE k >= 10 AND k % 11 = 0) AS processing_errors,
  max(CASE WHEN k >= 10 AND k % 11 = 0 THEN 1 ELSE 0 END)::INT AS rolled_back FROM t GROUP BY event_type""",
)
def error_counters(spark, sf):
    k = F.get_json_object(F.col("body").cast("string"), "$.k").cast("int")
    triaged = T.split_poison(
        A.events(spark, sf), F.when(k >= 10, k), F.pmod(k, F.lit(11)) != 0
    )
    counted = triaged.withColumn("event_type", header("event_type"))
    return M.error_counters(counted, ["event_type"])


@query(
    "topic_failure_counts",
    "SELECT 'orders-' || o_orderstatus AS topic, count(*) AS failures FROM orders "
    "WHERE o_custkey % 17 = 0 GROUP BY 1",
)
def topic_failure_counts(spark, sf):
    failed = A.table(spark, sf, "orders").filter(F.pmod("o_custkey", F.lit(17)) == 0)
    return M.failure_counts(
        failed.withColumn("topic", F.concat(F.lit("orders-"), "o_orderstatus"))
    )


@query(
    "named_counters",
    """WITH c AS (SELECT role AS counter_group, min(turn) AS start_time, max(turn) AS stop_time,
    count(*) AS received, count(*) FILTER (WHERE contains(text, chr(10))) AS multiline
  FROM conversations GROUP BY role)
SELECT counter_group, start_time, stop_time, 'received' AS counter, received AS value FROM c
UNION ALL SELECT counter_group, start_time, stop_time, 'multiline', multiline FROM c""",
)
def named_counters(spark, sf):
    df = A.table(spark, sf, "conversations")
    counters = {"received": F.lit(True), "multiline": F.contains("text", F.lit("\n"))}
    return M.named_counters(df, "role", counters, "turn")


@query(
    "byte_accounting",
    """SELECT lang, CAST(sum((strlen(text) + 99) // 100) AS BIGINT) AS slots,
  CAST(max((strlen(text) + 99) // 100) AS BIGINT) AS largest FROM documents GROUP BY lang""",
)
def byte_accounting(spark, sf):
    docs = A.documents(spark, sf, ())
    return docs.groupBy(header("lang").alias("lang")).agg(
        F.sum(M.slots()).alias("slots"), F.max(M.slots()).alias("largest")
    )


@query(
    "ingest_stats",
    """SELECT count(*) FILTER (WHERE n_chars >= 100) AS docs,
  count(*) FILTER (WHERE n_chars >= 100) / 60.0::DOUBLE AS docs_per_second,
  sum(strlen(text)) FILTER (WHERE n_chars >= 100) / 1048576.0::DOUBLE AS text_mb,
  count(*) FILTER (WHERE n_chars < 100) AS skipped FROM documents""",
)
def ingest_stats(spark, sf):
    df = A.table(spark, sf, "documents")
    return M.ingest_stats(df, "text", F.lit(60.0), F.col("n_chars") < 100)
