"""Queries over channel selection and fan-in."""

from pyspark.sql import functions as F

from eventflow.operators import routing as R
from eventflow.plans import adapters as A
from eventflow.plans.registry import query
from eventflow.schema import to_events

CHANNELS = ["ch1", "ch2", "ch3"]


@query(
    "multiplex_events",
    """WITH r AS (SELECT event_id,
    CASE event_type WHEN 'click' THEN ['ch1', 'ch2'] WHEN 'view' THEN ['ch2', 'ch3']
      WHEN 'error' THEN ['ch1', 'ch2', 'ch3'] ELSE ['ch1', 'ch3'] END AS req,
    CASE event_type WHEN 'click' THEN ['ch3'] WHEN 'signup' THEN ['ch2'] ELSE [] END AS opt FROM events)
SELECT event_id, unnest(req) AS channel, true AS required FROM r
UNION ALL SELECT event_id, unnest(opt), false FROM r""",
)
def multiplex_events(spark, sf):
    routed = R.multiplex(
        A.events(spark, sf),
        "event_type",
        {"click": "ch1 ch2", "view": "ch2 ch3", "error": "ch1 ch2 ch3"},
        default="ch1 ch3",
        optional={"click": "ch2 ch3", "error": "ch1 ch3", "signup": "ch1 ch2"},
        channels=CHANNELS,
    )
    return routed.select("event_id", "channel", "required")


@query(
    "multiplex_missing_header",
    """SELECT channel, count(*) AS events FROM (SELECT CASE WHEN l.quality IS NULL THEN 'unlabelled'
    WHEN l.quality = 1 THEN 'good' ELSE 'rest' END AS channel
  FROM documents d LEFT JOIN labels l USING (doc_id)) GROUP BY channel""",
)
def multiplex_missing_header(spark, sf):
    docs = A.table(spark, sf, "documents").join(A.table(spark, sf, "labels"), "doc_id", "left")
    ev = to_events(
        docs, {"quality": F.coalesce(F.col("quality").cast("string"), F.lit(" "))}, F.col("text")
    )
    routed = R.multiplex(ev, "quality", {"1": "good", "0": "rest", " ": "never"}, "unlabelled")
    return routed.groupBy("channel").agg(F.count(F.lit(1)).alias("events"))


@query(
    "replicate_events",
    """SELECT event_id, c.channel, c.channel <> 'archive' AS required FROM events,
  (VALUES ('hot'), ('cold'), ('archive')) c(channel)""",
)
def replicate_events(spark, sf):
    out = R.replicate(A.events(spark, sf), ["hot", "cold", "archive"], optional=["archive"])
    return out.select("event_id", "channel", "required")


@query(
    "round_robin_events",
    """WITH n AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS i FROM events)
SELECT event_id, ['a', 'b', 'c'][(i % 3)::INT + 1] AS channel, true AS required FROM n
UNION ALL SELECT event_id, ['x', 'y'][(i % 2)::INT + 1], false FROM n""",
)
def round_robin_events(spark, sf):
    ev = A.events(spark, sf, ("event_id", "ts"))
    out = R.round_robin(ev, ["a", "b", "c", "x", "y"], optional=["x", "y"], order_by=["ts", "event_id"])
    return out.select("event_id", "channel", "required")


@query(
    "round_robin_per_task",
    "SELECT event_id, 1::BIGINT AS copies FROM events",
)
def round_robin_per_task(spark, sf):
    out = R.round_robin(A.events(spark, sf), ["a", "b", "c"])
    return out.groupBy("event_id").agg(F.count("channel").alias("copies"))


@query(
    "union_flows",
    """SELECT 'documents' AS origin, count(*) AS events, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents
UNION ALL SELECT 'pages', count(*), CAST(sum(strlen(html)) AS BIGINT) FROM pages
UNION ALL SELECT 'conversations', count(*), CAST(sum(strlen(text)) AS BIGINT) FROM conversations""",
)
def union_flows(spark, sf):
    flows = [
        make(spark, sf, keep=()).withColumn("origin", F.lit(name))
        for name, make in (
            ("documents", A.documents),
            ("pages", A.pages),
            ("conversations", A.conversations),
        )
    ]
    return (
        R.union_flows(*flows)
        .groupBy("origin")
        .agg(F.count(F.lit(1)).alias("events"), F.sum(F.octet_length("body")).alias("bytes"))
    )


@query(
    "split_balance",
    """WITH n AS (SELECT (row_number() OVER (ORDER BY event_id) - 1) // 64 AS batch FROM events)
SELECT batch, ['s1', 's2', 's3'][(batch % 3)::INT + 1] AS sink, count(*) AS events FROM n GROUP BY batch""",
)
def split_balance(spark, sf):
    out = R.split_balance(
        A.events(spark, sf), ["s1", "s2", "s3"], batch_size=64, order_by=["event_id"]
    )
    return out.groupBy("batch", "sink").agg(F.count(F.lit(1)).alias("events"))


@query(
    "split_balance_random",
    "WITH n AS (SELECT (row_number() OVER (ORDER BY event_id) - 1) // 64 AS batch FROM events) "
    "SELECT DISTINCT batch, 1::BIGINT AS sinks FROM n",
)
def split_balance_random(spark, sf):
    out = R.split_balance(
        A.events(spark, sf), ["s1", "s2"], mode="random", batch_size=64, order_by=["event_id"], seed=3
    )
    return out.groupBy("batch").agg(F.count_distinct("sink").alias("sinks"))


@query(
    "to_partition",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN (o_custkey % 12)::INT ELSE 3 END AS partition "
    "FROM orders",
)
def to_partition(spark, sf):
    orders = A.table(spark, sf, "orders")
    given = F.when(F.col("o_orderstatus") == "F", F.pmod("o_custkey", F.lit(12)))
    ev = to_events(orders, {"part": given}, F.col("o_orderstatus"), keep=("o_orderkey",), drop_null=True)
    return R.to_partition(ev, "part", static=3).select("o_orderkey", "partition")
