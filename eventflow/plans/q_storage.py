"""Queries that write through a sink or stream and read the outcome back.

Outputs go to the shared folder (``spark.checkpoint.dir``).
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.functions.avro import event_file_format, read_avro_records
from eventflow.operators import interceptors as I
from eventflow.operators import routing as R
from eventflow.plans import adapters as A
from eventflow.plans.flow import Flow
from eventflow.plans.q_sinks import V2, WRITERS, dataset_events
from eventflow.plans.registry import MS, query
from eventflow.schema import body_text, header, to_events
from eventflow.session import shared_dir, tune
from eventflow.sinks import files, tables
from eventflow.sources.files import list_spool, read_spool, stream_spool
from eventflow.sources.folders import read_whole_files
from eventflow.sources.spool_stream import stream_spool_files
from eventflow.sources.tail import read_tail
from eventflow.streaming import delivery as D
from eventflow.streaming.rolling import write_rolling

_ALL_LINES = """WITH l AS (SELECT unnest(string_split(text, chr(10))) AS body FROM documents)
SELECT body, count(*) AS n FROM l GROUP BY body"""


def _spool(spark, sf, name):
    """Documents written as plain text files, several documents per file."""
    folder = shared_dir(spark, name)
    files.write_events(A.documents(spark, sf), folder)
    return folder


def _table_stream(spark, sf, name):
    """A given table as a file stream."""
    tune(spark)
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    # The pattern fits a single file as well as a folder of part files.
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


@query("spool_lines", _ALL_LINES)
def spool_lines(spark, sf):
    folder = _spool(spark, sf, "spool")
    events = read_spool(spark, folder, include=r"part-.*[.]txt", max_line_length=50_000)
    return events.groupBy(body_text().alias("body")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "spool_blobs",
    "SELECT CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes, true AS named FROM documents",
)
def spool_blobs(spark, sf):
    folder = _spool(spark, sf, "blobs")
    events = read_spool(
        spark, folder, include=r"part-.*", deserializer="BLOB", file_header="file",
        basename_header="basename",
    )
    named = header("file").endswith(header("basename")) & header("basename").startswith("part-")
    return events.agg(
        F.sum(F.octet_length("body")).alias("bytes"), F.bool_and(named).alias("named")
    )


@query(
    "spool_listing",
    "SELECT CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents",
)
def spool_listing(spark, sf):
    folder = _spool(spark, sf, "listing")
    return list_spool(spark, folder, ignore=r"_.*", recursive=True).agg(
        F.sum("length").alias("bytes")
    )


@query("spool_stream", _ALL_LINES)
def spool_stream(spark, sf):
    folder, out = _spool(spark, sf, "incoming"), shared_dir(spark, "spool-out")
    lines = stream_spool(
        spark, folder, include=r"part-.*", max_line_length=50_000, max_files_per_trigger=2
    )
    flow = Flow(lines).to("store", D.batch_writer(out))
    flow.start(shared_dir(spark, "spool-state"), once=True).awaitTermination()
    return spark.read.parquet(out).groupBy(body_text().alias("body")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "spool_stream_empty_files",
    """WITH l AS (SELECT unnest(string_split(text, chr(10))) AS body FROM documents)
SELECT 'lines' AS kind, body, count(*) AS n FROM l GROUP BY body
UNION ALL SELECT 'empty', coalesce(source, ''), 1 FROM (SELECT DISTINCT source FROM documents)""",
)
def spool_stream_empty_files(spark, sf):
    """Text files and, for each source, one that is empty: oldest first, two at a time."""
    folder, out = _spool(spark, sf, "mixed"), shared_dir(spark, "mixed-out")
    sources = A.table(spark, sf, "documents").select(F.coalesce("source", F.lit("")).alias("s")).distinct()
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for r in sources.collect():  # a name for each source
        at = hadoop(f"{folder}/empty-{r.s}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at).close()
    lines = stream_spool_files(
        spark, folder, shared_dir(spark, "mixed-files"), include=r"part-.*|empty-.*", max_line_length=1 << 20,
        max_files_per_trigger=2, range_bytes=1 << 20, basename_header="file",
    )
    running = Flow(lines).to("store", D.batch_writer(out)).start(shared_dir(spark, "mixed-state"))
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    empty = header("file").startswith("empty-")
    rows = spark.read.parquet(out).select(
        F.when(empty, F.lit("empty")).otherwise(F.lit("lines")).alias("kind"),
        F.when(empty, F.substring(header("file"), 7, 1 << 20)).otherwise(body_text()).alias("body"),
    )
    return rows.groupBy("kind", "body").agg(F.count(F.lit(1)).alias("n"))


@query("tail_lines", _ALL_LINES)
def tail_lines(spark, sf):
    folder = _spool(spark, sf, "tail")
    events = read_tail(
        spark, {"docs": (folder, r"part-.*[.]txt")}, range_bytes=1 << 20, streaming=False
    )
    return events.groupBy(body_text().alias("body")).agg(F.count(F.lit(1)).alias("n"))


@query("tail_stream", _ALL_LINES)
def tail_stream(spark, sf):
    folder, out = _spool(spark, sf, "growing"), shared_dir(spark, "tail-out")
    lines = read_tail(spark, {"docs": (folder, r"part-.*")}, range_bytes=262_144)
    flow = Flow(lines).to("store", D.batch_writer(out))
    running = flow.start(shared_dir(spark, "tail-state"))
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(out).groupBy(body_text().alias("body")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "bucketed_files",
    """SELECT lang || '/' || source AS bucket, count(*) AS events, CAST(sum(strlen(text)) AS BIGINT) AS bytes
FROM documents GROUP BY 1""",
)
def bucketed_files(spark, sf):
    out = shared_dir(spark, "buckets")
    files.write_bucketed(
        A.documents(spark, sf), out, "%{lang}/%{source}", serializer="AVRO_EVENT",
        clock=F.lit(1), roll_count=50, files_per_bucket=2, compression="snappy",
    )
    return spark.read.format(event_file_format(spark)).load(out).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.octet_length("body")).alias("bytes")
    )


ROLL_BYTES, ROLL_EVENTS, ROLL_SECONDS = 65_536, 40, 6 * 3600


@query(
    "bucketed_by_size",
    f"""WITH d AS (SELECT lang, coalesce(strlen(text), 0) + 1 AS size, row_number() OVER w AS n,
    sum(coalesce(strlen(text), 0) + 1) OVER w AS upto FROM documents WINDOW w AS (PARTITION BY lang ORDER BY doc_id)),
r AS (SELECT lang AS bucket, ((upto - size) // {ROLL_BYTES})::BIGINT || '-' || (n - 1) // {ROLL_EVENTS} AS roll, size FROM d)
SELECT bucket, roll, 1::BIGINT AS files, CAST(sum(size) AS BIGINT) AS bytes FROM r GROUP BY bucket, roll""",
)
def bucketed_by_size(spark, sf):
    """Documents by language, each file closed by its bytes or its events."""
    out = shared_dir(spark, "by-size")
    files.write_bucketed(
        A.documents(spark, sf), out, "%{lang}", clock=F.lit(1), roll_size=ROLL_BYTES, roll_count=ROLL_EVENTS,
        order_by=["doc_id"],
    )
    lines = spark.read.schema("value string, bucket string, roll string").option("lineSep", "\n").text(out)
    lines = lines.withColumn("file", F.input_file_name())
    return lines.groupBy("bucket", "roll").agg(
        F.count_distinct("file").alias("files"), F.sum(F.octet_length("value") + 1).alias("bytes")
    )


@query(
    "bucketed_by_interval",
    f"""WITH e AS (SELECT event_type AS bucket, {MS} // {1000 * ROLL_SECONDS} AS span, event_id, props FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY bucket, span ORDER BY event_id) - 1 AS i FROM e)
SELECT bucket, span || '-' || i // {ROLL_EVENTS} AS roll, 1::BIGINT AS files, count(*) AS events,
  md5(string_agg(props, ';' ORDER BY event_id)) AS digest FROM n GROUP BY 1, 2""",
)
def bucketed_by_interval(spark, sf):
    """Events by type, a new file every six hours and after so many events, in order."""
    out = shared_dir(spark, "by-interval")
    files.write_bucketed(
        A.events(spark, sf), out, "%{event_type}", roll_interval=ROLL_SECONDS, roll_count=ROLL_EVENTS,
        order_by=["event_id"],
    )
    lines = read_whole_files(spark, out, ["bucket", "roll"])
    rows = F.split(F.rtrim(F.col("value"), F.lit("\n")), "\n")
    return lines.select(
        "bucket", "roll", F.lit(1).cast("bigint").alias("files"), F.size(rows).cast("bigint").alias("events"),
        F.md5(F.array_join(rows, ";").cast("binary")).alias("digest"),
    )


ORDER_RECORD = """{"type": "record", "name": "order", "fields": [
  {"name": "o_orderkey", "type": "long"}, {"name": "o_orderstatus", "type": ["string", "null"]}]}"""


@query(
    "avro_record_files",
    """SELECT o_orderstatus AS status, count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS keys,
  count(DISTINCT o_orderstatus) AS schemas FROM orders GROUP BY o_orderstatus""",
)
def avro_record_files(spark, sf):
    """Orders as Avro record files, read back as events that name their schema by hash."""
    out = shared_dir(spark, "records")
    fmt = event_file_format(spark)
    A.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").write.format(fmt).save(out)
    events = read_avro_records(spark, out, ORDER_RECORD, codec="json")
    doc = F.from_json(body_text(), "o_orderkey bigint, o_orderstatus string")
    rows = events.select(doc.alias("d"), header("avro.schema.hash").alias("hash"))
    return rows.groupBy(F.col("d.o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("d.o_orderkey").alias("keys"),
        F.count_distinct("hash").alias("schemas"),
    )


@query(
    "bucketed_text_by_time",
    """SELECT strftime(date_trunc('day', ts) + INTERVAL 6 HOUR * (hour(ts) // 6), '%Y%m%d-%H') AS bucket,
  count(*) AS lines, CAST(sum(strlen(props)) AS BIGINT) AS bytes FROM events GROUP BY 1""",
)
def bucketed_text_by_time(spark, sf):
    out = shared_dir(spark, "by-time")
    files.write_bucketed(
        A.events(spark, sf), out, "%Y%m%d-%H", round_unit="hour", round_value=6
    )
    return spark.read.text(out).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length("value")).alias("bytes")
    )


@query(
    "header_text_files",
    f"""SELECT '{{event_id=' || event_id || ', event_type=' || event_type || ', timestamp=' || {MS}
  || ', user_id=' || user_id || '}} ' || props AS line FROM events""",
)
def header_text_files(spark, sf):
    out = shared_dir(spark, "header-text")
    files.write_events(A.events(spark, sf), out, "HEADER_AND_TEXT")
    return spark.read.text(out).select(F.col("value").alias("line"))


@query(
    "partitioned_table",
    """SELECT o_orderstatus AS status, year(o_orderdate)::INT AS year, count(*) AS orders,
  CAST(sum(o_custkey) AS BIGINT) AS customers FROM orders GROUP BY 1, 2""",
)
def partitioned_table(spark, sf):
    out = shared_dir(spark, "table")
    ev = to_events(
        A.table(spark, sf, "orders"),
        {"timestamp": A.epoch_ms("o_orderdate"), "status": F.col("o_orderstatus")},
        F.concat_ws("|", "o_orderkey", "o_orderpriority", "o_custkey"),
    )
    tables.write_partitioned_table(
        ev, "orders_by_day", T.StructType.fromDDL("id bigint, cust bigint"),
        partitions={"status": "%{status}", "year": "%Y"},
        names=["id", "", "cust"], delimiter='"|"', path=out,
    )
    return spark.read.parquet(out).groupBy("status", "year").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("cust").alias("customers")
    )


@query(
    "dataset_with_dead_letters",
    """SELECT CASE WHEN event_id % 4 <= 1 THEN 'stored' ELSE 'dead' END AS outcome,
  CASE event_id % 4 WHEN 0 THEN event_id || '/0/none' WHEN 1 THEN event_id || '/' || user_id || '/' || event_type
    WHEN 2 THEN '{"title":"' || event_type || '"}' ELSE '{broken' END AS value
FROM events""",
)
def dataset_with_dead_letters(spark, sf):
    good, bad = shared_dir(spark, "dataset"), shared_dir(spark, "dead")
    tables.write_dataset(
        dataset_events(spark, sf), good, tables.RecordSchema.parse(V2), WRITERS,
        failure_policy="save", error_path=bad,
    )
    row = F.concat_ws("/", "code", F.col("shopper").cast("string"), "action")
    stored = spark.read.parquet(good).select(F.lit("stored").alias("outcome"), row.alias("value"))
    dead = spark.read.parquet(bad).select(F.lit("dead").alias("outcome"), F.col("body").cast("string").alias("value"))
    return stored.union(dead)


@query("tail_stream_bounded", _ALL_LINES)
def tail_stream_bounded(spark, sf):
    """As tail_stream, in batches of at most an eighth of the bytes; tasks keep the line ends."""
    folder, out = _spool(spark, sf, "bounded"), shared_dir(spark, "bounded-out")
    total = list_spool(spark, folder, include=r"part-.*").agg(F.sum("length")).first()[0] or 8
    lines = read_tail(
        spark, {"docs": (folder, r"part-.*")}, range_bytes=262_144, max_bytes_per_batch=-(-total // 8),
        state_path=shared_dir(spark, "bounded-positions"),
    )
    running = Flow(lines).to("store", D.batch_writer(out)).start(shared_dir(spark, "bounded-state"))
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(out).groupBy(body_text().alias("body")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "stream_routed_delivery",
    """WITH r AS (SELECT event_id, unnest(CASE event_type WHEN 'click' THEN ['web'] WHEN 'purchase'
    THEN ['web', 'audit'] ELSE ['audit'] END) AS channel FROM events WHERE regexp_matches(props, '[1-9]'))
SELECT channel, count(*) AS events, CAST(sum(event_id) AS BIGINT) AS ids FROM r GROUP BY channel""",
)
def stream_routed_delivery(spark, sf):
    """Streaming flow with two required channels and an optional one that always fails."""
    web, audit = shared_dir(spark, "web"), shared_dir(spark, "audit")

    def broken(df, batch_id):
        raise OSError("target is down")

    def selector(df):
        return R.multiplex_columns(
            header("event_type"), {"click": "web", "purchase": "web audit"}, "audit",
            optional={"click": "extra"},
        )

    flow = (
        Flow(A.as_events(_table_stream(spark, sf, "events")))
        .through(I.regex_filter("[1-9]"), I.add_static("dc", "eu"))
        .select_by(selector)
        .to("web", D.batch_writer(web))
        .to("audit", D.batch_writer(audit))
        .to("extra", broken, optional=True)
    )
    flow.start(shared_dir(spark, "routed-state"), once=True).awaitTermination()
    stored = R.union_flows(
        spark.read.parquet(web).withColumn("channel", F.lit("web")),
        spark.read.parquet(audit).withColumn("channel", F.lit("audit")),
    )
    return stored.groupBy("channel").agg(
        F.count(F.lit(1)).alias("events"), F.sum("event_id").alias("ids")
    )


@query(
    "stream_failover",
    "SELECT count(*) AS events, CAST(sum(turn) AS BIGINT) AS turns FROM conversations",
)
def stream_failover(spark, sf):
    backup = shared_dir(spark, "backup")

    def broken(df, batch_id):
        raise OSError("target is down")

    def batch(df, batch_id):
        D.write_failover(
            df, batch_id, {"backup": D.batch_writer(backup), "main": broken}, {"main": 10, "backup": 5}
        )

    source = _table_stream(spark, sf, "conversations")
    source.writeStream.option("checkpointLocation", shared_dir(spark, "failover-state")).foreachBatch(
        batch
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(backup).agg(
        F.count(F.lit(1)).alias("events"), F.sum("turn").alias("turns")
    )


@query(
    "stream_rolling_text",
    "SELECT props AS line, count(*) AS n FROM events GROUP BY props",
)
def stream_rolling_text(spark, sf):
    out = shared_dir(spark, "rolls")
    events = A.as_events(_table_stream(spark, sf, "events"), keep=())
    write_rolling(
        events, out, shared_dir(spark, "rolls-state"), series=1700000000000, prefix="ev-", once=True
    ).awaitTermination()
    return spark.read.text(f"{out}/ev-1700000000000-*").groupBy(F.col("value").alias("line")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "stream_dedupe",
    "SELECT event_type, count(*) AS events FROM events GROUP BY event_type",
)
def stream_dedupe(spark, sf):
    """Every event arrives twice; ids within the watermark delay are kept once."""
    out = shared_dir(spark, "deduped")
    raw = _table_stream(spark, sf, "events").withColumn("at", F.col("ts").cast("timestamp"))
    events = A.as_events(raw, keep=("event_id", "event_type", "at"))
    twice = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    ided = twice.transform(I.add_uuid(content=["event_id"]))
    once = I.dedupe_events(ided, event_time="at", delay="1 day")
    once.writeStream.option("checkpointLocation", shared_dir(spark, "dedupe-state")).foreachBatch(
        D.batch_writer(out)
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
