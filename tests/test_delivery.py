import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from eventflow.operators import interceptors as I
from eventflow.operators import metrics as M
from eventflow.operators import routing as R
from eventflow.operators import triage as T
from eventflow.plans.flow import Flow
from eventflow.schema import EVENT_SCHEMA, from_events, header, make_rows, to_events
from eventflow.sinks import records, tables
from eventflow.streaming import delivery as D
from eventflow.streaming.rolling import roll_name, write_rolling


def broken(df, batch_id):
    raise OSError("down")


def sample(spark, n=6):
    return spark.createDataFrame(make_rows([({"t": "ab"[i % 2], "i": str(i)}, f"b{i}") for i in range(n)]), EVENT_SCHEMA)


def test_flow_batch(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    flow = (
        Flow(sample(spark))
        .through(I.add_static("dc", "eu"), I.regex_filter("b[0-4]"))
        .select_by(lambda df: R.multiplex_columns(header("t"), {"a": "a", "b": "a b"}))
        .to("a", D.batch_writer(a))
        .to("b", D.batch_writer(b))
    )
    assert flow.run(1) == {"a": "committed", "b": "committed"}
    flow.run(1)  # the same batch again replaces its output
    assert spark.read.parquet(a).count() == 5 and spark.read.parquet(b).count() == 2
    flow.run()  # another run adds
    assert spark.read.parquet(a).count() == 10 and spark.read.parquet(b).count() == 4


def test_required_failure_fails_the_batch_but_earlier_channels_keep_it(spark, tmp_path):
    a = str(tmp_path / "a")
    routed = R.replicate(sample(spark), ["a", "b"])
    with pytest.raises(OSError):
        D.deliver(routed, 0, {"a": D.batch_writer(a), "b": broken})
    assert spark.read.parquet(a).count() == 6


def test_optional_failure_is_ignored(spark, tmp_path):
    routed = R.replicate(sample(spark), ["a", "b"], optional=["b"])
    got = D.deliver(routed, 0, {"a": D.batch_writer(str(tmp_path / "a"))}, {"b": broken})
    assert got == {"a": "committed", "b": "failed"}


def test_priority_order():
    sinks = {n: n for n in ("x", "y", "z", "w", "v")}
    order = [n for n, _ in D.by_priority(sinks, {"x": 5, "y": 10, "w": 5})]
    assert order == ["y", "x", "z", "v"]


def test_failover(spark, tmp_path):
    ok = D.batch_writer(str(tmp_path / "ok"))
    assert D.write_failover(sample(spark), 0, {"bad": broken, "ok": ok}, {"bad": 9, "ok": 1}) == "ok"
    with pytest.raises(RuntimeError):
        D.write_failover(sample(spark), 0, {"bad": broken})


def test_balance(spark):
    seen = []
    sinks = {n: (lambda name: lambda df, b: seen.append(name))(n) for n in "abc"}
    assert [D.write_balanced(None, i, sinks) for i in range(4)] == ["a", "b", "c", "a"]
    assert D.write_balanced(None, 1, {**sinks, "b": broken}) == "c"
    assert D.write_balanced(None, 7, sinks, "random") == D.write_balanced(None, 7, sinks, "random")
    assert D.write_balanced(None, 0, sinks, order=lambda b, names: names[::-1]) == "c"
    with pytest.raises(RuntimeError):
        D.write_balanced(None, 0, {"a": broken, "b": broken})
    with pytest.raises(ValueError):
        D.write_balanced(None, 0, {"a": broken})


def test_roll_names():
    assert roll_name(2, prefix="p-", extension="txt", series=17) == "p-17-2.txt"
    assert roll_name(1, at=0) == "19700101000000-1"


def test_rolling_stream(spark, tmp_path):
    src = str(tmp_path / "src")
    sample(spark).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(EVENT_SCHEMA).parquet(src)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        write_rolling(stream, out, state, series=5, once=True).awaitTermination()
        sample(spark, 2).coalesce(1).write.mode("append").parquet(src)
    import os

    assert sorted(os.listdir(out)) == ["5-1", "5-2"]
    assert spark.read.text(f"{out}/5-2").count() == 2


def test_poisoned_batch_is_rolled_back(spark):
    text = F.col("body").cast("string")
    df = sample(spark)
    kept = []
    triaged = T.split_poison(df, F.when(text != "b1", text), text != "b2")
    with pytest.raises(RuntimeError):
        T.commit_or_raise(triaged, lambda ok: kept.append(ok.count()))
    fine = T.split_poison(df, F.when(text != "b1", text), F.lit(True))
    assert T.commit_or_raise(fine, lambda ok: kept.append(ok.count())) == {"ok": 5, "dropped": 1}
    assert kept == [5]


V2 = ('{"type":"record","name":"rec","fields":[{"name":"id","type":"string"},'
      '{"name":"msg","type":["string","null"],"default":"default"}]}')
V1 = '{"type":"record","name":"rec","fields":[{"name":"id","type":"string"}]}'
V3 = V1.replace('}]}', '},{"name":"extra","type":"int"}]}')
USER = '{"type":"record","name":"user","fields":[{"name":"username","type":"string"}]}'


def test_dataset_policies(spark, tmp_path):
    lit = tables.LITERAL_HEADER
    good = [({lit: V1}, '{"id":"1"}'), ({lit: V2}, '{"id":"2","msg":null}'), ({lit: V3}, '{"id":"3","extra":1}')]
    bad = [({lit: USER}, '{"username":"u"}'), ({lit: V1}, "{oops"), ({}, '{"id":"4"}')]
    table = tables.RecordSchema.parse(V2)
    writers = {s: s for s in (V1, V2, V3, USER)}
    df = spark.createDataFrame(make_rows(good + bad), EVENT_SCHEMA)
    out, dead = str(tmp_path / "out"), str(tmp_path / "dead")
    with pytest.raises(RuntimeError):
        tables.write_dataset(df, out, table, writers)
    tables.write_dataset(df, out, table, writers, failure_policy="save", error_path=dead, fmt="avro")
    from eventflow.functions.avro import event_file_format

    stored = spark.read.format(event_file_format(spark)).load(out)
    assert sorted(map(tuple, stored.select("id", "msg").collect()), key=str) == [
        ("1", "default"), ("2", None), ("3", "default")
    ]
    assert spark.read.parquet(dead).schema.names == ["headers", "body"]
    assert spark.read.parquet(dead).count() == 3
    seen = []
    tables.write_dataset(df, out, table, writers, failure_policy=lambda b: seen.append(b.count()))
    assert seen == [3]


def test_partitioned_table(spark):
    from pyspark.sql import types as PT

    ev = spark.createDataFrame(
        make_rows([({"continent": "Asia", "country": "India", "timestamp": "0"}, "1,hello")]), EVENT_SCHEMA
    )
    schema = PT.StructType.fromDDL("id int, msg string")
    tables.write_partitioned_table(
        ev, "alerts", schema, partitions={"continent": "%{continent}", "country": "%{country}"}
    )
    tables.write_partitioned_table(ev, "alerts2", schema)
    assert tuple(spark.table("alerts").first()) == (1, "hello", "Asia", "India")
    assert tuple(spark.table("alerts2").first()) == (1, "hello")


def test_topic_records(spark):
    rows = [({"topic": "mine", "key": "k", "p": "4"}, "x"), ({"n": "5"}, "y")]
    df = spark.createDataFrame(make_rows(rows), EVENT_SCHEMA)
    got = records.to_topic_records(df, "t-%{n}", partition_header="p", default_partition=1).collect()
    assert [(r.topic, r.key, r.partition) for r in got] == [("mine", "k", 4), ("t-5", None, 1)]
    raw = records.to_topic_records(df, "t-%{n}", allow_override=False).collect()
    assert {r.topic for r in raw} == {"t-%{n}"}
    bad = spark.createDataFrame(make_rows([({"p": "x"}, "")]), EVENT_SCHEMA)
    with pytest.raises(Exception):
        records.to_topic_records(bad, "t", partition_header="p").collect()


def test_status_rules(spark):
    df = spark.createDataFrame([(c,) for c in (200, 201, 404, 500)], "code int")
    rule = records.classify_status(F.col("code"), backoff={"2XX": False, "201": True}, count={"200": True})
    got = [tuple(r[0]) for r in df.select(rule).collect()]
    assert got == [(False, True, True), (True, True, False), (True, True, False), (True, True, False)]


def test_observed_counts(spark):
    obs = Observation("in")
    df = M.observed(sample(spark), obs, accepted=header("t") == "a")
    df.collect()
    assert obs.get == {"received": 6, "accepted": 3, "bytes": 12}


def test_stream_progress(spark, tmp_path):
    src = str(tmp_path / "src")
    sample(spark).write.parquet(src)
    listener = M.FlowProgress()
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema(EVENT_SCHEMA).parquet(src)
        flow = Flow(stream).to("a", D.batch_writer(str(tmp_path / "a")))
        flow.start(str(tmp_path / "s"), once=True, name="counted").awaitTermination()
        import time

        for _ in range(100):
            if listener.counters.get("counted", {}).get("events"):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.counters["counted"]["events"] == 6


def test_batch_classes_know_empty_batches(spark):
    df = spark.createDataFrame([(0,), (0,), (1,)], "b int")
    got = M.batch_classes(df, "b", 2, spark.range(3).selectExpr("cast(id as int) b")).collect()
    assert {r.batch_class: (r.batches, r.events) for r in got} == {
        "complete": (1, 2), "underflow": (1, 1), "empty": (1, 0)
    }


def test_events_round_trip(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    kept = to_events(df, {"a": F.col("a"), "b": F.col("b")}, F.col("c"))
    assert kept.first().headers == {"a": "1", "b": None}
    dropped = to_events(df, {"a": F.col("a"), "b": F.col("b")}, None, drop_null=True)
    assert (dropped.first().headers, bytes(dropped.first().body)) == ({"a": "1"}, b"")
    assert tuple(from_events(kept, {"a": "int"}, "text").first()) == (1, "x")


def test_dataset_schema_is_read_for_every_batch(spark, tmp_path):
    lit = tables.LITERAL_HEADER
    df = spark.createDataFrame(make_rows([({lit: V1}, '{"id":"1"}')]), EVENT_SCHEMA)
    schemas = [V1, V2]
    write = tables.dataset_writer(str(tmp_path / "d"), lambda: schemas.pop(0), {V1: V1})
    write(df, 0)
    write(df, 1)
    back = spark.read.option("mergeSchema", "true").parquet(str(tmp_path / "d"))
    assert {(r.batch_id, r.msg) for r in back.collect()} == {(0, None), (1, "default")}


def test_process_each(spark, tmp_path):
    log = str(tmp_path / "log")

    def note(handle, row):
        if row.headers["i"] == "3":
            raise ValueError("bad event")
        handle.write(row.headers["i"] + "\n")

    def opened():
        return open(log, "a")

    df = sample(spark).coalesce(1)
    D.process_each(df.filter(header("i") != "3"), opened, note, lambda h: h.close())
    assert open(log).read().split() == ["0", "1", "2", "4", "5"]
    with pytest.raises(Exception, match="1 events failed"):
        D.process_each(df, opened, note, lambda h: h.close())


def test_custom_body_parser(spark):
    df = spark.createDataFrame(make_rows([({}, "a,b"), ({}, "")]), EVENT_SCHEMA)

    def words(body):
        return F.when(F.octet_length(body) > 0, F.split(body.cast("string"), ","))

    assert [r.row for r in T.typed_rows(df, words).collect()] == ["a", "b"]
    assert T.undecodable(df, words).count() == 1


def test_typed_rows_by_a_table_function(spark):
    def parse(body):
        if body == b"bad":
            raise ValueError("no records")
        return [(w.decode(), len(w)) for w in body.split(b" ") if w]

    rows = [("a", b"x yy"), ("b", b""), ("c", b"bad"), ("d", None), ("e", b"x yy"), ("e", b"x yy")]
    df = spark.createDataFrame(rows, "k string, body binary").repartition(3)
    out = T.typed_rows_by(df, parse, "word string, size int")
    assert out.columns == ["k", "body", "word", "size"]
    assert sorted((r.k, r.word, r.size) for r in out.collect()) == [
        ("a", "x", 1), ("a", "yy", 2), ("e", "x", 1), ("e", "x", 1), ("e", "yy", 2), ("e", "yy", 2)
    ]
    first = T.typed_rows_by(df, parse, "word string, size int", first_only=True)
    assert sorted((r.k, r.word) for r in first.collect()) == [("a", "x"), ("e", "x"), ("e", "x")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPythonUDTF" in plan and "hashpartitioning" not in plan
    assert T.typed_rows_by(df.limit(0), parse, "word string, size int").count() == 0
    with pytest.raises(Exception, match="binary"):
        T.typed_rows_by(df.withColumn("body", F.lit("x")), parse, "word string, size int").collect()
