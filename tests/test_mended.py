"""Cases in which earlier versions dropped data or changed behaviour silently."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from eventflow.functions.avro import event_file_format
from eventflow.operators import interceptors as I
from eventflow.operators.merge import apply_updates, merge_upsert
from eventflow.plans.flow import Flow
from eventflow.plans.q_storage import _table_stream
from eventflow.schema import EVENT_SCHEMA
from eventflow.sinks import tables
from eventflow.sinks.databases import Template, jdbc_update_or_insert, jdbc_upsert
from eventflow.sinks.files import write_bucketed, write_events
from eventflow.sinks.records import regex_columns
from eventflow.sources.files import list_spool, read_spool, stream_spool
from eventflow.sources.payloads import parse_json_events
from eventflow.streaming import delivery as D
from eventflow.streaming.rolling import write_rolling


def events(spark, *bodies):
    return spark.createDataFrame([({"h": "x", "n": None}, b.encode()) for b in bodies], EVENT_SCHEMA)


def test_a_new_checkpoint_adds_to_an_old_folder(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events(spark, "a", "b").write.parquet(source)
    stream = spark.readStream.schema(EVENT_SCHEMA).parquet(source)
    flow = Flow(stream).to("a", D.batch_writer(out))
    for state in ("one", "two"):
        flow.start(str(tmp_path / state), once=True).awaitTermination()
    assert spark.read.parquet(out).count() == 4
    flow.start(str(tmp_path / "two"), once=True).awaitTermination()  # nothing new
    assert spark.read.parquet(out).count() == 4


def test_rolled_names_survive_a_restart(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for i in range(2):
        events(spark, f"b{i}").write.mode("append").parquet(source)
        stream = spark.readStream.schema(EVENT_SCHEMA).parquet(source)
        write_rolling(stream, out, state, once=True).awaitTermination()
    assert len({p.name.split("-")[0] for p in (tmp_path / "out").iterdir()}) == 1


def test_order_columns_are_written_and_null_orders_count(spark):
    target = spark.createDataFrame([(1, "a", 10)], "id int, v string, ts int")
    updates = spark.createDataFrame([(1, "x", 20), (2, "y", None), (1, "old", None)], "id int, v string, ts int")
    want = {(1, "x", 20), (2, "y", None)}
    assert {tuple(r) for r in merge_upsert(target, updates, ["id"], ["ts"]).collect()} == want
    assert {tuple(r) for r in apply_updates(target, updates, "id", ["ts"]).collect()} == want


@pytest.mark.parametrize("write", ["upsert", "update"])
def test_database_writes_the_order_column(spark, tmp_path, write):
    path = str(tmp_path / "db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE t (id INTEGER PRIMARY KEY, v TEXT, ts INTEGER)")
        db.execute("INSERT INTO t VALUES (1, 'a', 10)")
    updates = spark.createDataFrame([(1, "x", 20), (2, "y", 5)], "id int, v string, ts int").coalesce(1)
    connect = lambda: sqlite3.connect(path)
    if write == "upsert":
        jdbc_upsert(updates, "t", ["id", "v", "ts"], ["id"], ["ts"], connect)
    else:
        jdbc_update_or_insert(updates, "t", ["id", "v", "ts"], "id", ["ts"], connect)
    with sqlite3.connect(path) as db:
        assert set(db.execute("SELECT * FROM t")) == {(1, "x", 20), (2, "y", 5)}


def test_sql_types():
    assert Template.parse("INSERT INTO t VALUES (${a:longvarchar})").parameters == (("a", "LONGVARCHAR"),)
    with pytest.raises(ValueError, match="GEOMETRY"):
        Template.parse("INSERT INTO t VALUES (${a:geometry})")


def test_avro_is_never_replaced(spark, monkeypatch):
    monkeypatch.setattr("eventflow.functions.avro.avro_format", lambda spark: None)
    with pytest.raises(RuntimeError, match="Avro"):
        event_file_format(spark)


def test_avro_event_record(spark, tmp_path):
    path = str(tmp_path / "events")
    df = spark.createDataFrame([({"a": "1", "n": None}, b"x"), (None, None)], EVENT_SCHEMA)
    write_events(df, path, "AVRO_EVENT")
    back = spark.read.format(event_file_format(spark)).load(path)
    assert sorted((r.headers, bytes(r.body)) for r in back.collect() if r.headers) == [({"a": "1"}, b"x")]
    assert back.where("body = cast('' as binary)").count() == 1
    raw = next(p for p in (tmp_path / "events").iterdir() if p.suffix == ".avro").read_bytes()
    assert b'"name":"Event"' in raw and b"null" not in raw[: raw.index(b"avro.codec")]


def test_stream_options(spark, tmp_path):
    with pytest.raises(ValueError, match="oldest"):
        stream_spool(spark, str(tmp_path), order="random")
    with pytest.raises(ValueError, match="archive_dir"):
        stream_spool(spark, str(tmp_path), delete_policy="archive")
    with pytest.raises(ValueError, match="delete_policy"):
        stream_spool(spark, str(tmp_path), delete_policy="never!")


def test_blobs_in_pieces_and_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.bin").write_bytes(b"0123456789")
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    got = read_spool(spark, folder, deserializer="BLOB", max_blob_length=4).collect()
    assert sorted(bytes(r.body) for r in got) == [b"0123", b"4567", b"89"]
    stream = stream_spool(spark, folder, deserializer="BLOB", basename_header="name")
    Flow(stream).to("a", D.batch_writer(out)).start(str(tmp_path / "state"), once=True).awaitTermination()
    (row,) = spark.read.parquet(out).collect()
    assert bytes(row.body) == b"0123456789" and row.headers == {"name": "a.bin"}


def test_ignored_folder_named_like_the_root(spark, tmp_path):
    inner = tmp_path / "in" / "skip" / "in"
    inner.mkdir(parents=True)
    (inner / "a.log").write_text("no\n")
    (tmp_path / "in" / "b.log").write_text("yes\n")
    for root in (str(tmp_path / "in"), (tmp_path / "in").as_uri()):
        got = read_spool(spark, root, ignore="skip", recursive=True).collect()
        assert [bytes(r.body) for r in got] == [b"yes"]
        assert [r["name"] for r in list_spool(spark, root, ignore="skip", recursive=True).collect()] == ["b.log"]


def test_table_streams_read_folders_and_files(spark, tmp_path):
    spark.range(30).repartition(3).write.parquet(str(tmp_path / "t.parquet"))
    spark.range(7).coalesce(1).write.parquet(str(tmp_path / "one"))
    next((tmp_path / "one").glob("*.parquet")).rename(tmp_path / "u.parquet")
    for name, n in (("t", 30), ("u", 7)):
        out = str(tmp_path / f"out-{name}")
        query = _table_stream(spark, str(tmp_path), name).writeStream.format("parquet")
        query.option("checkpointLocation", out + "-state").trigger(availableNow=True).start(out).awaitTermination()
        assert spark.read.parquet(out).count() == n


def test_json_payloads_are_whole(spark):
    good = ['[{"headers":{"a":"1","n":5},"body":"x"}]', ' [] ', '[{"body":"[1]"}]', '[{"headers":{"a":"[x"},"body":"y"}]']
    bad = ['[{"body":"x"}] trailing', '[{"headers":{"a":{"b":1}},"body":"x"}]', '[{"body":"x"}][]', '{"body":"x"}', '[{"body":"x"}', None]
    df = spark.createDataFrame([(p,) for p in good + bad], "payload string")
    out, rejected = parse_json_events(df)
    assert sorted(bytes(r.body).decode() for r in out.collect()) == ["[1]", "x", "y"]
    assert {r.payload for r in rejected.collect()} == set(bad)


def test_full_matches_take_no_line_end(spark):
    assert regex_columns(events(spark, "ab\n", "ab"), "(a)(b)", ["x", "y"]).count() == 1
    step = I.remove_headers(matching="h")
    df = spark.createDataFrame([({"h\n": "1", "h": "2"}, b"")], EVENT_SCHEMA)
    assert list(df.transform(step).first().headers) == ["h\n"]


RECORD = '{"type":"record","name":"r","fields":[{"name":"id","type":"string"},{"name":"n","type":["null","int"],"default":null}]}'


def test_dataset_rejects_missing_and_other_types(spark, tmp_path):
    bodies = ['{"id":"a"}', '{"id":"a","n":1}', '{"idx":5}', '{"id":5}', '{"id":null}', '{"id":{"a":1}}', '{"id":"x\\"y"}']
    df = spark.createDataFrame([({"avro.schema.literal": RECORD}, b.encode()) for b in bodies], EVENT_SCHEMA)
    out = tables.decode_dataset(df, tables.RecordSchema.parse(RECORD), {RECORD: RECORD})
    assert "_json" not in out.columns
    assert sorted(r.row.id for r in out.where("row IS NOT NULL").collect()) == ["a", "a", 'x"y']
    letters = str(tmp_path / "bad")
    write = tables.dataset_writer(str(tmp_path / "good"), lambda: RECORD, {RECORD: RECORD}, failure_policy="save", error_path=letters)
    for _ in range(2):  # the batch runs again
        write(df, 0)
    assert spark.read.parquet(letters).count() == 4


def test_streams_dedupe_within_a_bound(spark, tmp_path):
    events(spark, "a").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(EVENT_SCHEMA).parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="bound"):
        I.dedupe_events(stream)


def test_equal_events_spread_over_a_buckets_files(spark, tmp_path):
    df = events(spark, *["same"] * 400).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_bucketed(df, str(tmp_path / "b"), "%{h}", clock=F.lit(1), files_per_bucket=4)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = list((tmp_path / "b").rglob("part-*"))
    assert len(files) > 1


def test_rotation_between_plan_and_read(tmp_path):
    from eventflow.sources import tail

    log = tmp_path / "a.log"
    log.write_text("one\ntwo\n")
    settings = tail._Settings(tail._options({"g": (tmp_path.as_uri(), r"a\.log")}, None, None, False, False, None, None, 1 << 20, None))

    def lines(known, target):
        out = []
        for part in tail._plan(settings, known, target):
            for batch in tail._read_range(part, False):
                out += [b.decode() for b in batch.column("body").to_pylist()]
        return out

    first = tail._advance(settings, {}, False)
    log.rename(tmp_path / "a.log.1")
    log.write_text("new\n")
    assert lines({}, first) == ["one", "two"]  # from the rotated file
    with (tmp_path / "a.log.1").open("a") as old:
        old.write("late\n")
    second = tail._advance(settings, first, False)
    assert sorted(lines(first, second)) == ["late", "new"]
    assert lines(second, tail._advance(settings, second, False)) == []
    log.write_text("")  # cut before it was read
    third = {**second, str(log): [second[str(log)][0], 400, 0]}
    assert lines(second, third) == []


def test_plugged_in_parts(spark, tmp_path):
    from eventflow.sinks.databases import jdbc_generated
    from eventflow.sinks.records import to_index_documents

    df = events(spark, "7,x", "bad")
    assert {r["index"] for r in to_index_documents(df, "p", index=F.lit("own")).collect()} == {"own"}

    def parse(body, schema):
        parts = F.split(body.cast("string"), ",")
        row = F.struct(F.get(parts, F.lit(1)).alias("id"), F.get(parts, F.lit(0)).try_cast("int").alias("n"))
        return F.when(F.size(parts) == 2, row)

    named = df.withColumn("headers", F.create_map(F.lit("avro.schema.literal"), F.lit(RECORD)))
    out = tables.decode_dataset(named, tables.RecordSchema.parse(RECORD), {RECORD: RECORD}, parser=parse)
    assert [r.row for r in out.orderBy("body").collect()] == [("x", 7), None]
    path = str(tmp_path / "db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE t (b TEXT)")
    jdbc_generated(
        df.coalesce(1), lambda d: ("INSERT INTO t VALUES (?)", d.select(F.col("body").cast("string"))),
        lambda: sqlite3.connect(path),
    )
    with sqlite3.connect(path) as db:
        assert sorted(db.execute("SELECT b FROM t")) == [("7,x",), ("bad",)]
    write_events(df, str(tmp_path / "own"), lambda d: F.upper(F.col("body").cast("string")))
    assert {r.value for r in spark.read.text(str(tmp_path / "own")).collect()} == {"7,X", "BAD"}
