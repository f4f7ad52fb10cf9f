import json
import os
import time

import pytest
from pyspark.sql import functions as F

from eventflow.functions.avro import avro_codec, avro_format, read_avro_records
from eventflow.sinks import files as W
from eventflow.sources import files as S
from eventflow.sources import tail
from eventflow.schema import EVENT_SCHEMA, make_rows
from eventflow.streaming.delivery import batch_writer
from eventflow.plans.flow import Flow


def put(folder, name, data, age=0):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    if age:
        os.utime(path, (time.time() - age, time.time() - age))
    return path


def bodies(df):
    return sorted(bytes(r.body).decode() for r in df.collect())


@pytest.fixture
def spool(tmp_path):
    put(tmp_path, "a.log", "one\ntwo\n", 30)
    put(tmp_path, "b.log", "three\n\nfour", 20)
    put(tmp_path, "c.tmp", "ignored\n", 10)
    put(tmp_path, "d.log.COMPLETED", "done\n", 5)
    put(tmp_path, ".hidden.log", "hidden\n")
    put(tmp_path, "empty.log", "", 40)
    put(tmp_path, "sub/e.log", "five\n")
    put(tmp_path, ".dot/f.log", "six\n")
    put(tmp_path, "skip/g.log", "seven\n")
    return tmp_path


def test_spool_candidates_and_empty_files(spark, spool):
    got = S.read_spool(spark, str(spool), ignore=r".*\.tmp")
    assert bodies(got) == ["", "", "four", "one", "three", "two"]
    assert bodies(S.read_spool(spark, str(spool), include="a")) == []
    assert bodies(S.read_spool(spark, str(spool), include=r"a\..*")) == ["one", "two"]


def test_spool_recursion_skips_hidden_and_ignored_folders(spark, spool):
    got = S.read_spool(spark, str(spool), ignore=r"skip|.*\.tmp", recursive=True)
    assert "five" in bodies(got) and not {"six", "seven"} & set(bodies(got))


def test_spool_headers_and_blob(spark, spool):
    row = S.read_spool(spark, str(spool), include=r"a\.log", file_header="file", basename_header="basename").first()
    assert row.headers == {"file": str(spool / "a.log"), "basename": "a.log"}
    [row] = S.read_spool(spark, str(spool), include=r"b\.log", deserializer="BLOB", basename_header="b").collect()
    assert (row.headers, bytes(row.body)) == ({"b": "b.log"}, b"three\n\nfour")
    with pytest.raises(ValueError):
        S.read_spool(spark, str(spool), deserializer="OTHER")


def test_spool_long_lines_and_bad_bytes(spark, tmp_path):
    put(tmp_path, "x.log", b"abcdefgh\n\xffok\n")
    got = S.read_spool(spark, str(tmp_path), max_line_length=5, decode_policy="IGNORE")
    assert bodies(got) == ["abcde", "fgh", "ok"]
    with pytest.raises(Exception):
        S.read_spool(spark, str(tmp_path)).collect()


def test_consume_order(spark, spool):
    listing = S.list_spool(spark, str(spool), ignore=r".*\.tmp")
    names = lambda order: [r.name for r in S.consume_order(listing, order).collect()]
    assert names("oldest") == ["empty.log", "a.log", "b.log"]
    assert names("youngest") == ["b.log", "a.log", "empty.log"]
    assert sorted(names("random")) == ["a.log", "b.log", "empty.log"]


def test_changed_file_is_fatal(spark, spool):
    spark.catalog.clearCache()
    before = spark.createDataFrame(S.list_spool(spark, str(spool)).collect())
    S.assert_unchanged(before, S.list_spool(spark, str(spool)))
    put(spool, "a.log", "one\ntwo\nmore\n")
    with pytest.raises(RuntimeError):
        S.assert_unchanged(before, S.list_spool(spark, str(spool)))


def test_spool_stream_resumes_from_its_checkpoint(spark, tmp_path):
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    put(inbox, "1.log", "a\nb\n")
    lines = S.stream_spool(spark, str(inbox), ignore=r".*\.tmp")
    flow = Flow(lines).to("store", batch_writer(out))
    flow.start(state, once=True).awaitTermination()
    put(inbox, "2.log", "c\n")
    put(inbox, "3.tmp", "no\n")
    flow.start(state, once=True).awaitTermination()
    flow.start(state, once=True).awaitTermination()
    assert bodies(spark.read.parquet(out)) == ["a", "b", "c"]


# --- growing files ------------------------------------------------------------


def tail_batch(spark, folder, positions=None, **kw):
    df = tail.read_tail(spark, {"g": (str(folder), "file.*")}, positions=positions, streaming=False, **kw)
    return df.collect()


def test_tail_batch_positions(spark, tmp_path):
    groups = {"g": (str(tmp_path), "file.*")}
    put(tmp_path, "file1", "a\nb\r\nrest")
    put(tmp_path, "other", "x\n")
    got = tail_batch(spark, tmp_path, byte_offset=True, file_header="f", group_headers={"g": {"dc": "eu"}})
    path = str(tmp_path / "file1")
    assert [(bytes(r.body), r.headers) for r in got] == [
        (b"a", {"dc": "eu", "f": path, "byteoffset": "0"}),
        (b"b", {"dc": "eu", "f": path, "byteoffset": "2"}),
    ]
    positions = tail.tail_positions(groups)
    assert json.loads(positions)[0]["pos"] == 5
    with open(path, "a") as handle:
        handle.write(" done\nnext\n")
    again = tail_batch(spark, tmp_path, positions)
    assert [bytes(r.body) for r in again] == [b"rest done", b"next"]


def test_tail_truncated_renamed_and_skipped(spark, tmp_path):
    groups = {"g": (str(tmp_path), "file.*")}
    path = put(tmp_path, "file1", "aaa\nbbb\n")
    positions = tail.tail_positions(groups)
    with open(path, "r+") as handle:
        handle.truncate(0)
        handle.write("z\n")
    assert [bytes(r.body) for r in tail_batch(spark, tmp_path, positions)] == [b"z"]
    positions = tail.tail_positions(groups)
    os.rename(path, tmp_path / "file2")
    assert [bytes(r.body) for r in tail_batch(spark, tmp_path, positions)] == [b"z"]
    assert tail_batch(spark, tmp_path, positions, skip_to_end=True) == []


def test_tail_idle_line_is_released(spark, tmp_path):
    put(tmp_path, "file1", "a\npartial", age=300)
    assert [bytes(r.body) for r in tail_batch(spark, tmp_path)] == [b"a"]
    assert [bytes(r.body) for r in tail_batch(spark, tmp_path, idle_seconds=120)] == [b"a", b"partial"]


@pytest.mark.parametrize("range_bytes", [1, 2, 3, 7, 64, 100_000])
def test_tail_ranges_cover_every_line_once(spark, tmp_path, range_bytes):
    text = "".join(f"{'x' * (i % 9)}{i}\n" for i in range(60)) + "\n\ntail"
    put(tmp_path, "file1", text)
    got = tail_batch(spark, tmp_path, range_bytes=range_bytes, byte_offset=True)
    ordered = sorted(got, key=lambda r: int(r.headers["byteoffset"]))
    assert [bytes(r.body).decode() for r in ordered] == text.split("\n")[:-1]


def test_tail_bad_positions():
    with pytest.raises(ValueError):
        tail.parse_positions('[{"inode": 1, "pos": 2}]')


def test_tail_stream_follows_growth_and_restarts(spark, tmp_path):
    logs, out, state = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "state")
    path = put(logs, "file1", "a\nb\nhal")
    lines = tail.read_tail(spark, {"g": (str(logs), "file.*")}, state_path=f"file://{tmp_path}/pos.json")
    flow = Flow(lines).to("store", batch_writer(out))

    def run():
        query = flow.start(state)
        query.processAllAvailable()
        query.stop()

    run()
    assert bodies(spark.read.parquet(out)) == ["a", "b"]
    with open(path, "a") as handle:
        handle.write("f\nc\n")
    put(logs, "file2", "new\n")
    run()
    run()
    assert bodies(spark.read.parquet(out)) == ["a", "b", "c", "half", "new"]


# --- writers ------------------------------------------------------------------


def test_text_writers(spark, tmp_path):
    df = spark.createDataFrame(make_rows([({"k": "v"}, "x"), ({}, "")]), EVENT_SCHEMA)
    W.write_events(df, f"{tmp_path}/t")
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/t").collect()) == ["", "x"]
    W.write_events(df, f"{tmp_path}/h", "HEADER_AND_TEXT")
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/h").collect()) == ["{k=v} x", "{} "]
    own = spark.createDataFrame(make_rows([({}, "x\n")]), EVENT_SCHEMA)
    W.write_events(own, f"{tmp_path}/n", append_newline=False)
    assert [r.value for r in spark.read.text(f"{tmp_path}/n").collect()] == ["x"]
    with pytest.raises(ValueError):
        W.write_events(df, f"{tmp_path}/z", "XML")


def test_bucketed_writer(spark, tmp_path):
    df = spark.range(100).select(
        F.create_map(F.lit("timestamp"), (F.col("id") * 3_600_000 + 1).cast("string"), F.lit("t"), F.lit("a/b")).alias("headers"),
        F.col("id").cast("string").cast("binary").alias("body"),
    )
    out = f"{tmp_path}/out"
    W.write_bucketed(df, out, "%{t}/%Y%m%d", roll_count=5, compression="gzip")
    back = spark.read.text(out)
    assert back.count() == 100
    assert {r.bucket for r in back.select("bucket").distinct().collect()} == {
        f"a/b/197001{d:02d}" for d in range(1, 6)
    }
    sizes = back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert sizes <= 5


def test_avro_events_and_records(spark, tmp_path):
    fmt = avro_format(spark)
    if fmt is None:
        pytest.skip("no Avro support in this session")
    df = spark.createDataFrame(make_rows([({"k": "v"}, "x")]), EVENT_SCHEMA)
    W.write_events(df, f"{tmp_path}/a", "AVRO_EVENT", compression="deflate")
    row = spark.read.format(fmt).load(f"{tmp_path}/a").first()
    assert (row.headers, bytes(row.body)) == ({"k": "v"}, b"x")
    schema = '{"type":"record","name":"r","fields":[{"name":"id","type":"long"}]}'
    spark.range(2).write.format(fmt).save(f"{tmp_path}/r")
    got = read_avro_records(spark, f"{tmp_path}/r", schema, schema_type="LITERAL", codec="json").collect()
    assert {json.loads(bytes(r.body))["id"] for r in got} == {0, 1}
    assert json.loads(got[0].headers["avro.schema.literal"])["name"] == "r"
    if not avro_codec(spark):
        with pytest.raises(RuntimeError):
            read_avro_records(spark, f"{tmp_path}/r", schema)


def test_log_and_null(spark):
    df = spark.createDataFrame(make_rows([({}, "x")]), EVENT_SCHEMA)
    assert W.log_events(df).first()[0].startswith("{ headers:{} body: 78 ")
    W.write_null(df)


def test_file_names_with_blanks(spark, tmp_path):
    put(tmp_path, "a b%20c.log", "x\n")
    put(tmp_path, "e m.log", "")
    got = S.read_spool(spark, str(tmp_path), include=r"(a b%20c|e m)\.log", file_header="f", basename_header="n")
    assert sorted((r.headers["f"], r.headers["n"], bytes(r.body)) for r in got.collect()) == [
        (str(tmp_path / "a b%20c.log"), "a b%20c.log", b"x"),
        (str(tmp_path / "e m.log"), "e m.log", b""),
    ]


def test_spool_charset_in_and_out(spark, tmp_path):
    put(tmp_path, "x.log", "grün\n".encode("latin-1"))
    row = S.read_spool(spark, str(tmp_path), charset="ISO-8859-1").first()
    assert bytes(row.body) == "grün".encode()
    row = S.read_spool(spark, str(tmp_path), charset="ISO-8859-1", output_charset="ISO-8859-1").first()
    assert bytes(row.body) == "grün".encode("latin-1")
