"""Partitioned text written and read by tasks: the driver holds no file names."""

from collections import defaultdict
from datetime import datetime, timedelta
from hashlib import md5

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F

from eventflow.sinks import files
from eventflow.sinks.files import write_bucketed, write_events
from eventflow.sinks.staged import can_stage
from eventflow.sources.folders import read_whole_files

ODD = ["", None, "plain", "ä/ö%2F", "..", "_hidden", " ", *(f"x{chr(c)}y" for c in range(1, 128))]


def events(spark, keys, n=3):
    """``n`` events of each key, in order of their ids; one has an empty body."""
    rows = [(i * len(keys) + j, {"k": k}, bytearray(b"" if i == 1 else f"{i}-{j}".encode())) for i in range(n) for j, k in enumerate(keys)]
    return spark.createDataFrame(rows, "id long, headers map<string,string>, body binary").repartition(5)


def tree(folder):
    """Contents of the files of each partition folder."""
    out = defaultdict(list)
    for file in folder.rglob("part-*"):
        out[str(file.parent.relative_to(folder))].append(file.read_bytes())
    return {k: sorted(v) for k, v in out.items()}


def test_folders_and_files_are_those_of_sparks_writer(spark, tmp_path):
    named = events(spark, ODD).withColumn("bucket", F.col("headers")["k"]).withColumn("roll", F.col("id") % 3)
    placed = named.repartition(3, "bucket", "roll").sortWithinPartitions("bucket", "roll", "id")
    by = ["bucket", "roll"]
    write_events(placed, str(tmp_path / "own"), partition_by=by, placed=True)
    # One file for each folder, so that Spark's order of null beside the empty text does not count.
    write_events(named.orderBy("id").coalesce(1), str(tmp_path / "spark"), partition_by=by)
    lines = lambda held: {k: sorted(b"".join(v).splitlines()) for k, v in held.items()}
    assert lines(tree(tmp_path / "own")) == lines(tree(tmp_path / "spark"))
    assert (tmp_path / "own" / "_SUCCESS").exists() and not list((tmp_path / "own").glob("_staged*"))
    first = tree(tmp_path / "own")
    write_events(placed, str(tmp_path / "own"), partition_by=by, placed=True)  # a second write adds
    assert tree(tmp_path / "own") == {k: sorted(2 * v) for k, v in first.items()}


def test_whole_files_are_those_of_sparks_reader(spark, tmp_path):
    named = events(spark, ODD).withColumn("bucket", F.col("headers")["k"]).withColumn("roll", F.col("id") % 3)
    write_events(named, str(tmp_path / "t"), partition_by=["bucket", "roll"])
    [some, other, *_] = [f.parent for f in (tmp_path / "t").rglob("part-*")]
    (some / "part-empty").write_bytes(b"")
    (some / ".hidden").write_bytes(b"no")
    (other / "_hidden").write_bytes(b"no")
    (other / "part-bytes").write_bytes(b"\xff\xfe not text\n")
    want = spark.read.schema("value string, bucket string, roll string").text(str(tmp_path / "t"), wholetext=True)
    got = read_whole_files(spark, str(tmp_path / "t"), ["bucket", "roll"])
    assert got.columns == want.columns and not got.inputFiles()
    cells = lambda df: sorted(map(repr, df.select(F.hex(F.col("value").cast("binary")), "bucket", "roll").collect()))
    assert cells(got) == cells(want) and got.count() > len(ODD)


def test_runs_over_batches_are_one_file(spark, tmp_path):
    df, path = events(spark, ["a", "b"], n=100), tmp_path / "out"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        write_bucketed(df, str(path), "%{k}", clock=F.lit(1), roll_count=40, order_by=["id"])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    held = {k: "".join(f"{'' if i == 1 else f'{i}-{j}'}\n" for i in range(100)) for j, k in enumerate("ab")}
    rows = {k: v.splitlines(True) for k, v in held.items()}
    want = {f"bucket={k}/roll={n}": ["".join(v[40 * n : 40 * n + 40]).encode()] for k, v in rows.items() for n in range(3)}
    assert tree(path) == want


def test_a_failed_write_publishes_nothing(spark, tmp_path):
    df, path = events(spark, ["a", "b", "c"], n=50), tmp_path / "out"
    bad = F.when(F.col("id") == 149, F.raise_error(F.lit("no line"))).otherwise(F.col("body").cast("string"))
    placed = df.withColumn("k", F.col("headers")["k"]).repartition(3, "k").sortWithinPartitions("k", "id")
    with pytest.raises(PySparkException, match="no line"):
        write_events(placed, str(path), lambda d: bad, partition_by=["k"], placed=True)
        spark.read.text(str(path)).collect()
    assert not list(path.rglob("*part-*")) and not list(path.rglob("_*"))


def test_other_forms_stay_with_sparks_writer(spark, tmp_path):
    df, path = events(spark, ["a", "b"], n=20), tmp_path / "out"
    write_bucketed(df, str(path), "%{k}", clock=F.lit(1), roll_count=6, order_by=["id"], compression="gzip")
    assert len(list(path.rglob("part-*.gz"))) == 8
    write_bucketed(df, str(path), "%{k}", clock=F.lit(1), roll_count=6, order_by=["id"], mode="overwrite")
    assert len(list(path.rglob("part-*"))) == 8
    (tmp_path / "far").mkdir()
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./x", (tmp_path / "far").as_uri())
    assert can_stage(spark, str(path)) and not can_stage(spark, "viewfs://store/x")
    write_bucketed(df, "viewfs://store/x/out", "%{k}", clock=F.lit(1), roll_count=6, order_by=["id"])
    assert tree(tmp_path / "far" / "out") == tree(path)


def test_many_files_are_not_broadcast(spark, monkeypatch):
    df = events(spark, ["a", "b"], n=300)
    named = df.withColumn("bucket", F.col("headers")["k"])

    def rolls():
        out = files.with_rolls(named, files.event_bytes(df), roll_count=7, order_by=["id"])
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        return sorted((r.id, r.roll) for r in out.collect()), "BroadcastHashJoin" in plan

    want, broadcast = rolls()
    monkeypatch.setattr(files, "BROADCAST_FILES", 50)
    assert broadcast and rolls() == (want, False) and len(want) == 600


def test_bucketed_by_interval_sends_no_file_names_to_the_driver(spark, tmp_path, monkeypatch):
    """Spark's writer and reader keep each of the folders and files in the driver."""
    import __spark_entry__ as entry

    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=17 * i), i % 7, "ab"[i % 3 == 0], 1.0, f'{{"n": {i % 50}}}') for i in range(1200)]
    kinds = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, kinds).write.parquet(str(tmp_path / "events.parquet"))
    used = []
    for kind, name in ((DataFrameWriter, "partitionBy"), (DataFrameReader, "text")):
        real = getattr(kind, name)
        monkeypatch.setattr(kind, name, lambda self, *a, real=real, name=name, **b: used.append(name) or real(self, *a, **b))
    df = entry.queries()["bucketed_by_interval"](spark, str(tmp_path))
    got = {(r.bucket, r.roll): (r.files, r.events, r.digest) for r in df.collect()}
    seen, want = defaultdict(int), defaultdict(list)
    for i, ts, _, kind, _, props in rows:
        span = int((ts - datetime(1970, 1, 1)).total_seconds()) // (6 * 3600)
        want[kind, f"{span}-{seen[kind, span] // 40}"].append(props)
        seen[kind, span] += 1
    assert got == {k: (1, len(v), md5(";".join(v).encode()).hexdigest()) for k, v in want.items()}
    assert not used and not df.inputFiles()
