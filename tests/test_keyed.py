"""Upserts, packing, shredding and dirty reads against brute force."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventflow.operators import merge as U
from eventflow.operators import packing as K
from eventflow.operators import shred
from eventflow.schema import EVENT_SCHEMA, make_rows
from eventflow.sources.messages import dirty_reads

QUICK = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
maybe = st.one_of(st.none(), st.integers(0, 3))


@QUICK
@given(
    st.lists(st.tuples(st.integers(0, 5), maybe, maybe), min_size=1, max_size=25),
    st.dictionaries(st.integers(0, 7), st.tuples(maybe, maybe), max_size=6),
)
def test_merge_upsert(spark, updates, stored):
    target = spark.createDataFrame([(k, *v) for k, v in stored.items()], "k int, a int, b int")
    rows = spark.createDataFrame([(i, *u) for i, u in enumerate(updates)], "n int, k int, a int, b int")
    want = dict(stored)
    for k, a, b in updates:
        old = want.get(k, (None, None))
        want[k] = (old[0] if a is None else a, old[1] if b is None else b)
    for got in (U.merge_upsert(target, rows, ["k"], ["n"]), U.apply_updates(target, rows, "k", ["n"])):
        assert {r.k: (r.a, r.b) for r in got.collect()} == want


def test_where_fields_guard_an_update(spark):
    target = spark.createDataFrame([(1, "x", 0), (2, "y", 0)], "k int, w string, v int")
    rows = spark.createDataFrame([(0, 1, "x", 5), (1, 2, "x", 5), (2, 3, "x", 5)], "n int, k int, w string, v int")
    acted = U.update_or_insert(target, rows, "k", ["n"], where=["w"])
    assert {r.k: r.action for r in acted.collect()} == {1: "update", 2: "skip", 3: "insert"}
    after = U.apply_updates(target, rows, "k", ["n"], where=["w"])
    assert {r.k: (r.w, r.v) for r in after.collect()} == {1: ("x", 5), 2: ("y", 0), 3: ("x", 5)}


def test_fold_combines_before_the_shuffle(spark):
    rows = spark.range(10).selectExpr("1 as k", "id as n", "id as v")
    plan = U.fold_updates(rows, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_insert_rows_maps_by_name(spark):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("seats int, cinema string")
    df = spark.createDataFrame([("31", "rex", 1), (None, None, 2)], "SEATS string, Cinema string, x int")
    assert [tuple(r) for r in U.insert_rows(df, schema).collect()] == [(31, "rex")]
    assert U.insert_rows(df.select("x"), schema).count() == 0


def pack(sizes, max_count, max_bytes, max_event):
    """One sender, one event at a time."""
    out, batch, count, used = [], 0, 0, 0
    for size in sizes:
        if size > max_event:
            out.append((None, "dropped"))
            continue
        if used + size > max_bytes:
            out.append((batch, "spill"))
            batch, count, used = batch + 1, 0, 0
            continue
        out.append((batch, "main"))
        count, used = count + 1, used + size
        if count == max_count:
            batch, count, used = batch + 1, 0, 0
    return out


@QUICK
@given(
    st.lists(st.tuples(st.integers(0, 2), st.integers(0, 12)), min_size=1, max_size=60),
    st.integers(1, 5),
    st.integers(1, 20),
    st.integers(1, 12),
)
def test_packing(spark, events, max_count, max_bytes, max_event):
    df = spark.createDataFrame(
        [(i, lane, {}, b"x" * size) for i, (lane, size) in enumerate(events)],
        "i int, l int, headers map<string,string>, body binary",
    )
    got = K.pack_batches(
        df, ["i"], max_count=max_count, max_bytes=max_bytes, max_event=max_event, lane=F.col("l")
    ).collect()
    assert len(got) == len(events)
    for lane in (0, 1, 2):
        want = pack([s for la, s in events if la == lane], max_count, max_bytes, max_event)
        rows = sorted((r for r in got if r.l == lane), key=lambda r: r.i)
        assert [(r.batch, r.batch_kind) for r in rows] == want


def test_packing_state_crosses_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(500).select(
            "id", F.create_map().cast("map<string,string>").alias("headers"),
            F.expr("cast(repeat('x', cast(id % 11 as int)) as binary)").alias("body"),
        )
        got = K.pack_batches(df, ["id"], max_count=10, max_bytes=37, max_event=9, lane=F.lit(0)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = pack([i % 11 for i in range(500)], 10, 37, 9)
    assert [(r.batch, r.batch_kind) for r in sorted(got, key=lambda r: r.id)] == want


def test_packing_spreads_a_hot_key(spark):
    df = spark.range(4000).select(
        "id", F.create_map(F.lit("key"), F.lit("same")).alias("headers"), F.lit(b"x").alias("body")
    )
    out = K.pack_batches(df, ["id"], key_from_event=True)
    counts = [r["count"] for r in out.groupBy("lane").count().collect()]
    assert len(counts) == 32 and max(counts) < 400
    assert out.select("partition_key").distinct().collect()[0][0] == "same"


def test_packing_limits(spark):
    df = spark.createDataFrame(make_rows([({}, "x")]), EVENT_SCHEMA)
    for bad in ({"max_count": 501}, {"max_bytes": 5_000_001}, {"max_event": 0}):
        with pytest.raises(ValueError):
            K.pack_batches(df, ["body"], **bad)


def test_retry(spark):
    calls = []

    def send(df):
        calls.append(1)
        return df.withColumn("sent", F.col("id") < len(calls) * 2)

    assert K.retry_failed(spark.range(6), send, attempts=10).count() == 0 and len(calls) == 3
    calls.clear()
    assert K.retry_failed(spark.range(6), send, attempts=2).count() == 2
    calls.clear()
    with pytest.raises(RuntimeError):
        K.retry_failed(spark.range(6), send, attempts=1, rollback=True)


def test_shred_round_trip(spark):
    rows = [
        (1, {"a": "b" * 300, "n" * 400: "v", "null": None}, b"z" * 40_000),
        (2, {}, b""),
        (3, {"k": ""}, b"x" * 16384),
    ]
    df = spark.createDataFrame(rows, "event_id int, headers map<string,string>, body binary")
    tables = shred.shred_events(df)
    sizes = {name: t.count() for name, t in tables.items()}
    assert sizes == {"event": 3, "payload_spill": 1, "header": 4, "name_spill": 1, "value_spill": 1}
    back = shred.assemble_events(tables).orderBy("event_id").collect()
    assert [(r.event_id, r.headers, bytes(r.body)) for r in back] == rows


@QUICK
@given(
    st.lists(st.tuples(st.integers(0, 1), st.integers(0, 9)), min_size=1, max_size=50),
    st.integers(1, 60),
)
def test_dirty_reads(spark, records, width):
    df = spark.createDataFrame(
        [("t", p, o, i) for i, (p, o) in enumerate(records)],
        "topic string, partition int, offset long, arrival long",
    )
    want, last = {}, {}
    for p, o in records:
        seen, dirty = want.get(p, (0, 0))
        want[p] = (seen + 1, dirty + (last.get(p, -1) > 0 and last[p] >= o))
        last[p] = o
    got = dirty_reads(df, "arrival", width).collect()
    assert {r.partition: (r.records, r.dirty_reads) for r in got} == want


def test_small_updates_do_not_shuffle_the_target(spark):
    target = spark.range(5000).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(1).alias("w"))
    updates = spark.createDataFrame([(7, 1, "b", None), (9000, 1, "c", 5), (None, 1, "n", 1)], "k long, n long, v string, w int")
    for merged in (U.merge_upsert(target, updates, ["k"], ["n"]), U.apply_updates(target, updates, "k", ["n"])):
        rows = {r.k: (r.v, r.w) for r in merged.collect()}
        assert len(rows) == 5002 and rows[7] == ("b", 1) and rows[9000] == ("c", 5) and rows[None] == ("n", 1)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        for line in plan.split("== Initial Plan ==")[0].splitlines():
            assert "FullOuter" not in line
        # Only folded updates are exchanged: each hash exchange stands above an aggregate of them.
        assert "SortMergeJoin" not in plan.split("== Initial Plan ==")[0]


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, i % 4, "old", i) for i in range(40)]
    spark.createDataFrame(rows, "k long, p int, v string, w long").write.partitionBy("p").parquet(path)
    before = {f: (f.stat().st_mtime_ns, f.read_bytes()) for f in (tmp_path / "t").rglob("*.parquet")}
    updates = spark.createDataFrame(
        [(5, 2, 1, "lost", None), (5, 3, 9, None, 77), (5, 4, 9, "new", None), (100, 1, 2, "more", 1)],
        "k long, n long, p int, v string, w long",
    )
    assert U.upsert_table(spark, path, updates, ["k"], ["n"], ["p"]) == 2
    after = {f: (f.stat().st_mtime_ns, f.read_bytes()) for f in (tmp_path / "t").rglob("*.parquet")}
    kept = [f for f in before if f.parent.name in ("p=0", "p=3")]
    assert kept and all(after.get(f) == before[f] for f in kept)
    got = {(r.k, r.p, r.v, r.w) for r in spark.read.parquet(path).collect()}
    want = {r for r in rows if r[0] != 5} | {(5, 1, "new", 77), (100, 2, "more", 1)}
    assert got == want
    assert U.upsert_table(spark, path, updates.limit(0), ["k"], ["n"], ["p"]) == 0
    assert U.upsert_table(spark, path, updates.where("k = 100"), ["k"], ["n"], ["p"]) == 1
    assert {(r.k, r.p, r.v, r.w) for r in spark.read.parquet(path).collect()} == want
