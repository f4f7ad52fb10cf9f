"""Files rolled by size, count and time, and the slices of a global order behind them."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventflow.operators.indexing import slice_bounds, slice_number, with_arrival_index
from eventflow.operators.routing import round_robin, split_balance
from eventflow.schema import EVENT_SCHEMA
from eventflow.sinks.files import event_bytes, with_rolls, write_bucketed

SCHEMA = f"id long, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in EVENT_SCHEMA)}"


def events(spark, n=900, seed=2):
    """A third of all events are equal and in one bucket; some are empty, one is large."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.35
        body = b"same" * 5 if hot else bytes(rng.choices(b"abc", k=rng.choice([0, 1, 30, 200])))
        rows.append((i, {"k": "hot" if hot else rng.choice("xyz"), "timestamp": str(i * 700)}, bytearray(body)))
    rows.append((n, {"k": "x", "timestamp": "1"}, bytearray(b"L" * 5000)))
    rows.append((n + 1, {"k": "x", "timestamp": None}, None))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def expected(rows, roll_size, roll_count, roll_interval):
    seen, out = defaultdict(lambda: [0, 0]), {}
    for r in sorted(rows, key=lambda r: r.id):
        ts = r.headers["timestamp"]
        span = 0 if not roll_interval else "none" if ts is None else int(ts) // (1000 * roll_interval)
        held = seen[r.headers["k"], span]
        parts = ([span] if roll_interval else []) + ([held[0] // roll_size] if roll_size else [])
        parts += [held[1] // roll_count] if roll_count else []
        out[r.id] = "-".join(map(str, parts))
        held[0] += len(r.body or b"") + 1
        held[1] += 1
    return out


@pytest.mark.parametrize("limits", [(500, 0, 0), (0, 7, 0), (300, 9, 60), (1, 0, 0), (10**9, 0, 100)])
def test_rolls_in_order(spark, limits):
    df = events(spark)
    size, count, interval = limits
    out = with_rolls(
        df.withColumn("bucket", F.col("headers")["k"]), event_bytes(df), roll_size=size, roll_count=count,
        roll_interval=interval, order_by=["id"],
    ).collect()
    rows = df.collect()
    want = expected(rows, size, count, interval)
    assert len(out) == len(rows) and {r.id: r.roll for r in out} == want
    files = defaultdict(list)
    for r in sorted(out, key=lambda r: r.id):
        files[r.bucket, r.roll].append(len(r.body or b"") + 1)
    for held in files.values():
        assert not size or sum(held[:-1]) < size
        assert not count or len(held) <= count


def test_one_file_for_each_roll(spark, tmp_path):
    df, path = events(spark), str(tmp_path / "out")
    write_bucketed(df, path, "%{k}", clock=F.lit(1), roll_size=400, order_by=["id"])
    by_roll = {}
    for file in (tmp_path / "out").rglob("part-*"):
        at = file.parent.name, file.parent.parent.name
        assert at not in by_roll
        by_roll[at] = file.read_bytes()
    want = defaultdict(bytes)
    rolls = expected(df.collect(), 400, 0, 0)
    for r in sorted(df.collect(), key=lambda r: r.id):
        want[f"roll={rolls[r.id]}", f"bucket={r.headers['k']}"] += bytes(r.body or b"") + b"\n"
    assert by_roll == want


def test_without_an_order_each_task_rolls(spark, tmp_path):
    df, path = events(spark), tmp_path / "own"
    write_bucketed(df, str(path), "%{k}", clock=F.lit(1), roll_size=2000)
    files = [f.read_bytes() for f in path.rglob("part-*")]
    assert sum(f.count(b"\n") for f in files) == df.count()
    assert all(len(f) <= 2000 + 5001 for f in files)


def test_a_hot_bucket_spreads(spark):
    df = spark.range(4000).select(
        "id", F.create_map(F.lit("k"), F.lit("hot")).alias("headers"), F.lit("same").cast("binary").alias("body")
    )
    named = df.withColumn("bucket", F.concat(F.lit("hot"), F.substring(F.col("id").cast("string"), 1, 0)))
    rolled = with_rolls(named, event_bytes(df), roll_size=100, order_by=["id"])
    plan = rolled._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan  # bodies stay where they are
    bounds = slice_bounds(df, ["id"], 16)
    sizes = [r["count"] for r in df.groupBy(slice_number(df, ["id"], bounds)).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 4000 / 16
    assert rolled.select("roll").distinct().count() == 200


def test_slices_of_any_key(spark):
    rows = [(None, "a"), (1.5, None), (1.5, "a"), (1.5, "b"), (-2.0, "z"), (float("inf"), ""), (float("nan"), "q")] * 9
    df = spark.createDataFrame(rows, "x double, y string")
    bounds = slice_bounds(df, ["x", "y"], 6)
    out = df.withColumn("s", slice_number(df, ["x", "y"], bounds)).orderBy("x", "y").collect()
    assert [r.s for r in out] == sorted(r.s for r in out) and len({r.s for r in out}) > 3
    assert slice_bounds(df.limit(0), ["x"], 6) == []


def test_index_without_a_copy(spark):
    df = events(spark)
    out = with_arrival_index(df, ["id"], "i")
    assert sorted((r.i, r.id) for r in out.collect()) == [(i, i) for i in range(902)]
    for plan in (out, round_robin(df, ["a", "b"], order_by=["id"]), split_balance(df, ["a", "b"], order_by=["id"])):
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        assert "headers" in text and text.count("Scan ExistingRDD") + text.count("LogicalRDD") <= 1
        assert text.count("LogicalRDD") == df._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD")


def test_files_looked_up_by_slice(spark, monkeypatch):
    """An event bisects the files of its own slice only, and files that run over a slice's
    start still hold the right events."""
    from eventflow.sinks import files

    monkeypatch.setattr(files, "SLICE_ROWS", 50)
    df = events(spark)
    named = df.withColumn("bucket", F.col("headers")["k"])
    out = with_rolls(named, event_bytes(df), roll_size=300, roll_count=9, roll_interval=60, order_by=["id"])
    assert {r.id: r.roll for r in out.collect()} == expected(df.collect(), 300, 9, 60)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_in" in plan  # joined by (bucket, span, slice), not by the whole bucket
