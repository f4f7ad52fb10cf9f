import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventflow.llm import forest
from eventflow.llm.forest import descend_and_ascend, nearest

SF = "/root/testdata/sf0.01"


def brute(rows, asks, k):
    good = {
        (i, tuple(v)) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    out = {}
    for i, v in good:
        if asks(i):
            near = sorted((-float(np.dot(np.float64(v), np.float64(w))), j) for j, w in good if j != i and len(w) == len(v))
            out[i] = near[:k]
    return out


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    return {q: [v[i] for i in sorted(v)] for q, v in out.items()}


def test_recall(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = answers(nearest(df, F.col("vec_id") % 20 == 0, k=20))
    want = brute(rows, lambda i: i % 20 == 0, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    by_id = dict(rows)
    for q, near in got.items():
        assert [(-s, i) for i, s in near] == sorted((-s, i) for i, s in near)
        for i, s in near:
            assert abs(s - np.dot(np.float64(by_id[q]), np.float64(by_id[i]))) < 1e-9


def hard_rows():
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(40)]
    rows += [(100 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(60)]  # a hot vector
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (204, [float("nan")] * 6)]
    rows += [(205, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (None, [1.0] * 6), (206, [1.0, 2.0]), (207, [2.0, 1.0])]
    return rows + [(300, [5.0] * 6), (300, [5.0] * 6), (300, [4.0] * 6), (301, [9e3] * 6)]


@pytest.mark.parametrize("shard_rows", [8192, 5])
def test_small_tables_are_whole(spark, shard_rows):
    """Few rows are all candidates, so results are exact: ties, copies, bad vectors."""
    rows = hard_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, h string, q int").repartition(4)
    got = answers(nearest(df, F.col("vec_id") % 2 == 0, k=30, recall=2.0, shard_rows=shard_rows))
    want = brute(rows, lambda i: i % 2 == 0, 30)
    assert got.keys() == want.keys()
    for q in want:
        if q != 300:  # two vectors share this id
            assert [i for i, _ in got[q]] == [j for _, j in want[q]], q


def test_exact_way_for_short_queries(spark, monkeypatch):
    fit = forest.fit

    def narrow(*args, **options):
        f = fit(*args, **options)
        f.fraction, f.floor = 1.0, 9  # buckets too small for the goal
        return f

    monkeypatch.setattr(forest, "fit", narrow)
    rows = [r for r in hard_rows() if r[0] != 300]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(nearest(df, F.col("vec_id") % 2 == 0, k=10, trees=2))
    want = brute(rows, lambda i: i % 2 == 0, 10)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [j for _, j in v] for q, v in want.items()}


def test_ascent_equals_scan():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 1 << 48, 300))
    keys[50:90] = keys[50]
    keys.sort()
    scores, mid = rng.normal(size=300).round(1), rng.permutation(300)
    for asked in [*keys[::60], *rng.integers(0, 1 << 48, 5)]:
        counts, at, level = descend_and_ascend(keys, int(asked), scores, mid, 2, 7)
        own = forest.common_bits(keys, np.int64(asked))
        for x in range(2, 49):
            assert counts[x] == (own >= x).sum()
            inside = np.flatnonzero(own >= x)
            best = sorted(inside, key=lambda i: (-scores[i], mid[i]))[:7]
            assert set(best) <= set(at[level >= x])


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest(df, F.lit(True)).count() == 0


def test_exact_way_for_queries_just_short_of_the_goal(spark, monkeypatch):
    fit = forest.fit

    def wide(*args, **options):
        f = fit(*args, **options)
        f.fraction, f.floor = 1.5, 1  # two trees meet about half of the rows each
        return f

    monkeypatch.setattr(forest, "fit", wide)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(nearest(df, F.col("vec_id") % 4 == 0, k=100, trees=2))
    want = brute(rows, lambda i: i % 4 == 0, 100)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [j for _, j in v] for q, v in want.items()}
