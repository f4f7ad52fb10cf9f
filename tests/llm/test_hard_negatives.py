import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventflow.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, score string"


def brute(rows, anchors, positives, negatives, low, high, scale=256):
    whole = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((i, [int(x) * scale if abs(x) > 2**60 else math.floor(scale * x) for x in v], label))
    out = []
    last = lambda i: (i is None, i or 0)
    for a, va, la in whole:
        if a is None or not anchors(a):
            continue
        scored = [
            (min(max(sum(x * y for x, y in zip(va, v)), -(2**63)), 2**63 - 1), i, lab)
            for i, v, lab in whole if i != a
        ]
        scored.sort(key=lambda s: (-s[0], last(s[1])))
        for ps, p, _ in [s for s in scored if s[2] == la][:positives]:
            hard = [s for s in scored if s[2] != la and low * ps <= 100 * s[0] <= high * ps][:negatives]
            out += [(a, p, r, n, ps, ns) for r, (ns, n, _) in enumerate(hard, 1)]
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)
    return [tuple(r) for r in hn.mine(df, F.col("vec_id") % 10 == 0, **options).collect()]


def same(got, want):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim)) * 3
    which = rng.integers(0, 8, n)
    vectors = centres[which] + rng.normal(size=(n, dim)) * 0.2
    return [(i, [float(x) for x in v], int(w % 3)) for i, (v, w) in enumerate(zip(vectors, which))]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(hn, "SHARD_BYTES", 1 << 12)
    monkeypatch.setattr(hn, "BLOCK_ROWS", 16)


def test_walk_against_brute_force():
    """One shard and block, in small steps, so that walks end early."""
    rows = clustered(900, 6, 2)
    vectors, ids = np.array([r[1] for r in rows]), np.arange(900)
    pool = {"ids": ids, "has_id": np.ones(900, bool), "labels": np.array([r[2] for r in rows]), "vectors": vectors}
    own = {c: v[:60] for c, v in pool.items()}
    centres = hn.fit_centres(hn.whole(vectors[:60], 256), 8, 1)
    own["cluster"] = (hn.whole(own["vectors"], 256) @ centres.T).argmax(1)
    seen = []
    plain, step, hn.STEP = hn.products, hn.STEP, 32
    try:
        hn.products = lambda a, b, safe: seen.append(len(a) * len(b)) or plain(a, b, safe)
        i, j, s = hn.walk(
            own, np.arange(60), np.full(60, hn.LOW), np.full(60, hn.HIGH), pool, centres, same=True, k=5, scale=256
        )
    finally:
        hn.products, hn.STEP = plain, step
    score = (hn.whole(vectors[:60], 256) @ hn.whole(vectors, 256).T).astype(np.int64)
    for a in range(60):
        want = sorted((-score[a, b], b) for b in ids if b != a and rows[a][2] == rows[b][2])[:5]
        assert sorted((-x, int(b)) for x, b in zip(s[i == a], j[i == a])) == want
    assert sum(seen) < 0.6 * 60 * 900  # certified before the end of the list


@pytest.mark.parametrize("low, high, positives, negatives", [(30, 90, 5, 10), (-50, 120, 2, 3), (0, 100, 30, 400)])
def test_against_brute_force(spark, small, low, high, positives, negatives):
    rows = clustered(300, 5, 3)
    rows += [(400 + i, [0.0] * 5, i % 3) for i in range(4)] + [(410, [0.0] * 5, 1), (420, [-1.0] * 5, 2)]
    rows += [(430, [1.0, 2.0], 0), (None, rows[1][1], 0), (None, rows[2][1], 1), (440, [], 1)]
    rows += [(450, None, 1), (460, [1.0, None, 2.0, 0.0, 0.0], 1), (470, [float("nan")] * 5, 1)]
    rows += [(480, [float("inf")] * 5, 1), (490, [1.0] * 5, None)]
    rows += [rows[10], rows[11], rows[11]] + [(500 + i, rows[3][1], rows[3][2]) for i in range(80)]
    options = dict(low=low, high=high, positives=positives, negatives=negatives)
    same(run(spark, rows, **options), brute(rows, lambda i: i % 10 == 0, **options))


def test_huge_components_are_exact(spark, small):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1e7, 3.0e8, -2.5e7]) + rng.random() for _ in range(4)], i % 2) for i in range(60)]
    rows += [(70, [1e300, 0.0, 0.0, 0.0], 0), (71, [-1.7e308, 1.0, 0.0, 0.0], 1)]
    options = dict(low=30, high=90, positives=5, negatives=10)
    same(run(spark, rows, **options), brute(rows, lambda i: i % 10 == 0, **options))


def test_nothing_to_mine(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 0), (3, [1.0], 1)]) == []  # no anchor
    assert run(spark, [(10, [1.0], 0), (3, [1.0], 1)]) == []  # no positive
    assert run(spark, [(10, None, 0), (20, [1.0], None)]) == []


def test_window():
    for ps in (*range(-250, 251), 2**62 + 77):
        lo, hi = (int(x[0]) for x in hn.window(np.array([ps]), 30, 90))
        assert lo == -((-30 * ps) // 100) and hi == 90 * ps // 100
