import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventflow.llm.resampling import WordRuns, exact_ranks, resample
from tests.llm.brute import lower_ascii

SCHEMA = "doc_id long, text string, score string, rank string, id string"


def features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def brute(docs, target, percent, buckets, longest, min_words, seed):
    def counts(texts):
        out = [0] * buckets
        for t in texts:
            for f in features(t, longest)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = counts(x for _, x in docs), counts(target)
    gain = [
        math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets))))
        for a, b in zip(s, t)
    ]
    rows = []
    for i, text in docs:
        n, runs = features(text, longest)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in runs)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = len(able) * percent // 100
    order = {}
    for place, r in enumerate(able[:drawn], 1):
        order.setdefault(id(r), place)
    return [(*r[:1], *r[2:], order.get(id(r))) for r in rows]


def hard_rows(n=300):
    rng = random.Random(8)
    words = ["alpha", "Beta", "straße", "ÉTÉ", "x1", "日本", "z" * 70, "q" * 300]
    rows = [(i, " ".join(rng.choice(words[: 2 + i % 7]) for _ in range(rng.choice([0, 1, 5, 30])))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, "-- \n"), (None, "alpha " * 40), (n + 3, "a_b-c d\x00E " * 30)]
    return rows + [(5, "alpha beta " * 30)] * 150 + [(n + 4, "long " * 200_000)]


@pytest.mark.parametrize("longest, percent, buckets, min_words", [(1, 10, 10_000, 20), (3, 35, 97, 0), (2, 100, 1, 5)])
def test_against_brute_force(spark, longest, percent, buckets, min_words):
    rows, target = hard_rows(), ["alpha beta x1 alpha", None, "été 日本", "unseen"]
    docs = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    out = resample(docs, bench, longest=longest, percent=percent, buckets=buckets, min_words=min_words)
    got = [(r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in out.collect()]
    want = brute(rows, target, percent, buckets, longest, min_words, "2024")
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_equal_rows_are_spread_and_ranked(spark):
    """A score and id of half of all rows falls into several segments."""
    rows = [(7, 5)] * 2000 + [(i, i % 50) for i in range(2000)] + [(None, 5)] * 30
    df = spark.createDataFrame(rows, "id long, score long").repartition(6)
    out = exact_ranks(df).withColumn("part", F.spark_partition_id()).collect()
    out.sort(key=lambda r: r.rank)
    assert [r.rank for r in out] == list(range(1, len(rows) + 1))
    want = sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    assert [(r.id, r.score) for r in out] == want
    sizes = np.bincount([r.part for r in out])
    assert len(np.unique([r.part for r in out if r.id == 7])) >= 3
    assert sizes.max() <= 2.5 * len(rows) / 8


def test_ranks_do_not_depend_on_the_layout(spark):
    df = spark.range(3000).select("id", (F.xxhash64("id") % 100).alias("score"))
    a = {(r.id, r.rank) for r in exact_ranks(df.repartition(3)).collect()}
    assert a == {(r.id, r.rank) for r in exact_ranks(df.repartition(11, "id")).collect()}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert resample(docs, docs.select("text")).count() == 0
    some = spark.createDataFrame([(1, "w " * 30), (2, None)], "doc_id long, text string")
    out = resample(some, docs.select("text"), percent=100).orderBy("doc_id").collect()
    assert [(r.n_features, r.rank) for r in out] == [(30, 1), (0, None)]


def test_words_of_blocks():
    data = np.frombuffer("ab cdé,f".encode(), np.uint8)
    starts, sizes, text = WordRuns().words(data, np.array([0, 1, 1, 5, len(data)]))
    assert [(int(a), int(b), int(c)) for a, b, c in zip(starts, sizes, text)] == [
        (0, 1, 0), (1, 1, 2), (3, 2, 2), (5, 2, 3), (8, 1, 3)
    ]
