import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventflow.llm.mixing import mix, n_tokens
from tests.llm import brute

SCHEMA = "doc_id long, dom string, lang string, source string, text string, copies string"


def hard_rows(n=400):
    rng = random.Random(12)
    rows = []
    for i in range(n):
        source = "s0" if rng.random() < 0.4 else f"s{rng.randint(1, 9)}"
        rows.append((i, rng.choice("abc"), rng.choice(["en", "en", "de", None]), rng.choice([source, source, None]),
                     "w " * rng.choice([0, 1, 3, 10, 300])))
    rows += [(7, *rows[7][1:4], "x y z"), rows[9], rows[9], (None, "a", "en", "s0", "one"), (900, None, "en", "s0", None)]
    return rows + [(901, "zero", "en", "s0", "w " * 500), (902, "a", "xx", "s1", " \t\n\x0b\x0c\r ")]


CASES = [
    ({}, None, 2), ({"domain": {"a": 5, "b": 1}, "lang": {"en": 3}, "source": {"s0": 9}}, None, 2),
    ({"domain": {"zero": 0}, "source": {"s1": 0}}, 5_000, 3), ({"domain": {"a": 100}}, 10**7, 4), ({}, 17, 1),
]


@pytest.mark.parametrize("weights, budget, epochs", CASES)
def test_against_brute_force(spark, weights, budget, epochs):
    rows = hard_rows()
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(4)
    out = mix(df, domain=F.col("dom"), weights=weights, budget=budget, max_epochs=epochs, seed=3)
    assert out.columns == ["doc_id", "dom", "lang", "source", "text", "domain", "n_tokens", "copies"]
    have = Counter(((r.doc_id, r.dom, r.lang, r.source, r.text), r.copies) for r in out.collect())
    want = brute.mix(rows, weights, budget, epochs, 3)
    assert have == Counter((r, c) for r, c in zip(rows, want) if c)
    taken = sum(len((r[4] or "").split()) * c for r, c in zip(rows, want))
    assert taken <= (budget if budget is not None else 10**9)


def test_weights_are_met_when_nothing_is_short(spark):
    rows = [(i, "ab"[i % 2], "en", f"s{i % 4}", "w " * 5) for i in range(2000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    out = mix(df, domain=F.col("dom"), weights={"domain": {"a": 3, "b": 1}}, budget=4000, max_epochs=1)
    got = {r.domain: r.n for r in out.groupBy("domain").agg(F.sum("n_tokens").alias("n")).collect()}
    assert abs(got["a"] - 3000) <= 20 and abs(got["b"] - 1000) <= 20


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mix(df, domain=F.col("dom"), weights={}).count() == 0


def test_tokens(spark):
    df = spark.createDataFrame([("a b",), (None,), ("",), (" x y\x1cz\n",)], "text string")
    assert [r.n for r in df.select(n_tokens("text").alias("n")).collect()] == [2, 0, 0, 1]
