import random

import numpy as np

from eventflow.llm import decontaminate
from eventflow.llm.decontaminate import RADIUS, build_index, decontaminate as clean, find_contamination, simhash
from tests.conftest import SF
from tests.llm import brute

DOCS, ITEMS = "doc_id long, text string, contamination string, item_id int", "item_id long, text string, n int"


def hard_rows():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 6)))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([5, 6, 15, 15, 20, 33, 59, 59, 120])]
    items += [(50, None), (51, ""), (52, "one two"), (53, "the the the the the the the the the"), (54, items[4][1]), (55, items[4][1])]
    docs = []
    for i, (_, t) in enumerate(items[:9]):
        for edits in range(5):
            own = t.split()
            for _ in range(edits):
                own[rng.randrange(len(own))] = word()
            if edits == 4:
                own.insert(len(own) // 2, word())
            around = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(2)]
            text = f"{around[0]} {' '.join(own)} {around[1]}"
            docs.append((100 * i + edits, text.upper() if edits == 1 else text.replace(" ", ", ") if edits == 2 else text))
    docs += [(1000, None), (1001, ""), (1002, "the " * 4000), (1003, "one two"), (None, items[3][1]), (1004, items[3][1])]
    docs += [(1004, items[3][1]), (1005, " ".join(word() for _ in range(5000)) + " " + items[6][1])]
    return docs, items


def check(spark, docs, items):
    table = spark.createDataFrame([(*r, "x", 1) for r in docs], DOCS).repartition(4)
    bench = spark.createDataFrame([(*r, 1) for r in items], ITEMS)
    found = find_contamination(table, bench)
    have = sorted(
        ((r.doc_id, [(c.item_id, round(c.similarity, 9)) for c in r.contamination]) for r in found.collect()), key=repr
    )
    want = sorted(
        ((k, sorted((i, round(s, 9)) for i, s in brute.contamination(t, items).items())) for k, t in docs), key=repr
    )
    assert have == want
    assert clean(table, bench).count() == sum(not w[1] for w in want)
    assert any(w[1] for w in want)


def test_against_all_windows(spark):
    check(spark, *hard_rows())


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 4)
    check(spark, *hard_rows())


def test_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    check(spark, docs, items)


def test_empty(spark):
    none, some = spark.createDataFrame([], ITEMS), spark.createDataFrame([(1, "a b c d e f", "x", 1)], DOCS)
    assert find_contamination(some, none).first().contamination == []
    assert clean(some, none).count() == 1
    assert clean(some.limit(0), spark.createDataFrame([(1, "a b c d e", 1)], ITEMS)).count() == 0


def test_blocks_find_every_print_within_the_radius():
    texts = [" ".join(f"w{(i * 7 + j) % 97}" for j in range(20)) for i in range(30)]
    at = build_index(list(range(30)), texts, 0.8)["sizes"][20]
    rng = np.random.default_rng(5)
    for i, own in enumerate(at["prints"]):
        for _ in range(40):
            flips = rng.choice(64, rng.integers(0, RADIUS + 1), replace=False)
            other = own ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64), initial=np.uint64(0))
            values = np.array([other]).view(np.uint8)
            hits = [at["buckets"].get(b << 8 | int(v)) for b, v in enumerate(values)]
            assert any(h is not None and i in h for h in hits)


def test_simhash_counts_bits():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 1 << 63, (4, 9)).astype(np.uint64)
    for row, got in zip(h, simhash(h)):
        want = sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in row) > 9)
        assert int(got) == want
