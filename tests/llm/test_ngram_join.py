import random

from eventflow.llm import ngram_join
from eventflow.llm.components import components
from eventflow.llm.ngram_join import may_reach, one_of_each, prefix_length, similar_groups
from tests.conftest import SF
from tests.llm import brute

SCHEMA = "doc_id long, text string, nid string, size int, token string"


def hard_rows(seed=1):
    """Near copies of one text, chains, short texts, copies, nulls and repeated rows."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 5)))
    base = [word() for _ in range(120)]
    rows = []
    for i in range(60):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = word()
        rows.append((1000 + i, " ".join(own)))
    chain = list(base[:60])
    for i in range(20):  # each links with the next only
        chain[(i * 3) % 60] = word()
        rows.append((500 - i, "\n".join(chain)))
    rows += [(i, " ".join(word() for _ in range(rng.randint(1, 30)))) for i in range(40)]
    rows += [(200, "one two three"), (199, "ONE two\tthree"), (198, "one two three four")]
    rows += [(300, None), (301, ""), (302, "  \n "), (None, "one two three"), (None, None)]
    rows += [(400, rows[0][1])] * 3 + [(401, "É é x " * 400), (402, "é é x " * 400)]
    return rows


def check(spark, rows, k, percent):
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(6)
    got = similar_groups(docs, k=k, percent=percent)
    assert got.count() == len(rows)
    want = brute.similar_groups(rows, k, percent)
    have = sorted(
        ((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr
    )
    assert have == sorted(((r[0], w[0], w[1]) for r, w in zip(rows, want)), key=repr)


def test_against_all_pairs(spark, monkeypatch):
    """With star rounds as long as they find links."""
    monkeypatch.setattr(ngram_join, "CROSS_PER_ROW", 0)
    check(spark, hard_rows(), 4, 85)


def test_hot_shingles_and_the_last_round_alone(spark, monkeypatch):
    """Runs dealt out over parts, all that is left compared at once, no broadcast."""
    monkeypatch.setattr(ngram_join, "HOT_RUN", 5)
    monkeypatch.setattr(ngram_join, "STAR_ROUNDS", 0)
    monkeypatch.setattr(ngram_join, "BROADCAST_KEYS", 0)
    check(spark, hard_rows(2), 2, 50)


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(spark, rows, 5, 80)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert similar_groups(docs).count() == 0
    assert one_of_each(docs).columns == ["doc_id", "text"]


def test_one_of_each(spark):
    rows = hard_rows(4)
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    left = [(r.doc_id, r.text) for r in one_of_each(docs, k=4, percent=85).collect()]
    groups = brute.similar_groups(rows, 4, 85)
    assert len(left) == len(set(left))
    kept = {g[2] for r, g in zip(rows, groups) if r in left}
    assert kept == {g[2] for g in groups}  # one of each group, and no more of linked ones
    for r, g in zip(rows, groups):
        if g[0] and g[1] is not None:
            assert (r in left) == (r[0] == g[1])
    for r in rows:
        if not brute.shingle_set(r[1], 4):
            assert r in left


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 50), (7, 7), (200, 300), (300, 200), (None, 3)]
    out = components(spark.createDataFrame(links, "a long, b long"))
    want = {i: 0 for i in range(41)} | {50: 50, 100: 50, 200: 200, 300: 200}
    assert {r.node: r.component for r in out.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_filters_lose_nothing():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(300):
        x, y = (np.unique(rng.integers(0, 60, rng.integers(1, 50))) for _ in range(2))
        common = len(np.intersect1d(x, y))
        assert all(may_reach(x, y, need) for need in range(common + 1))
        union = len(x) + len(y) - common
        for percent in (50, 80, 85, 100):
            if 100 * common >= percent * union:
                px, py = x[: prefix_length(len(x), percent)], y[: prefix_length(len(y), percent)]
                assert len(np.intersect1d(px, py))


def test_copies_join_once(spark, monkeypatch):
    """Of rows with equal shingle sets only one meets the others; all keep their result."""
    seen = []
    postings = ngram_join._postings

    def counted(docs, *args):
        seen.append(docs.count())
        return postings(docs, *args)

    monkeypatch.setattr(ngram_join, "_postings", counted)
    monkeypatch.setattr(ngram_join, "CROSS_PER_ROW", 0)
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 5)))
    shared = [word() for _ in range(60)]
    a, b = " ".join(shared + ["x"] * 12), " ".join(shared[:50] + ["y"] * 12)
    rows = [(i, a if i % 3 else a.upper()) for i in range(40)] + [(100 + i, b) for i in range(40)]
    rows += hard_rows(3)[:30] + [(300, None), (301, "")]
    check(spark, rows, 4, 85)
    distinct = {frozenset(brute.shingle_set(r[1], 4)) for r in rows} - {frozenset()}
    assert seen == [len(distinct)]
