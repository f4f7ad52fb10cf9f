import random

import pytest

from eventflow.llm.lines import drop_repeated_runs, line_windows
from tests.conftest import SF
from tests.llm import brute

SCHEMA = "doc_id long, text string, n_runs string, fingerprint int"


def hard_rows():
    rng = random.Random(6)
    pool = [f"line {i}" for i in range(12)] + ["", " ", "é😀", "\r"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    rows += [(100, "\n".join(["same"] * 30)), (101, "\n".join(["same"] * 5)), (102, "\n" * 20), (103, "\n" * 9)]
    rows += [(104, None), (105, ""), (106, "a\nb"), (107, "a\nb"), (None, "x\ny\nz"), (108, "x\ny\nz\nw")]
    return rows + [(109, "p\nq\nr\ns")] * 3 + [(110, "p\nq\nr\ns")] + [(111, "\n".join(map(str, range(50_000))))]


@pytest.mark.parametrize("run", [1, 3])
def test_against_brute_force(spark, run):
    rows = hard_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    out = drop_repeated_runs(df, run=run)
    assert out.columns == ["doc_id", "text", "fingerprint", "n_lines", "n_removed", "n_runs"]
    have = sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in out.collect()), key=repr)
    want = brute.drop_repeated_runs(rows, run)
    assert have == sorted(((k, *w) for (k, _), w in zip(rows, want)), key=repr)


def test_table_and_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    have = sorted((r.doc_id, r.n_lines, r.n_removed, r.text) for r in drop_repeated_runs(docs).collect())
    assert have == sorted((k, *w) for (k, _), w in zip(rows, brute.drop_repeated_runs(rows, 3)))
    assert drop_repeated_runs(docs.limit(0)).count() == 0


def test_every_window_has_a_fingerprint():
    rng = random.Random(2)
    lines = [str(rng.randint(0, 9)).encode() for _ in range(200)]
    found = line_windows(lines, 4)
    assert [w[2] for w in found] == list(range(197))
    same = {}
    for mark, digest, _, _ in found:
        assert same.setdefault(digest, mark) == mark  # equal windows, equal fingerprints


def brute_with_long(rows, run, words):
    """[(id, text)] -> [(lines, removed, text)]: also runs of fewer lines with more words."""
    first, out = {}, []

    def windows(text):
        lines = [] if text is None else text.split("\n")
        for n in range(1, run + 1):
            for i in range(len(lines) - n + 1):
                w = tuple(lines[i : i + n])
                if any(x.strip() for x in w) if n == run else len(" ".join(w).encode().split()) > words:
                    yield w, i

    for key, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for w, i in windows(text):
            first.setdefault(w, (key, text, i))
    for key, text in rows:
        gone = {j for w, i in windows(text) if first[w] != (key, text, i) for j in range(i, i + len(w))}
        lines = [] if text is None else text.split("\n")
        kept = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((len(lines), len(gone), kept))
    return out


def test_long_passages_of_few_lines(spark):
    passage, half = " ".join(f"w{i}" for i in range(51)), " ".join(f"h{i}" for i in range(26))
    rest = half.replace("h", "r")
    rows = [(1, passage), (2, f"own\n{passage}\ntail"), (3, passage), (4, f"{half}\n{rest}"),
            (5, f"a\n{half}\n{rest}\nb"), (6, half), (7, "short\nboilerplate"), (8, "short\nboilerplate"),
            (9, passage.rsplit(" ", 1)[0]), (10, passage.rsplit(" ", 1)[0]), (11, f"{passage}\n{passage}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    have = {r.doc_id: (r.n_removed, r.text) for r in drop_repeated_runs(df, long_words=50).collect()}
    assert have[1] == (0, passage) and have[2] == (1, "own\ntail") and have[3] == (1, "")
    assert have[5] == (2, "a\nb") and have[6] == (0, half) and have[8] == (0, "short\nboilerplate")
    assert have[10][0] == 0 and have[11] == (2, "")  # 50 words are not more than 50
    assert have == {k: w[1:] for (k, _), w in zip(rows, brute_with_long(rows, 3, 50))}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows += [(r.doc_id + 1000, r.text) for r in docs.collect()] + [(k and k + 9000, t) for k, t in hard_rows()]
    for words in (1, 50):
        out = drop_repeated_runs(spark.createDataFrame(rows, "doc_id long, text string"), long_words=words)
        have = sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in out.collect()), key=repr)
        assert have == sorted(((k, *w) for (k, _), w in zip(rows, brute_with_long(rows, 3, words))), key=repr)
