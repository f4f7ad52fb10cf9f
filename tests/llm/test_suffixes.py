import hashlib
import random

import numpy as np
import pytest

from eventflow.llm import suffixes
from eventflow.llm.suffixes import multikey_order, remove_repeats
from tests.conftest import SF
from tests.llm import brute


def hard_rows():
    rng = random.Random(3)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    big, passage = some(3000) + "éß", some(450)
    rows = [(1, "a" * 3000), (2, None), (3, ""), (None, big), (4, big[:1500] + "X" + big[1500:])]
    rows += [(5, "ab" * 700), (6, big * 8), (6, big * 8), (7, big[:399]), (8, big[100:500]), (8, big[100:500])]
    rows += [(100 + i, some(300) + passage + some(300)) for i in range(40)]
    rows += [(200 + i, passage + some(i)) for i in range(10)]
    # Partners on the left and on the right differ: together too long, alone too short.
    left, right = some(250), some(250)
    return rows + [(300, left + right), (301, left + some(250)), (302, some(250) + right)]


def check(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, b"x") for r in rows], "doc_id long, text string, key int, kept binary")
    out = remove_repeats(docs.repartition(5), **options).collect()
    have = sorted(
        ((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in out),
        key=repr,
    )
    want = brute.remove_repeats([t for _, t in rows], options.get("length", 400))
    assert have == sorted(((k, *w) for (k, _), w in zip(rows, want)), key=repr)


@pytest.mark.parametrize("group_rows, small", [(8192, 128), (8192, 2), (3, 128)])
def test_against_every_string(spark, monkeypatch, group_rows, small):
    """By suffix order, by hashes within a task, and by shuffled windows."""
    monkeypatch.setattr(suffixes, "SMALL", small)
    check(spark, hard_rows(), group_rows=group_rows)


def test_other_length_and_long_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 1000)
    check(spark, hard_rows()[:12], length=100)


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(spark, [(r.doc_id, r.text) for r in docs.collect()])


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(docs).count() == 0


def test_multikey_quicksort():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 2, (500, 24)).astype(np.uint8)
    order = multikey_order(rows.view(">u8").astype(np.uint64))
    assert [rows[i].tobytes() for i in order] == sorted(r.tobytes() for r in rows)


def test_windows_of_equal_first_hash_are_kept(spark, monkeypatch):
    """Long windows with few values of the first hash are still told apart."""
    hashes = suffixes.window_hashes

    def weak(data, width, powers, codes):
        h = hashes(data, width, powers, codes)
        return h if width < 400 or getattr(powers, "base", None) == suffixes.SECOND else h & np.uint64(7)

    monkeypatch.setattr(suffixes, "SECOND", getattr(suffixes, "SECOND", 0), raising=False)
    monkeypatch.setattr(suffixes, "window_hashes", weak)
    check(spark, hard_rows(), group_rows=3)
