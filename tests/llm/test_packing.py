import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventflow.llm.packing import TOKENIZER, Words, best_fit, pack, pack_documents, pieces, sequences
from tests.conftest import SF

SCHEMA = "doc_id long, text string, length string, sequence_id long"
TEXTS = [
    (1, "One two\tthree.\n\nFour, FIVE!"), (2, None), (3, ""), (4, " \n "), (5, "word " * 700),
    (5, "word " * 700), (None, "naïve Ünïcode é ≠ x"), (7, "a<|endoftext|>b <|endoftext|>"),
    (8, "no-spaces" * 900), (9, "it's we'll 1234  y\x0bz\x1cq"), (10, "日本語 テキスト 😀"),
]


def ids_of(text, model):
    return model.encode(text or "", add_special_tokens=False).ids + [0]


def documents(spark, rows=TEXTS):
    return spark.createDataFrame([(*r, "x", -1) for r in rows], SCHEMA).repartition(3)


def test_words_encode_as_in_a_text():
    model = Tokenizer.from_file(TOKENIZER)
    words = ["Straße.", "İstanbul.", "ſo", "a", "A!!", "e\u0301t", "=\u0338", "x=", "ŉ,", "don't", "'s", "’s.", "",
             "don.'t", "Ĳ###", "ĸ", "Σας", "ª.", "µm", "º", "x…", "x….", "123.", "a1", "<|endoftext|>", "Š'", "…."]
    words += [a + b for a in ("Ab", "é", "9") for b in words] * 20
    ids, at = Words(model)(pa.array(words, pa.large_string()))
    for w, a, b in zip(words, at, at[1:]):
        assert ids[a:b].tolist() == model.encode(w, add_special_tokens=False).ids, w


def check(rows, max_tokens, max_documents=10**9, max_attention=10**18):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append(r)
    for group in held.values():
        at = 0
        for r in sorted(group, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= max_tokens and len(group) <= max_documents
        assert sum(r.length**2 for r in group) <= max_attention
    return len(held)


def test_pieces_are_the_tokens_of_whole_texts(spark):
    model = Tokenizer.from_file(TOKENIZER)
    out = pack_documents(documents(spark), max_tokens=256, with_ids=True).cache()
    rows = out.collect()
    check(rows, 256)
    want = defaultdict(int)
    for i, text in TEXTS:
        ids = ids_of(text, model)
        for p in range(0, len(ids), 256):
            part = ids[p : p + 256]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            want[i, p // 256, p, len(part), crc, tuple(part)] += 1
    have = defaultdict(int)
    for r in rows:
        have[r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)] += 1
    assert have == want
    tokens = {r.sequence_id: r for r in sequences(out).collect()}
    for r in rows:
        own = tokens[r.sequence_id]
        assert own.ids[r.offset : r.offset + r.length] == r.ids and r.offset in own.starts


def test_a_whole_table_is_packed_to_its_bound(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = Tokenizer.from_file(TOKENIZER)
    rows = pack_documents(docs).collect()
    n = check(rows, 2048)
    total = sum(len(ids_of(r.text, model)) for r in docs.collect())
    assert total == sum(r.length for r in rows)
    assert n <= -(-total // 2048) + 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("limits", [(100, None, None), (100, 3, None), (100, None, 2500), (100, 4, 3000)])
def test_every_capacity_holds(spark, rule, limits):
    rng = random.Random(4)
    tokens, documents, attention = limits
    top = min(tokens, int((attention or 10**9) ** 0.5))
    sizes = [rng.randint(1, top) if rng.random() < 0.6 else 7 for _ in range(900)]
    df = spark.createDataFrame([(i // 3, n, "x") for i, n in enumerate(sizes)], "doc_id long, length long, extra string")
    out = pack(df, max_tokens=tokens, max_documents=documents, max_attention=attention, rule=rule, group_rows=300)
    rows = out.collect()
    assert sorted((r.doc_id, r.length, r.extra) for r in rows) == sorted((i // 3, n, "x") for i, n in enumerate(sizes))
    used = check(rows, tokens, documents or 10**9, attention or 10**18)
    least = max(
        sum(sizes) / tokens, len(sizes) / (documents or 10**9), sum(n * n for n in sizes) / (attention or 10**18)
    )
    assert used <= 1.35 * least + 3


def test_best_fit_against_a_plain_version():
    rng = np.random.default_rng(1)
    for rule in ("norm", "dot"):
        length = rng.integers(1, 60, 200)
        demands = np.stack([length, np.ones(200), length**2], axis=1).astype(float)
        capacity, weights = np.array([100.0, 5, 4000]), np.array([1.0, 0.3, 0.2])
        order = sorted(range(200), key=lambda i: -float((demands[i] / capacity) @ weights))
        bins = []
        for i in order:
            fits = [b for b in bins if (b["left"] >= demands[i]).all()]
            if rule == "norm":
                value = lambda b: (weights * ((b["left"] - demands[i]) / capacity) ** 2).sum()  # noqa: E731, B023
            else:
                value = lambda b: -((1 - b["left"] / capacity) * weights * demands[i] / capacity).sum()  # noqa: E731, B023
            best = min(fits, key=value, default=None)
            if best is None:
                best = {"left": capacity.copy(), "items": []}
                bins.append(best)
            best["left"] = best["left"] - demands[i]
            best["items"].append(i)
        got = best_fit(demands, capacity, weights, rule)
        mine = sorted(sorted(np.flatnonzero(got == b).tolist()) for b in np.unique(got))
        # Equal norms may differ in the last digit: the numbers of bins must agree.
        assert len(mine) == len(bins)
    with pytest.raises(ValueError):
        best_fit(np.array([[101.0, 1, 1]]), capacity, weights)


def test_one_document_with_a_third_of_all_rows(spark):
    rows = [(1, "same text here")] * 400 + [(i, "w " * (i % 90)) for i in range(800)]
    out = pack_documents(documents(spark, rows), max_tokens=128, group_rows=200)
    spread = out.withColumn("group", F.shiftright("sequence_id", 32)).groupBy("group").count().collect()
    assert len(spread) >= 5 and max(r["count"] for r in spread) <= 300
    check(out.collect(), 128)


def test_empty_table(spark):
    assert pack_documents(documents(spark, []).limit(0)).count() == 0
    assert pieces(documents(spark, [(1, None)])).select("piece", "start", "length").collect() == [(0, 0, 1)]
