import zlib

import pytest
from pyspark.sql import functions as F

from eventflow.llm import langid
from tests.conftest import SF


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return langid.train(docs.where(~langid.held_out("doc_id")))


def test_held_out_accuracy(docs, model):
    rows = langid.identify(docs, model).where(langid.held_out("doc_id")).collect()
    assert len(rows) > 30
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert not any(r.rejected for r in rows)


def test_held_out_rule(spark):
    ids = [(i,) for i in [*range(50), -3, None]]
    got = {r.doc_id: r.h for r in spark.createDataFrame(ids, "doc_id long").withColumn("h", langid.held_out("doc_id")).collect()}
    assert got == {i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for (i,) in ids}


def test_edges(spark, model):
    texts = [None, "", "12 34 !?", "\n\t", "日本語の文章です", "the", "the", "x" * 700_000]
    rows = spark.createDataFrame(
        [(i, t, "old", 1.5, "lang") for i, t in enumerate(texts)], "doc_id int, text string, lang_pred string, score double, rejected string"
    )
    got = [langid.identify(rows, model).where(F.col("doc_id") == i).first() for i in range(len(texts))]
    assert [r.lang_pred for r in got[:4]] == ["und"] * 4 and [r.score for r in got[:4]] == [0] * 4
    assert all(r.rejected for r in got[:5])  # unknown letters score under the threshold
    assert all(r.lang_pred in model.langs for r in got[4:])
    assert got[5][1:] == got[6][1:] and not got[5].rejected
    assert langid.identify(rows.limit(0), model).count() == 0


def test_long_text_counts_to_its_end(model):
    words = langid.Subwords()
    model_sum = model.logits(["the and of " * 100_000, "the and of "], words)[0]
    assert abs(model_sum[0] - model_sum[1]).max() < 0.2
    mixed = model.logits(["the and of " * 60_000 + "und der die " * 300_000], words)[0][0]
    assert model.langs[int(mixed.argmax())] == "de"


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([(1, None, "en"), (2, "a", None)], "doc_id long, text string, lang string")
    model = langid.train(empty)
    got = langid.identify(empty, model).collect()
    assert [r.lang_pred for r in got] == ["und", "und"]
