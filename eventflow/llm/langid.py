"""Language identification by averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import released

BUCKETS = 1 << 16
DIM = 16
MULTIPLIER, TRIGRAM, SPREAD = np.uint32(0x01000193), np.uint32(0x5BD1E995), np.uint32(0x9E3779B1)
SHIFT = np.uint32(16)  # leaves the bits of BUCKETS
UNKNOWN = "und"
CHUNK = 1 << 19  # code points scored at once


class Subwords:
    """Hash buckets of the letter bigrams and trigrams of texts.

    Letters are lower-cased, everything else is a gap; a gram may begin or end with one gap
    and so marks beginnings and ends of words.
    """

    def __init__(self) -> None:
        fold = np.zeros(sys.maxunicode + 1, np.uint32)
        # Letters beyond 0x33480 are unassigned.
        for c in range(0x33480):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                fold[c] = ord(low) if len(low) == 1 else c
        self.fold = fold

    def __call__(self, text: str) -> Iterator[np.ndarray]:
        """Buckets of consecutive parts of a text; the whole text is covered."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        for a in range(0, len(codes), CHUNK):
            low = np.zeros(min(CHUNK, len(codes) - a) + 2, np.uint32)
            low[1:-1] = self.fold[codes[a : a + CHUNK]]
            letter = low != 0
            if not letter.any():
                continue
            low = low[np.append(True, letter[1:] | letter[:-1])]  # one gap between words
            two = (low[:-1] * MULTIPLIER) ^ low[1:]
            three = ((two[:-1] * MULTIPLIER) ^ low[2:])[low[1:-1] != 0]
            yield (np.concatenate([two, three ^ TRIGRAM]) * SPREAD) >> SHIFT


@dataclass
class Model:
    """Class scores by bucket (embedding times output weights) and calibration.

    There is no bias: text without a known gram scores all languages alike.
    """

    langs: list[str]
    scores: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def logits(self, texts: Iterable[str | None], subwords: Subwords) -> tuple[np.ndarray, np.ndarray]:
        """(logits by text, whether the text has a letter)."""
        out, known = [], []
        for text in texts:
            total, n = np.zeros(len(self.langs)), 0
            for ids in subwords(text or ""):
                if len(ids) > BUCKETS:
                    total += np.bincount(ids, minlength=BUCKETS) @ self.scores
                else:
                    total += self.scores[ids].sum(0)
                n += len(ids)
            out.append(total / max(n, 1))
            known.append(n > 0)
        return np.array(out).reshape(-1, len(self.langs)), np.array(known, bool)

    def predict(self, texts: Iterable[str | None], subwords: Subwords) -> tuple[list[str], np.ndarray]:
        z, known = self.logits(texts, subwords)
        p = softmax(z / self.temperature)
        best = p.argmax(1) if len(p) else np.zeros(0, int)
        score = np.where(known, p[np.arange(len(p)), best], 0.0) if len(p) else np.zeros(0)
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best, known)], score


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=-1, keepdims=True))
    return z / z.sum(axis=-1, keepdims=True)


def fit(
    texts: list[str], langs: list[str], *, epochs: int = 3, rate: float = 0.6, seed: int = 7,
    segment: int = 300,
) -> Model:
    """Stochastic gradient descent on pieces of the texts, 20 to ``segment`` letters long.

    A fifth is held back. On short pieces of it a temperature is fitted to the likelihood;
    the rejection threshold lies below what nearly every rightly named whole text reaches.
    Buckets that training never met score nothing, so text of unknown grams scores all
    languages alike and falls under the threshold.
    """
    names = sorted(set(langs))
    if not names:
        return Model([UNKNOWN], np.zeros((BUCKETS, 1)))
    rng = np.random.default_rng(seed)
    subwords = Subwords()
    label = np.array([names.index(x) for x in langs])
    order = rng.permutation(len(texts))
    held, train = order[: len(order) // 5], order[len(order) // 5 :]
    embed = rng.normal(0, 0.3 / DIM, (BUCKETS, DIM))
    met = np.zeros(BUCKETS, bool)
    weights = rng.normal(0, 0.3, (DIM, len(names)))
    per = np.bincount(label[train], minlength=len(names)) if len(train) else np.ones(len(names))
    balance = np.minimum(per.max() / np.maximum(per, 1), 20.0)
    steps, total = 0, max(1, epochs * len(train))
    for _ in range(epochs):
        for i in rng.permutation(train):
            steps += 1
            text = texts[i]
            size = int(rng.integers(20, segment + 1))
            at = int(rng.integers(0, max(1, len(text) - size + 1)))
            ids = [*subwords(text[at : at + size])]
            if not ids:
                continue
            ids = ids[0]
            met[ids] = True
            x = embed[ids].mean(0)
            p = softmax(x @ weights)
            p[label[i]] -= 1.0
            step = rate * (1 - steps / (total + 1)) * balance[label[i]]
            back = weights @ p
            weights -= step * np.outer(x, p)
            np.subtract.at(embed, ids, np.clip(step, 0, 2) * back / len(ids) * 8.0)
    scores = ((embed * met[:, None]) @ weights).astype(np.float32)
    model = Model(names, scores)
    if len(held):
        pieces = [texts[i][(a := len(texts[i]) // 3) : a + 25] for i in held]
        z, known = model.logits(pieces, subwords)
        z, y = z[known], label[held][known]
        if len(z):
            grid = np.geomspace(0.2, 200, 80)
            loss = [-np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
            model.temperature = float(grid[int(np.argmin(loss))])
        z, known = model.logits([texts[i] for i in held], subwords)
        z, y = z[known], label[held][known]
        if len(z):
            p = softmax(z / model.temperature)
            right = p.max(1)[p.argmax(1) == y]
            if len(right):
                model.reject_below = float(0.75 * np.quantile(right, 0.0005))
    return model


def labelled_sample(
    docs: DataFrame, text: str, lang: str, per_lang: int, chars: int, seed: int
) -> tuple[list[str], list[str]]:
    """About ``per_lang`` texts of each language, at most twice as many rows in all.

    Of a text over ``chars`` code points a window at a hashed place is taken.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}  # one row a language
    if not counts:
        return [], []
    dice = F.pmod(F.xxhash64(F.lit(seed), F.col(text)), F.lit(1 << 30))
    share = F.create_map(
        *[F.lit(v) for k, n in counts.items() for v in (k, int((1 << 30) * min(1.0, per_lang / n)))]
    )
    spare = F.greatest(F.length(text) - chars, F.lit(0)) + 1
    at = F.pmod(F.xxhash64(F.lit(seed + 1), F.col(text)), spare.cast("long")).cast("int") + 1
    picked = (
        rows.where(dice < share[F.col(lang)])
        .select(F.col(text).substr(at, F.lit(chars)).alias("t"), F.col(lang).alias("l"))
        .limit(2 * per_lang * len(counts)).collect()
    )
    picked = sorted((r.l, r.t) for r in picked)
    return [t for _, t in picked], [k for k, _ in picked]


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", *, per_lang: int = 1500,
    chars: int = 4000, seed: int = 7,
) -> Model:
    """Fit on a bounded sample of labelled rows: ``per_lang`` texts a language, ``chars`` each."""
    return fit(*labelled_sample(docs, text, lang, per_lang, chars, seed), seed=seed)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (calibrated probability) and ``rejected`` to each row.

    The whole text is scored, part by part. A null text and one without a letter give
    ``und``, score 0, rejected; other texts always name a learned language and are rejected
    if the score is under the calibrated threshold. Equal rows get equal results; columns
    of ``docs`` with those three names are replaced. An empty table gives no rows.
    """
    from pyspark.sql import types as T

    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # BUCKETS x languages, fixed
    own = ["lang_pred", "score", "rejected"]
    kept = docs.drop(*own)
    schema = T.StructType(
        [*kept.schema.fields, T.StructField("lang_pred", T.StringType()),
         T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    )

    @released
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, subwords = Model(**shared.value), Subwords()
        for batch in batches:
            names, score = m.predict((t.as_py() for t in batch.column(text)), subwords)
            rejected = (score < m.reject_below) | (score == 0)
            arrays = [*batch.columns, pa.array(names, pa.string()), pa.array(score), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *own])

    return kept.mapInArrow(run, schema)


def held_out(id_column: str) -> Column:
    """Rows kept from training: crc32 of the id as text leaves 2 modulo 4; null: no."""
    rest = F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(4))
    return F.coalesce(rest == 2, F.lit(False))
