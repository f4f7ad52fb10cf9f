"""Importance resampling towards a target distribution, and ranks by regular sampling."""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import stored, task_partitions, utf8_column
from eventflow.llm.hashing import fold_ascii, spaces_and_marks

CHUNK = 1 << 22  # bytes of text hashed at once; one longer text makes a block of its own
LONG = 64  # bytes of a word from which on it is hashed alone
MOST_RUNS = 1024  # sorted runs and splitters; about MOST_RUNS ** 2 samples go to the driver
ROW_BITS = (1 << 33) - 1  # of monotonically_increasing_id


def crc_table() -> np.ndarray:
    """Change of a reflected CRC-32 register for each low byte."""
    reg = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        reg = (reg >> np.uint32(1)) ^ np.where(reg & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return reg


class WordRuns:
    """Words of texts and the CRC-32 of runs of them, for whole blocks of texts."""

    def __init__(self) -> None:
        self.fold, self.word, self.crc = fold_ascii(), ~spaces_and_marks(), crc_table()

    def words(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, text) of each word; none reaches over the end of a text."""
        inside = np.zeros(len(data) + 1, bool)
        inside[:-1] = self.word[data]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        opens[ends] |= inside[ends]  # a text begins
        starts = np.flatnonzero(opens[:-1])
        shut = np.flatnonzero(~inside | opens)
        stops = shut[np.searchsorted(shut, starts, "right")]
        return starts, stops - starts, np.searchsorted(ends, starts, "right") - 1

    def feed(self, reg: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Registers after the bytes of one word each."""
        order = np.argsort(-size, kind="stable")
        out, at, left = reg[order], start[order], size[order]
        big = int(np.searchsorted(-left, -LONG, "left"))
        for i in range(big):
            a, n = int(at[i]), int(left[i])
            out[i] = zlib.crc32(data[a : a + n].data, int(out[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
        short_reg, short_at, short = out[big:], at[big:], left[big:]
        for j in range(int(short[0]) if len(short) else 0):
            k = int(np.searchsorted(-short, -j, "left"))  # those with more than j bytes
            r = short_reg[:k]
            short_reg[:k] = self.crc[(r ^ data[short_at[:k] + j]) & np.uint32(255)] ^ (r >> np.uint32(8))
        back = np.empty_like(out)
        back[order] = out
        return back

    def features(self, data: np.ndarray, ends: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(CRC-32, text) of all runs of 1 to ``longest`` words, and the words of each text."""
        data = self.fold[data]
        start, size, text = self.words(data, ends)
        count = np.bincount(text, minlength=len(ends) - 1)
        reg = np.full(len(start), 0xFFFFFFFF, np.uint32)
        codes, owners = [], []
        space = np.array([32], np.uint8)
        for n in range(longest):
            if n:  # one more word, after a space
                live = np.flatnonzero(text[n:] == text[: max(0, len(text) - n)])
                own = self.feed(reg[live], space, np.zeros(len(live), np.int64), np.ones(len(live), np.int64))
                reg[live] = self.feed(own, data, start[live + n], size[live + n])
            else:
                live = np.arange(len(start))
                reg = self.feed(reg, data, start, size)
            codes.append(reg[live] ^ np.uint32(0xFFFFFFFF))
            owners.append(text[live])
        return np.concatenate(codes), np.concatenate(owners), count


def text_blocks(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last text, bytes, offsets) of runs of texts with about ``CHUNK`` bytes."""
    first = 0
    while first < len(ends) - 1:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + CHUNK, "right")) - 1)
        yield first, last, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def bucket_counts(docs: DataFrame, text_column: str, buckets: int, longest: int) -> np.ndarray:
    """Features of all texts by bucket: one partial row per task and bucket is shuffled."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, total = WordRuns(), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, ends in text_blocks(*utf8_column(batch.column(0))):
                codes, _, _ = runs.features(data, ends, longest)
                total += np.bincount(codes % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    parts = docs.select(F.col(text_column).cast("string")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets``
        out[row.bucket] = row.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed bucket shares, rounded down."""
    buckets, s_all, t_all = len(raw), float(raw.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
        for s, t in zip(raw.tolist(), target.tolist())
    ], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_column: str, text_column: str, longest: int) -> DataFrame:
    """id, n_words, n_features and weight (the sum of gains over all features) of each row."""
    given = docs.schema[id_column].dataType.simpleString()

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = WordRuns()
        for batch in batches:
            words, n, weight = [], [], []
            for first, last, data, ends in text_blocks(*utf8_column(batch.column(1))):
                codes, text, count = runs.features(data, ends, longest)
                order = np.argsort(text, kind="stable")
                total = np.concatenate([[0], np.cumsum(gain[codes[order] % np.uint32(len(gain))])])
                own = np.bincount(text, minlength=last - first)
                stop = np.cumsum(own)
                words.append(count)
                n.append(own)
                weight.append(total[stop] - total[stop - own])
            if words:
                cells = [batch.column(0), *(pa.array(np.concatenate(x).astype(np.int64)) for x in (words, n, weight))]
                yield pa.RecordBatch.from_arrays(cells, names=["id", "n_words", "n_features", "weight"])

    own = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string"))
    return own.mapInArrow(score, f"id {given}, n_words long, n_features long, weight long")


def gumbel(id_column: Column, seed: str) -> Column:
    """Thousandths of seeded Gumbel noise of an id, rounded down; a null id counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def exact_ranks(rows: DataFrame, *, score: str = "score", ident: str = "id", name: str = "rank") -> DataFrame:
    """Add each row's rank (from 1) by descending score, ties to the smaller id, nulls last.

    Parallel sorting by regular sampling: the rows are dealt evenly into p runs, each sorted
    where it is and written; every g-th row of each run is a sample, of which every p-th is
    a splitter; rows between two splitters meet in one task, which merges its parts of the
    sorted runs; sums of the segments' counts give the ranks. No segment holds more than
    about twice its share, whatever the distribution: equal rows differ by run and place,
    so a splitter may fall between them. p is the shuffle parallelism, at most 1,024, so
    about p * p samples reach the driver.
    """
    spark = rows.sparkSession
    p = min(task_partitions(spark), MOST_RUNS)
    order = [F.desc(score), F.asc_nulls_last(ident)]
    names = rows.columns
    runs = stored(
        rows.repartition(p).sortWithinPartitions(*order)
        .withColumn("__run", F.spark_partition_id())
        .withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS))), "sorted-runs",
    )
    total = runs.count()
    step = max(1, total // (p * p))
    taken = runs.where((F.col("__at") % step) == step // 2).select(
        -F.col(score), F.col(ident).isNull(), F.coalesce(F.col(ident).cast("long"), F.lit(0)), "__run", "__at"
    )
    samples = sorted(tuple(r) for r in taken.collect())
    cut = samples[max(1, len(samples) // p) :: max(1, len(samples) // p)][: p - 1]
    lead = np.array([x[0] for x in cut], np.int64)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high = -batch.column(score).to_numpy()
            segment = np.searchsorted(lead, high, "left")
            tied = np.flatnonzero(segment < np.searchsorted(lead, high, "right"))
            if len(tied):  # equal to a splitter's score: compare whole keys
                part = batch.take(pa.array(tied))
                keys = zip(*(part.column(c).to_pylist() for c in (ident, "__run", "__at")))
                segment[tied] = [
                    bisect_right(cut, (h, i is None, i or 0, run, at))
                    for h, (i, run, at) in zip(high[tied].tolist(), keys)
                ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(segment.astype(np.int32))], names=[*batch.schema.names, "__segment"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in runs.schema)
    placed = stored(runs.mapInArrow(deal, f"{schema}, __segment int"), "segments")
    sizes = {r[0]: r[1] for r in placed.groupBy("__segment").count().collect()}  # at most p
    before, base = 0, []
    for i in range(len(cut) + 1):
        base.append(before)
        before += sizes.get(i, 0)
    merged = placed.repartitionById(len(base), F.col("__segment")).sortWithinPartitions(*order, "__run", "__at")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS))
    start = F.element_at(F.lit(base).cast("array<bigint>"), F.col("__segment") + 1)
    return merged.withColumn(name, place + start + 1).select(*names, name)


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    percent: int = 10,
    buckets: int = 10_000,
    longest: int = 1,
    min_words: int = 20,
    seed: str = "2024",
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Draw ``percent`` of the documents so that their features follow the target's.

    Words are runs of ASCII letters and digits and of all other characters beyond ASCII,
    with A-Z in lower case; features are all runs of 1 to ``longest`` words, hashed to
    ``buckets``. A document's weight is the sum of its features' log ratios of target to
    raw shares over all texts (``gains``); weight plus seeded Gumbel noise is its score, so
    that the highest scores are a draw without replacement. Documents of fewer than
    ``min_words`` words are never drawn.

    Gives every row once: id, n_words, n_features, weight, score and rank (null if not
    drawn). A null text has no words and weight 0; equal rows have equal scores and
    different ranks, in any order; a null id is last among ties. Empty tables draw nothing,
    an empty target makes all target shares equal. Other columns are ignored. The id is integral.
    """
    raw = bucket_counts(docs, text_column, buckets, longest)
    gain = gains(raw, bucket_counts(target, "text", buckets, longest))
    scored = weigh(docs, gain, id_column, text_column, longest)
    scored = stored(scored.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "scores")
    able = scored.where(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    ranked = exact_ranks(able).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).withColumnRenamed("id", id_column)
