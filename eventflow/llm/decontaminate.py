"""Benchmark decontamination: SimHash windows, multi-index Hamming search, exact check."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.llm.common import released, utf8_column
from eventflow.llm.hashing import WordHasher, fold_ascii, shingles, spaces_and_marks

SHINGLE = 5
BLOCKS, BLOCK_RADIUS = 8, 2  # of 64 bits
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1  # by the pigeonhole principle none within is missed
KNOWN_SLOTS = 1 << 20
ITEM_BLOCK = 4096  # items matched at once


def words_of(
    column: pa.Array, hasher: WordHasher | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Word hashes by chunk: lower case, words are split at ASCII marks and white space."""
    data, offsets = utf8_column(pc.utf8_lower(column.cast(pa.large_string())))
    yield from (hasher or WordHasher(spaces_and_marks(), fold_ascii()))(data, offsets)


def simhash(h: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of rows of shingle hashes; a repeated shingle weighs more."""
    bits = np.unpackbits(np.ascontiguousarray(h).view(np.uint8).reshape(*h.shape, 8), axis=-1)
    votes = 2 * bits.sum(axis=1, dtype=np.int32) > h.shape[1]
    return np.packbits(votes, axis=-1).view(np.uint64).ravel()


def weighted_similarity(x: np.ndarray, y: np.ndarray) -> float:
    """Sum of the lesser by sum of the greater occurrence counts of all shingles."""
    a, m = np.unique(x, return_counts=True)
    b, n = np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = int(np.minimum(m[i], n[j]).sum())
    return shared / (len(x) + len(y) - shared)


def least_shared(total: int, similarity: float) -> int:
    """Shingles that two equal-sized multisets of ``similarity`` or more share at least."""
    return int(np.ceil(2 * total * similarity / (1 + similarity) - 1e-9))


def build_index(ids: list, texts: list[str | None], similarity: float) -> dict:
    """Items by word count, with their fingerprints in Hamming buckets.

    For each of ``BLOCKS`` blocks an item is listed under every block value within
    ``BLOCK_RADIUS`` of its own, so a lookup of a window's block values finds all items
    within ``RADIUS``.
    """
    near = [
        [v for v in range(256) if (v ^ own).bit_count() <= BLOCK_RADIUS] for own in range(256)
    ]
    sizes: dict[int, dict] = {}
    for first, words, bounds in words_of(pa.array(texts, pa.string())):
        for i in range(len(bounds) - 1):
            own = words[bounds[i] : bounds[i + 1]]
            if len(own) < SHINGLE:
                continue
            h = shingles(own, np.array([0, len(own)]), SHINGLE)[0]
            at = sizes.setdefault(len(own), {"ids": [], "sets": [], "prints": []})
            at["ids"].append(ids[first + i])
            at["sets"].append(h)
            at["prints"].append(simhash(h[None, :])[0])
    pairs = []
    for n, at in sizes.items():
        at["prints"] = np.array(at["prints"], np.uint64)
        buckets: dict[int, list[int]] = {}
        for i, blocks in enumerate(at["prints"].view(np.uint8).reshape(-1, BLOCKS)):
            for b, own in enumerate(blocks):
                for v in near[int(own)]:
                    buckets.setdefault(b << 8 | v, []).append(i)
        at["buckets"] = {k: np.array(v) for k, v in buckets.items()}
        at["need"] = least_shared(n - SHINGLE + 1, similarity)
        known = np.unique(np.concatenate(at["sets"]))
        pairs.append(np.stack([known, np.full(len(known), n, np.uint64)]))
    both = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.uint64)
    both = both[:, np.argsort(both[0], kind="stable")]
    slots = np.zeros(KNOWN_SLOTS, bool)
    slots[(both[0] & np.uint64(KNOWN_SLOTS - 1)).astype(np.int64)] = True
    return {"sizes": sizes, "known": both[0], "of_size": both[1].astype(np.int64), "slots": slots}


def window_matches(h: np.ndarray, places: np.ndarray, at: dict, n: int, similarity: float) -> dict:
    """Best window of each item of ``n`` words in a text: {item: (similarity, start)}.

    ``h`` are the text's shingles, ``places`` those that some item of ``n`` words has. A
    window with fewer of them than similar multisets share cannot match and is not
    fingerprinted; all others go through the fingerprint search and the exact check.
    """
    m, need = n - SHINGLE + 1, at["need"]
    out: dict = {}
    if len(places) < need or len(h) < m:
        return out
    near = np.flatnonzero(places[need - 1 :] - places[: len(places) - need + 1] < m)
    lo = np.maximum(places[near + need - 1] - m + 1, 0)
    hi = np.minimum(places[near], len(h) - m)
    starts = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(lo, hi)] or [np.zeros(0, int)]))
    step = max(1, (1 << 19) // m)
    for a in range(0, len(starts), step):
        some = starts[a : a + step]
        prints = simhash(h[some[:, None] + np.arange(m)])
        blocks = prints.view(np.uint8).reshape(-1, BLOCKS)
        for start, own, values in zip(some, prints, blocks):
            lists = [at["buckets"].get(b << 8 | int(v)) for b, v in enumerate(values)]
            lists = [x for x in lists if x is not None]
            if not lists:
                continue
            items = np.unique(np.concatenate(lists))
            apart = np.bitwise_count(at["prints"][items] ^ own)
            for i in items[apart <= RADIUS]:
                like = weighted_similarity(h[start : start + m], at["sets"][i])
                if like >= similarity and like > out.get(at["ids"][i], (0, 0))[0]:
                    out[at["ids"][i]] = (like, int(start))
    return out


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    similarity: float = 0.8,
) -> DataFrame:
    """Add ``contamination``: (item_id, start, words, similarity) of items found in each text.

    A window of as many words as an item has matches if the weighted Jaccard similarity of
    their 5-word shingles (weights: occurrences) is ``similarity`` or more; ``start`` is the
    word place of the best window, the earliest of equals. Items are in order of their id.
    Texts are lower-cased and split at white space and ASCII marks. Items and texts that are
    null or have fewer than five words match nothing; rows with equal items give an entry
    each only if their ids differ; equal documents get equal results; a column named
    contamination is replaced. An empty table gives no rows, an empty benchmark no entries.

    The benchmark is matched in blocks of ``ITEM_BLOCK`` items, so what is sent to tasks has
    a bound; documents are never shuffled.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).alias("id"), F.col(item_text).alias("t"))
    kind = benchmark.schema[item_id].dataType
    entry = T.StructType(
        [T.StructField("item_id", kind), T.StructField("start", T.LongType()),
         T.StructField("words", T.LongType()), T.StructField("similarity", T.DoubleType())]
    )
    empty = F.array().cast(T.ArrayType(entry))
    out = docs.withColumn("contamination", empty)
    blocks = -(-items.count() // ITEM_BLOCK)
    for i in range(blocks):
        some = items.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == i).distinct().collect()
        index = build_index([r.id for r in some], [r.t for r in some], similarity)
        index["similarity"] = similarity
        shared = spark.sparkContext.broadcast(index)  # some ITEM_BLOCK items

        @released
        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            at, hasher = shared.value, WordHasher(spaces_and_marks(), fold_ascii())
            for batch in batches:
                found = batch.column("contamination").to_pylist()
                for first, words, bounds in words_of(batch.column(text), hasher):
                    h, ends = shingles(words, bounds, SHINGLE)
                    maybe = np.flatnonzero(at["slots"][(h & np.uint64(KNOWN_SLOTS - 1)).astype(np.int64)])
                    lo = np.searchsorted(at["known"], h[maybe])
                    hi = np.searchsorted(at["known"], h[maybe], side="right")
                    place, entry_at = np.repeat(maybe, hi - lo), np.concatenate(
                        [np.arange(a, b) for a, b in zip(lo, hi) if a < b] or [np.zeros(0, int)]
                    )
                    row, size = np.searchsorted(ends, place, side="right") - 1, at["of_size"][entry_at]
                    for i in np.unique(row):
                        own, mine = h[ends[i] : ends[i + 1]], row == i
                        for n in np.unique(size[mine]):
                            places = place[mine & (size == n)] - ends[i]
                            best = window_matches(own, places, at["sizes"][int(n)], int(n), at["similarity"])
                            found[first + i] += [
                                {"item_id": k, "start": s, "words": int(n), "similarity": like}
                                for k, (like, s) in best.items()
                            ]
                arrays = [
                    pa.array(found, batch.schema.field("contamination").type) if name == "contamination" else column
                    for name, column in zip(batch.schema.names, batch.columns)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

        out = out.mapInArrow(run, out.schema)
    return out.withColumn(
        "contamination", F.array_sort("contamination", lambda a, b: F.when(a["item_id"] < b["item_id"], -1).when(a["item_id"] > b["item_id"], 1).otherwise(0))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found."""
    return find_contamination(docs, benchmark, **options).where("size(contamination) = 0").drop("contamination")
