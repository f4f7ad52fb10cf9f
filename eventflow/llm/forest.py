"""Nearest neighbours by inner product with a forest of sorted hash-string arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventflow.llm.common import stored

BITS = 48  # length of a hash string; prefixes are compared exactly as integers
FOUND = "q long, h long, mid long, score double"


@dataclass
class Forest:
    """Hyperplanes and thresholds of each tree, and how far queries ascend."""

    planes: np.ndarray  # trees, BITS, dim + 1
    cuts: np.ndarray  # trees, BITS
    norm: float
    fraction: float
    floor: int

    def lift(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """One more coordinate makes the largest inner product the least angle."""
        if query:
            unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            return np.hstack([unit, np.zeros((len(unit), 1))])
        scaled = vectors / self.norm
        rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(1, keepdims=True)))
        return np.hstack([scaled, rest])

    def keys(self, vectors: np.ndarray, tree: int, query: bool) -> np.ndarray:
        """Hash strings as integers, first bit highest."""
        bits = self.lift(vectors, query) @ self.planes[tree].T > self.cuts[tree]
        return bits.astype(np.int64) @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def common_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of hash strings."""
    return BITS - np.frexp((a ^ b).astype(np.float64))[1]


def fit(
    sample: np.ndarray, norm: float, *, trees: int, k: int, recall: float, seed: int, probes: int = 200
) -> Forest:
    """Hyperplanes with median cuts on a sample; the ascent that reaches ``recall`` on it.

    A sample is sparser than the table, so its neighbours are further away and its ascent
    is rather too long than too short.
    """
    rng = np.random.default_rng(seed)
    planes = rng.normal(size=(trees, BITS, sample.shape[1] + 1))
    forest = Forest(planes, np.zeros((trees, BITS)), norm, float(trees), 0)  # all rows
    lifted = forest.lift(sample, False)
    forest.cuts = np.median(np.einsum("nd,tbd->tbn", lifted, planes), axis=2)
    if len(sample) <= 4 * k:
        return forest
    own = rng.choice(len(sample), min(probes, len(sample)), replace=False)
    scores = sample[own] @ sample.T
    best = np.argsort(-scores, axis=1)[:, : k + 1]
    indexed = [forest.keys(sample, t, False) for t in range(trees)]
    asked = [forest.keys(sample[own], t, True) for t in range(trees)]
    levels = np.stack([common_bits(a[:, None], x[None, :]) for a, x in zip(asked, indexed)])
    top = levels.max(0)
    # Candidates, counted once a tree, at each level of a synchronous ascent.
    reached = np.stack([(levels >= x).sum((0, 2)) for x in range(BITS + 1)], axis=1)
    grid = [f for f in np.geomspace(0.002, trees, 90) if f * len(sample) >= 2 * k]
    for fraction in grid:
        stop = np.array([
            max([x for x in range(BITS + 1) if r[x] >= fraction * len(sample)], default=0)
            for r in reached
        ])
        hit = np.take_along_axis(top, best, axis=1) >= stop[:, None]
        if hit.mean() >= recall:
            forest.fraction, forest.floor = float(fraction), int(min(stop.min(), 10))
            return forest
    return forest


def _stack(column: pd.Series, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype).reshape(len(column), -1).astype(np.float64)


def _best(score: np.ndarray, mid: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
        return at[np.lexsort((mid[at], -score[at]))[:k]]
    return np.lexsort((mid, -score))[:k]


def descend_and_ascend(
    keys: np.ndarray, asked: int, scores: np.ndarray, mid: np.ndarray, floor: int, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One query in one sorted array: from its longest prefix match up to ``floor`` bits.

    Returns the number of rows at each level, and the places and levels of the rows that
    are among the k best of all rows at their level or deeper: no other row can be among
    the k best of any ascent.
    """
    levels = np.arange(BITS, floor - 1, -1, dtype=np.int64)
    shift = BITS - levels
    lo = np.searchsorted(keys, (asked >> shift) << shift)
    hi = np.searchsorted(keys, ((asked >> shift) + 1) << shift)
    counts = np.zeros(BITS + 1, np.int64)
    counts[levels] = hi - lo
    places, depth, kept = [], [], np.zeros(0, np.int64)
    a = b = None
    for level, x, y in zip(levels, lo, hi):
        if x == y or (a == x and b == y):
            continue
        new = np.arange(x, y) if a is None else np.concatenate([np.arange(x, a), np.arange(b, y)])
        a, b = x, y
        new = new[_best(scores[new], mid[new], k)]
        both = np.concatenate([kept, new])
        both = both[_best(scores[both], mid[both], k)]
        entered = np.setdiff1d(both, kept, assume_unique=True)
        places.append(entered)
        depth.append(np.full(len(entered), level))
        kept = both
    if not places:
        return counts, np.zeros(0, np.int64), np.zeros(0, np.int64)
    return counts, np.concatenate(places), np.concatenate(depth)


def exact_nearest(
    classes: DataFrame, queries: DataFrame, dtype: str, k: int, block: int = 1024
) -> DataFrame:
    """The k nearest classes of each query row (q, vec), all rows against query blocks."""
    spark = classes.sparkSession
    out = None
    count = queries.count()
    parts = -(-count // block)
    for i in range(parts):
        some = queries.where(F.pmod(F.xxhash64("q"), F.lit(parts)) == i).select("q", "vec").toPandas()
        if some.empty:
            continue
        shared = spark.sparkContext.broadcast(  # about ``block`` vectors
            (some["q"].to_numpy(), _stack(some["vec"], dtype))
        )

        def scan(frames: Iterable[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            ids, vectors = shared.value
            for df in frames:
                if df.empty:
                    continue
                mid, h = df["mid"].to_numpy(), df["h"].to_numpy()
                scores = vectors @ _stack(df["vec"], dtype).T
                for q, row in zip(ids, scores):
                    at = _best(row, mid, k)
                    yield pd.DataFrame({"q": q, "h": h[at], "mid": mid[at], "score": row[at]})

        part = classes.select("h", "mid", "vec").mapInPandas(scan, FOUND)
        w = Window.partitionBy("q").orderBy(F.desc("score"), "mid")
        part = part.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).drop("r")
        out = part if out is None else out.union(part)
    return out if out is not None else spark.createDataFrame([], FOUND)


def forest_nearest(
    classes: DataFrame, forest: Forest, n: int, dtype: str, k: int, shard_rows: int
) -> DataFrame:
    """The k nearest classes found for each asking class; ``short`` marks too few candidates.

    ``classes`` has h, mid (least id), vec and asks. An array is cut into shards by tree and
    leading bits, the large ones further by hash, with as many blocks of queries; levels
    and best rows of shards add up to those of the whole array.
    """
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(vars(forest))  # trees x BITS planes, fixed
    trees, floor = len(forest.planes), forest.floor

    def hashed(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = Forest(**shared.value)
        for df in frames:
            if df.empty:
                continue
            vectors = _stack(df["vec"], dtype)
            asks = df["asks"].to_numpy(bool)
            for t in range(trees):
                for query in (False, True):
                    rows = df[asks] if query else df
                    if len(rows):
                        keys = f.keys(vectors[asks] if query else vectors, t, query)
                        yield pd.DataFrame({
                            "tree": t, "lead": keys >> (BITS - floor), "query": query, "key": keys,
                            "h": rows["h"].to_numpy(), "mid": rows["mid"].to_numpy(),
                            "vec": rows["vec"].to_numpy(),
                        })

    rows = classes.mapInPandas(
        hashed, "tree int, lead long, query boolean, key long, h long, mid long, vec binary"
    )
    # At most trees * 2^floor buckets, floor <= 10.
    sizes = rows.groupBy("tree", "lead").agg(
        F.sum(F.when(F.col("query"), 0).otherwise(1)).alias("n"),
        F.sum(F.when(F.col("query"), 1).otherwise(0)).alias("asked"),
    ).collect()
    cut = {(r.tree, r.lead): (-(-r.n // shard_rows), -(-r.asked // shard_rows)) for r in sizes}
    big = {k: v for k, v in cut.items() if v[0] > 1 or v[1] > 1}

    def deal(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for (tree, lead), part in df.groupby(["tree", "lead"], sort=False):
                a, b = big.get((tree, lead), (1, 1))
                dice = (part["h"].to_numpy().view(np.uint64) >> np.uint64(7)).astype(np.int64)
                is_query = part["query"].to_numpy(bool)
                for side in range(max(a, b, 1)):
                    if side < max(b, 1) and (~is_query).any():  # rows meet every block of queries
                        one = part[~is_query]
                        yield one.assign(row_block=dice[~is_query] % max(a, 1), ask_block=side)
                    if side < max(a, 1) and is_query.any():
                        one = part[is_query]
                        yield one.assign(row_block=side, ask_block=dice[is_query] % max(b, 1))

    dealt = rows.mapInPandas(
        deal, "tree int, lead long, query boolean, key long, h long, mid long, vec binary, "
        "row_block long, ask_block long",
    )

    def shard(df: pd.DataFrame) -> pd.DataFrame:
        index, asked = df[~df["query"]].sort_values("key", kind="stable"), df[df["query"]]
        if asked.empty or index.empty:
            return pd.DataFrame(columns=["q", "counts", "h", "mid", "level", "score"], dtype=object)
        keys, h, mid = (index[c].to_numpy() for c in ("key", "h", "mid"))
        vectors = _stack(index["vec"], dtype)
        out = []
        for a in range(0, len(asked), 64):
            some = asked.iloc[a : a + 64]
            scores = _stack(some["vec"], dtype) @ vectors.T
            for q, key, row in zip(some["h"], some["key"], scores):
                counts, at, level = descend_and_ascend(keys, key, row, mid, floor, k)
                out.append((q, counts, h[at], mid[at], level, row[at]))
        return pd.DataFrame(out, columns=["q", "counts", "h", "mid", "level", "score"])

    shards = dealt.groupBy("tree", "lead", "row_block", "ask_block").applyInPandas(
        shard, "q long, counts array<long>, h array<long>, mid array<long>, level array<long>, "
        "score array<double>",
    )
    goal = min(forest.fraction * n, float(trees * n))

    def ascend(df: pd.DataFrame) -> pd.DataFrame:
        """All trees give up one bit at a time until the candidates are enough."""
        counts = np.sum(np.stack(df["counts"].to_numpy()), axis=0)
        enough = np.flatnonzero(counts[floor:] >= goal)
        level = floor + int(enough.max()) if len(enough) else floor
        h, mid, at, score = (np.concatenate(df[c].to_numpy()) for c in ("h", "mid", "level", "score"))
        keep = at >= level
        h, mid, score = h[keep], mid[keep], score[keep]
        _, first = np.unique(h, return_index=True)
        h, mid, score = h[first], mid[first], score[first]
        best = _best(score, mid, k)
        short = len(h) < min(k, n) or (floor > 0 and counts[floor] < goal)
        return pd.DataFrame({
            "q": df["q"].iloc[0], "h": h[best], "mid": mid[best], "score": score[best], "short": short,
        })

    return shards.groupBy("q").applyInPandas(ascend, FOUND + ", short boolean")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 20,
    trees: int = 16,
    recall: float = 0.95,
    sample_rows: int = 4096,
    shard_rows: int = 8192,
    seed: int = 11,
) -> DataFrame:
    """The ``k`` nearest other rows of each query row: query_id, rank, vec_id, score.

    Nearness is the inner product in double precision, ties go to the smaller id; fewer
    candidates than ``k`` are all returned. Rows whose id or vector is null, and vectors
    that are empty, zero or hold a null or non-finite component, take no part. Only vectors
    of one length are compared. Rows with equal id and vector are one row, and rows with
    the query's id are never its neighbours. Other columns are ignored; an empty table
    gives no rows.

    Every row is indexed; equal vectors share one entry (with their ``k`` + 1 least ids, no
    other of them can rank). The forest is fitted on a sample of ``sample_rows`` vectors;
    queries that meet too few candidates are answered by exact search in blocks.
    """
    spark = vectors.sparkSession
    element = vectors.schema[vector_column].dataType.elementType.simpleString()
    dtype = "<f4" if element == "float" else "<f8"
    clean = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where("id IS NOT NULL AND size(v) > 0").where(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    ).withColumn("dim", F.size("v")).withColumn("h", F.xxhash64("v"))

    def packed(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            df["vec"] = [np.asarray(v, dtype).tobytes() for v in df.pop("v")]
            yield df[["id", "h", "dim", "asks", "vec"]]

    rows = stored(
        clean.select("id", "h", "dim", "asks", "v")
        .mapInPandas(packed, "id long, h long, dim int, asks boolean, vec binary"), "vectors",
    )
    w = Window.partitionBy("h").orderBy("id")
    members = stored(
        rows.select("id", "h").distinct().withColumn("r", F.row_number().over(w))
        .where(F.col("r") <= k + 1).groupBy("h").agg(F.sort_array(F.collect_list("id")).alias("ids")),
        "vector-members",
    )
    classes = stored(
        rows.groupBy("h", "dim").agg(
            F.first("vec").alias("vec"), F.min("id").alias("mid"), F.max("asks").alias("asks")
        ), "vector-classes",
    )
    answers = None
    for dim, n, asked in classes.groupBy("dim").agg(
        F.count(F.lit(1)), F.count(F.when(F.col("asks"), 1))
    ).collect():  # one row for each length of vectors
        if not asked:
            continue
        own = classes.where(F.col("dim") == dim).select("h", "mid", "vec", "asks")
        some = own.orderBy(F.xxhash64("h")).limit(sample_rows).select("vec").toPandas()
        sample = _stack(some["vec"], dtype)

        def longest(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            most = max((np.linalg.norm(_stack(df["vec"], dtype), axis=1).max() for df in frames if len(df)), default=0.0)
            yield pd.DataFrame({"norm": [most]})

        norm = own.select("vec").mapInPandas(longest, "norm double").agg(F.max("norm")).first()[0]
        forest = fit(sample, norm, trees=trees, k=k, recall=recall, seed=seed)
        found = stored(forest_nearest(own, forest, n, dtype, k + 1, shard_rows), "neighbours")
        good = found.where("NOT short").drop("short")
        asking = own.where("asks").select(F.col("h").alias("q"), "vec")
        asking = stored(asking.join(good.select("q").distinct(), "q", "left_anti"), "asked-again")
        part = good.union(exact_nearest(own, asking, dtype, k + 1))
        answers = part if answers is None else answers.union(part)
    if answers is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    near = (
        answers.join(members, "h").select("q", "score", F.explode("ids").alias("vec_id"))
        .withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")))
        .where(F.col("r") <= k + 1).select("q", "score", "vec_id")
    )
    asks = rows.where("asks").select(F.col("id").alias("query_id"), F.col("h").alias("q")).distinct()
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return (
        asks.join(stored(near, "near"), "q").where("query_id != vec_id")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
