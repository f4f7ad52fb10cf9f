"""Hard negatives within score windows, by shared lists of anchor clusters (MAXIMUS-style)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventflow.llm.common import stored

SHARD_BYTES = 1 << 22  # of vectors in a shard of candidates
BLOCK_ROWS = 4096  # anchors of a block, about
STEP = 1024  # candidates scored at once on a walk
DEMANDS = 2048  # searches walked at once
MOST_CLUSTERS = 1024
FIT_ROWS = 16_384  # anchors that clusters are fitted on
LOW, HIGH = -(1 << 63), (1 << 63) - 1
BLOB = "n int, ids binary, has_id binary, labels binary, vectors binary"


def to_matrix(column: pa.Array, dim: int | None = None) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    wide = int(sizes.max()) if len(sizes) else 0
    dim = max(wide, dim or 0)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim))
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, as whole numbers in (finite) double precision."""
    most = np.finfo(np.float64).max
    return np.floor(scale * np.clip(vectors, -most / scale, most / scale))


def products(a: np.ndarray, b: np.ndarray, safe: bool) -> np.ndarray:
    """Inner products of whole numbers, exact; they saturate at the limits of a long."""
    if safe:
        return (a @ b.T).astype(np.int64)
    ints = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    exact = ints(a).dot(ints(b).T)
    return np.array([[min(max(int(x), LOW), HIGH) for x in row] for row in exact], np.int64).reshape(len(a), len(b))


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and norms; zero rows stay zero."""
    most = np.abs(vectors).max(1, initial=0.0)
    part = vectors / np.where(most > 0, most, 1.0)[:, None]  # no overflow in the squares
    norm = np.linalg.norm(part, axis=1)
    with np.errstate(over="ignore"):
        return part / np.where(norm > 0, norm, 1.0)[:, None], most * norm


def angles(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(norm, angle to a unit vector) of each row; zero rows stand at a right angle."""
    unit, norm = directions(vectors)
    return norm, np.arccos(np.clip(unit @ centre, -1.0, 1.0))


def keep_best(search: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each search: highest score first, ties to the smaller id."""
    order = np.lexsort((ident, -score, search))
    own = search[order]
    first = np.flatnonzero(np.diff(own, prepend=-1))
    rank = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
    return order[rank < k]


def walk(
    anchors: dict, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, pool: dict, centres: np.ndarray,
    *, same: bool, k: int, scale: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(search, candidate, score) of the k best of each search in one shard of candidates.

    Search i belongs to the anchor in row ``rows[i]`` and takes candidates of the same (or
    another) label with lo[i] <= score <= hi[i]. For each cluster of anchors the shard is
    sorted once by |x| cos(max(0, angle(x, centre) - widest angle of a member)), which
    times |anchor| bounds every member's score; a search walks that list until the bound
    of the next candidate is under its k-th best, or under lo: no later one can enter.
    """
    dim = max(anchors["vectors"].shape[1], pool["vectors"].shape[1], centres.shape[1])
    wide = lambda m: np.pad(m, ((0, 0), (0, dim - m.shape[1])))
    a, x, c = wide(whole(anchors["vectors"], scale)), wide(whole(pool["vectors"], scale)), wide(centres)
    top = [float(np.abs(m).max(initial=0.0)) for m in (a, x)]
    safe = top[0] * top[1] * max(dim, 1) < 2.0**53
    out = [np.zeros((3, 0), np.int64)]
    for cluster in np.unique(anchors["cluster"]):
        member = anchors["cluster"] == cluster
        own = np.flatnonzero(member[rows])
        if not len(own):
            continue
        length, turn = angles(a, c[cluster])
        widest = turn[member & (length > 0)].max(initial=0.0)
        norm, away = angles(x, c[cluster])
        reach = norm * np.cos(np.maximum(0.0, away - widest - 1e-7))
        slack = 1e-7 * norm.max(initial=0.0)  # rounding of angles and norms
        order = np.argsort(-reach, kind="stable")
        for at in range(0, len(own), DEMANDS):
            alive = own[at : at + DEMANDS]
            least = lo.copy()  # a score under it cannot enter
            best = np.zeros((3, 0), np.int64)
            for begin in range(0, len(order), STEP):
                if safe:
                    bound = length[rows[alive]] * (reach[order[begin]] + slack) + 1.0
                    alive = alive[bound >= least[alive]]
                if not len(alive):
                    break
                some = order[begin : begin + STEP]
                need, which = np.unique(rows[alive], return_inverse=True)
                score = products(a[need], x[some], safe)
                fit = (anchors["labels"][need][:, None] == pool["labels"][some]) == same
                fit &= ~((anchors["ids"][need][:, None] == pool["ids"][some]) & pool["has_id"][some])
                score, fit = score[which], fit[which]
                fit &= (score >= least[alive][:, None]) & (score <= hi[alive][:, None])
                i, j = np.nonzero(fit)
                if not len(i):
                    continue
                best = np.concatenate([best, np.stack([alive[i], some[j], score[i, j]])], axis=1)
                ident = np.where(pool["has_id"][best[1]], pool["ids"][best[1]], HIGH)
                best = best[:, keep_best(best[0], best[2], ident, k)]
                count = np.bincount(best[0], minlength=len(rows))
                last = np.full(len(rows), HIGH)
                np.minimum.at(last, best[0], best[2])
                full = count >= k
                least[full] = np.maximum(least[full], last[full])
            out.append(best)
    found = np.concatenate(out, axis=1)
    return found[0], found[1], found[2]


def fit_centres(vectors: np.ndarray, clusters: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of directions by spherical k-means; zero vectors are left out."""
    unit, norm = directions(vectors)
    unit = unit[norm > 0]
    if not len(unit):
        return np.eye(1, max(1, vectors.shape[1]))
    rng = np.random.default_rng(seed)
    centres = unit[rng.choice(len(unit), min(clusters, len(unit)), replace=False)]
    for _ in range(rounds):
        near = (unit @ centres.T).argmax(1)
        total = np.zeros_like(centres)
        np.add.at(total, near, unit)
        size = np.linalg.norm(total, axis=1)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1e-300)[:, None], centres)
    return centres


def packed(rows: pa.Table) -> dict:
    ids = rows.column("id").combine_chunks()
    return {
        "n": len(ids), "ids": pc.fill_null(ids, 0).to_numpy().tobytes(),
        "has_id": ids.is_valid().to_numpy(zero_copy_only=False).tobytes(),
        "labels": rows.column("label").to_numpy().astype(np.int64).tobytes(),
        "vectors": to_matrix(rows.column("v")).tobytes(),
    }


def unpacked(row: dict) -> dict:
    n = row["n"]
    return {
        "ids": np.frombuffer(row["ids"], np.int64), "has_id": np.frombuffer(row["has_id"], bool),
        "labels": np.frombuffer(row["labels"], np.int64),
        "vectors": np.frombuffer(row["vectors"], np.float64).reshape(n, -1),
    }


def blobs(df: DataFrame, name: str, more: tuple[str, ...] = ()) -> DataFrame:
    """One row for each partition of rows: its arrays, under its number ``name``."""

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        out = {name: TaskContext.get().partitionId(), **packed(rows)}
        out |= {c: rows.column(c).to_numpy().astype(np.int64).tobytes() for c in more}
        types = {name: pa.int32(), "n": pa.int32()}
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], types.get(c, pa.binary())) for c, v in out.items()], names=list(out)
        )

    extra = "".join(f", {c} binary" for c in more)
    return stored(df.mapInArrow(gather, f"{name} int, {BLOB}{extra}"), f"{name}s")


def window(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest whole s with low * score <= 100 * s <= high * score."""
    q, r = np.divmod(score, 100)
    return low * q - (-low * r) // 100, high * q + (high * r) // 100


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    label: Column | None = None,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    anchors_per_cluster: int = 32,
    seed: int = 13,
) -> DataFrame:
    """Hard negatives of each anchor and positive: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    Components are floor(``scale`` * x); a score is the whole-number inner product, exact (it
    saturates at the limits of a long). An anchor's positives are its ``positives`` highest
    other rows of the same label, its negatives for a positive the ``negatives`` highest rows
    of another label with low * positive_score <= 100 * score <= high * positive_score; ties
    go to the smaller id, a null id last.

    Rows whose label or vector is null, or whose vector holds a null or non-finite component,
    take no part; zero and empty vectors score 0. Shorter vectors count as filled up with
    zeros. A row with a null id is a candidate, never an anchor. Rows of the anchor's id are
    not its candidates; repeated anchors give repeated results, repeated candidates are
    ranked each. Labels are integral. Other columns are ignored; without anchors there are no rows.

    Candidates are dealt evenly into shards, anchors into blocks sorted by cluster; each pair
    of shard and block meets in one task, as two binary rows, and gives the best of its shard
    (``walk``). Clusters are fitted on at most 16,384 anchors; results do not depend on them.
    """
    spark = vectors.sparkSession
    found = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = stored(
        vectors.select(
            F.col(id_column).cast("long").alias("id"),
            (F.col("label") if label is None else label).cast("long").alias("label"),
            F.col(vector_column).cast("array<double>").alias("v"),
            F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        ).where("label IS NOT NULL AND v IS NOT NULL").where(
            F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        ), "candidates",
    )
    n, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    asking = rows.where("asks AND id IS NOT NULL")
    asked = asking.count()
    if not asked:
        return spark.createDataFrame([], found)
    shards = blobs(
        rows.select("id", "label", "v").repartition(max(1, -(-n * max(dim, 1) * 8 // SHARD_BYTES))), "shard"
    )
    some = asking.orderBy(F.xxhash64("id", "v")).limit(FIT_ROWS).select("v").toArrow()
    centres = fit_centres(
        whole(to_matrix(some.column("v")), scale),
        min(MOST_CLUSTERS, -(-asked // anchors_per_cluster)), seed,
    )

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = whole(to_matrix(batch.column("v"), centres.shape[1]), scale)[:, : centres.shape[1]]
            near = (at @ centres.T).argmax(1) if len(at) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near.astype(np.int32))], names=[*batch.schema.names, "cluster"]
            )

    clustered = stored(
        asking.select("id", "label", "v").mapInArrow(
            assign, "id long, label long, v array<double>, cluster int"
        ).withColumn("place", F.monotonically_increasing_id()), "anchors",
    )
    blocks = blobs(
        clustered.repartitionByRange(-(-asked // BLOCK_ROWS), "cluster", "place").sortWithinPartitions("cluster"),
        "block", ("cluster",),
    )
    last_shard, last_block = (t.agg(F.max(c)).first()[0] for t, c in ((shards, "shard"), (blocks, "block")))

    def met(asks: DataFrame, search, schema: str) -> DataFrame:
        """Every shard with every block: the anchors against all rows, in blocks."""
        left = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last_block))))
        right = asks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(last_shard))))
        return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(search, schema)

    near = "block int, row int, anchor_id long, other_id long, score long"

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("block", pa.int32()), ("row", pa.int32()), *((c, pa.int64()) for c in ("anchor_id", "other_id", "score"))])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ask = right.to_pylist()[0]
        pool, own = unpacked(left.to_pylist()[0]), unpacked(ask)
        own["cluster"] = np.frombuffer(ask["cluster"], np.int64)
        every = np.arange(ask["n"])
        i, j, score = walk(
            own, every, np.full(ask["n"], LOW), np.full(ask["n"], HIGH), pool, centres,
            same=True, k=positives, scale=scale,
        )
        return pa.table([
            pa.array(np.full(len(i), ask["block"], np.int32)), pa.array(i.astype(np.int32)),
            pa.array(own["ids"][i]), pa.array(pool["ids"][j], mask=~pool["has_id"][j]), pa.array(score),
        ], schema=schema)

    best = Window.partitionBy("block", "row").orderBy(F.desc("score"), F.asc_nulls_last("other_id"))
    paired = (
        met(blocks, nearest, near).withColumn("p", F.row_number().over(best)).where(F.col("p") <= positives)
    )
    paired = stored(paired, "positives")
    asks = blocks.join(
        paired.groupBy("block").agg(  # at most ``positives`` for each of the block's anchors
            F.collect_list(F.struct("row", "p", "score", "other_id")).alias("pairs")
        ), "block",
    )

    def hard(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")
        schema = pa.schema([("block", pa.int32()), ("row", pa.int32()), ("p", pa.int32()), *((c, pa.int64()) for c in names)])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ask = right.to_pylist()[0]
        pool, own = unpacked(left.to_pylist()[0]), unpacked(ask)
        own["cluster"] = np.frombuffer(ask["cluster"], np.int64)
        row, p, ps = (np.array([x[c] for x in ask["pairs"]], np.int64) for c in ("row", "p", "score"))
        other = pa.array([x["other_id"] for x in ask["pairs"]], pa.int64())
        lo, hi = window(ps, low, high)
        i, j, score = walk(own, row, lo, hi, pool, centres, same=False, k=negatives, scale=scale)
        return pa.table([
            pa.array(np.full(len(i), ask["block"], np.int32)), pa.array(row[i].astype(np.int32)),
            pa.array(p[i].astype(np.int32)), pa.array(own["ids"][row[i]]), other.take(pa.array(i)),
            pa.array(pool["ids"][j], mask=~pool["has_id"][j]), pa.array(ps[i]), pa.array(score),
        ], schema=schema)

    mined = met(
        asks, hard, "block int, row int, p int, anchor_id long, positive_id long, negative_id long, "
        "positive_score long, negative_score long",
    )
    hardest = Window.partitionBy("block", "row", "p").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    return (
        mined.withColumn("rank", F.row_number().over(hardest)).where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
