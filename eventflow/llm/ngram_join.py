"""Set-similarity self-join on word shingles by rare-first prefix filtering."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import released, row_key, stored, task_partitions, utf8_column
from eventflow.llm.components import components
from eventflow.llm.hashing import WordHasher, fold_ascii, shingles, spaces

SLOTS = 1 << 20  # counters of the shingle statistics, a fixed size
BLOCK = 1 << 14
HOT_RUN = 1024  # rows above the mean from which a shingle's rows are dealt over several tasks
RARE, LEVELS = -1, 16
CROSS_PER_ROW = 16  # pairs of a run that may be left for each row before all are looked at
STAR_ROUNDS = 6
BROADCAST_KEYS = 400_000  # row keys sent to all tasks at most

POSTING = "token long, salt int, nid long, size int, pos int, doc_id long"
MEMBER = POSTING + ", f_nid long, f_size int, f_pos int, p_nid long, p_size int, p_pos int"


def _shingle_batches(
    batches: Iterable[pa.RecordBatch], column: str, k: int
) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    hasher = WordHasher(spaces(), fold_ascii())
    for batch in batches:
        data, offsets = utf8_column(batch.column(column))
        for row, words, bounds in hasher(data, offsets):
            yield (batch, row, *shingles(words, bounds, k))


def shingle_counts(docs: DataFrame, k: int) -> np.ndarray:
    """Occurrences of all shingles of all documents, added up in ``SLOTS`` counters.

    Tasks send compressed blocks of counters; two rounds of streaming sums leave one row
    for each block, so neither a task nor the driver holds more than the fixed table.
    """
    schema = "block int, salt int, counts binary"

    def pack(block: np.ndarray) -> bytes:
        return pa.compress(block.tobytes(), codec="zstd", asbytes=True)

    def rows(counts: np.ndarray, salt: int) -> pa.RecordBatch:
        used = [b for b in range(SLOTS // BLOCK) if counts[b * BLOCK : (b + 1) * BLOCK].any()]
        blobs = [pack(counts[b * BLOCK : (b + 1) * BLOCK]) for b in used]
        return pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([salt] * len(used), pa.int32()),
             pa.array(blobs, pa.binary())], names=["block", "salt", "counts"],
        )

    @released
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts = np.zeros(SLOTS, np.int64)
        for _, _, h, _ in _shingle_batches(batches, "text", k):
            counts += np.bincount((h & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
        yield rows(counts, TaskContext.get().partitionId() % LEVELS)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, blob in zip(batch.column("block").to_pylist(), batch.column("counts")):
                raw = pa.decompress(blob.as_py(), BLOCK * 8, codec="zstd", asbytes=True)
                counts[b] = counts.get(b, 0) + np.frombuffer(raw, np.int64)
        blobs = [pack(c) for c in counts.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int32()), pa.array([0] * len(counts), pa.int32()),
             pa.array(blobs, pa.binary())], names=["block", "salt", "counts"],
        )

    n = task_partitions(docs.sparkSession)
    parts = (
        docs.select("text").mapInArrow(count, schema)
        .repartition(n, "block", "salt").mapInArrow(add, schema)
        .repartition(min(n, SLOTS // BLOCK), "block").mapInArrow(add, schema)
    )
    total = np.zeros(SLOTS, np.int64)
    for r in parts.select("block", "counts").collect():  # SLOTS counters at most
        raw = pa.decompress(bytes(r.counts), BLOCK * 8, codec="zstd", asbytes=True)
        total[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(raw, np.int64)
    return np.minimum(total, (1 << 31) - 1).astype(np.int32)


def set_digests(docs: DataFrame, k: int) -> DataFrame:
    """(nid, doc_id, n_shingles, digest) of each row; equal shingle sets have equal digests."""
    import hashlib

    @released
    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, h, bounds in _shingle_batches(batches, "text", k):
            rows = len(bounds) - 1
            sizes, digests = np.zeros(rows, np.int32), []
            for i in range(rows):
                own = np.unique(h[bounds[i] : bounds[i + 1]])
                sizes[i] = len(own)
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("nid").slice(row, rows), batch.column("doc_id").slice(row, rows),
                 pa.array(sizes), pa.array(digests, pa.binary())],
                names=["nid", "doc_id", "n_shingles", "digest"],
            )

    return docs.select("doc_id", "nid", "text").mapInArrow(
        digest, "nid long, doc_id long, n_shingles int, digest binary"
    )


def prefix_length(n: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Any set with ``percent`` or more in common shares one of so many rarest shingles."""
    return n - (percent * n + 99) // 100 + 1


def _postings(docs: DataFrame, counts: np.ndarray, k: int, percent: int) -> DataFrame:
    """Prefix shingles of each row, rarest first, and one row with its set size (salt null)."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # SLOTS * 4 bytes, always
    mean = float(counts.mean())

    @released
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = shared.value
        for batch, row, h, bounds in _shingle_batches(batches, "text", k):
            rows = len(bounds) - 1
            nids = batch.column("nid").slice(row, rows).to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").slice(row, rows)
            sizes, tokens, places = np.zeros(rows, np.int32), [], []
            for i in range(rows):
                own = np.unique(h[bounds[i] : bounds[i + 1]])
                sizes[i] = len(own)
                if len(own):
                    often = seen[(own & np.uint64(SLOTS - 1)).astype(np.int64)]
                    first = np.argsort(often, kind="stable")[: prefix_length(len(own), percent)]
                    tokens.append(own[first])
                    places.append(np.arange(len(first), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nids), pa.nulls(rows, pa.int32()), pa.array(nids), pa.array(sizes),
                 pa.nulls(rows, pa.int32()), ids],
                names=["token", "salt", "nid", "size", "pos", "doc_id"],
            )
            if tokens:
                token, pos = np.concatenate(tokens), np.concatenate(places)
                per = np.diff(np.append(np.flatnonzero(pos == 0), len(pos)))
                has = sizes > 0
                nid, size = np.repeat(nids[has], per), np.repeat(sizes[has], per)
                over = seen[(token & np.uint64(SLOTS - 1)).astype(np.int64)] - mean
                deal = np.maximum(over // HOT_RUN, 0).astype(np.uint64) + np.uint64(1)
                spread = ((nid.view(np.uint64) >> np.uint64(20)) % deal).astype(np.int32)
                salt = np.where(deal > 1, spread, RARE).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token.view(np.int64)), pa.array(salt), pa.array(nid),
                     pa.array(size), pa.array(pos), pa.nulls(len(token), pa.int64())],
                    names=["token", "salt", "nid", "size", "pos", "doc_id"],
                )

    return docs.select("doc_id", "nid", "text").mapInArrow(emit, POSTING)


def _members(postings: DataFrame) -> DataFrame:
    """Rows whose shingle another row has too, with the first and the previous row of the run.

    A run has the rows of one shingle (or one part of a hot one), those first that hold it
    earliest in their order. Runs stream by; two rows are held. Size rows pass through.
    """
    out = pa.schema(
        [("token", pa.int64()), ("salt", pa.int32()), ("nid", pa.int64()), ("size", pa.int32()),
         ("pos", pa.int32()), ("doc_id", pa.int64())]
        + [(f"{x}_{c}", t) for x in "fp" for c, t in (("nid", pa.int64()), ("size", pa.int32()), ("pos", pa.int32()))]
    )

    @released
    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, lead = None, 0, None

        def runs(table: pa.Table, before: bool, final: bool) -> pa.RecordBatch:
            """The last row waits for its successor, the first may only be a predecessor."""
            nonlocal lead
            token, salt, nid, size, pos = (
                table.column(c).to_numpy() for c in ("token", "salt", "nid", "size", "pos")
            )
            same = np.zeros(len(token) + 1, bool)
            same[1:-1] = (token[1:] == token[:-1]) & (salt[1:] == salt[:-1])
            # The run's first row; that of the run at the start may have gone by before.
            start = np.maximum.accumulate(np.where(same[:-1], 0, np.arange(len(token))))
            own = np.stack([nid, size.astype(np.int64), pos.astype(np.int64)])
            heads = own[:, start]
            if before:
                heads[:, start == 0] = lead[:, None]
            last = len(token) if final else len(token) - 1
            lead = heads[:, max(len(token) - 2, 0)].copy()
            keep = np.zeros(len(token), bool)
            first = 1 if before else 0
            keep[first:last] = (same[:-1] | same[1:] | (salt >= 0))[first:last]
            at = np.flatnonzero(keep)
            previous, none = own[:, np.maximum(at - 1, 0)], ~same[at]
            arrays = [pa.array(c[at]) for c in (token, salt, nid, size, pos)]
            arrays += [pa.nulls(len(at), pa.int64())]
            arrays += [pa.array(c, t, mask=none) for c, t in zip(heads[:, at], (pa.int64(), pa.int32(), pa.int32()))]
            arrays += [pa.array(c, t, mask=none) for c, t in zip(previous, (pa.int64(), pa.int32(), pa.int32()))]
            return pa.RecordBatch.from_arrays(arrays, schema=out)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            alone = table.filter(pc.is_null(table.column("salt"))).combine_chunks()
            if len(alone):
                kept = [alone.column(i).combine_chunks() for i in range(6)]
                kept += [pa.nulls(len(alone), f.type) for f in list(out)[6:]]
                yield pa.RecordBatch.from_arrays(kept, schema=out)
            table = table.filter(pc.is_valid(table.column("salt")))
            if held is not None:
                table = pa.concat_tables([held, table])
            token, salt, nid = (table.column(c).to_numpy() for c in ("token", "salt", "nid"))
            again = (token[1:] == token[:-1]) & (salt[1:] == salt[:-1]) & (nid[1:] == nid[:-1])
            if again.any():  # repeated rows
                table = table.filter(pa.array(np.append(True, ~again)))
            if len(table) >= 2:
                yield runs(table, waiting == 2, False)
                held, waiting = table.slice(len(table) - 2), 2
            elif len(table):
                held, waiting = table, 1
        if waiting:
            yield runs(held, waiting == 2, True)

    n = task_partitions(postings.sparkSession)
    return (
        postings.repartition(n, "token", "salt")
        .sortWithinPartitions("token", "salt", "pos", "nid")
        .mapInArrow(stream, MEMBER)
    )


def _passes(percent: int):
    """Length and positional filter of a pair that shares a shingle at two positions."""
    size, other = F.col("size").cast("long"), F.col("o_size").cast("long")
    rest = F.least(size - F.col("pos"), other - F.col("o_pos"))
    return (
        (F.lit(percent) * F.greatest(size, other) <= 100 * F.least(size, other))
        & ((100 + percent) * rest >= percent * (size + other))
        & (F.col("nid") != F.col("o_nid"))
    )


def _pairs(df: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a < b) of rows with columns nid, size, pos and o_nid, o_size, o_pos."""
    return (
        df.where(_passes(percent))
        .select(F.least("nid", "o_nid").alias("a"), F.greatest("nid", "o_nid").alias("b"))
        .distinct()
    )


def may_reach(x: np.ndarray, y: np.ndarray, need: int, depth: int = 3) -> bool:
    """Suffix filter: can two sorted sets share ``need`` elements?

    Splits both at the middle element of the larger set, level by level; what can be
    shared in all parts together bounds the overlap from above.
    """

    def most(x: np.ndarray, y: np.ndarray, depth: int) -> int:
        bound = min(len(x), len(y))
        if not depth or bound < 8:
            return bound
        pivot = (x if len(x) > len(y) else y)[max(len(x), len(y)) // 2]
        i, j = np.searchsorted(x, pivot), np.searchsorted(y, pivot)
        return most(x[:i], y[:j], depth - 1) + most(x[i:], y[j:], depth - 1)

    return most(x, y, depth) >= need


def _sent_if_few(keys: DataFrame) -> DataFrame:
    """Row keys to be broadcast if there are ``BROADCAST_KEYS`` at most, else joined."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets have a Jaccard similarity of ``percent`` or more."""
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("nid")).distinct(), "wanted")
    wanted = _sent_if_few(wanted)
    texts = docs.select("nid", "text").join(wanted, "nid", "left_semi")
    texts = stored(texts.dropDuplicates(["nid"]), "join-texts")

    @released
    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(spaces(), fold_ascii())

        def sets(batch: pa.RecordBatch, column: str) -> Iterator[np.ndarray]:
            data, offsets = utf8_column(batch.column(column))
            for _, words, bounds in hasher(data, offsets):
                h, at = shingles(words, bounds, k)
                for i in range(len(at) - 1):
                    yield np.unique(h[at[i] : at[i + 1]])

        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                keep = []
                for x, y in zip(sets(batch, "text_a"), sets(batch, "text_b"), strict=True):
                    need = -(-percent * (len(x) + len(y)) // (100 + percent))
                    good = len(x) and len(y) and may_reach(x, y, need)
                    if good:
                        common = len(np.intersect1d(x, y, assume_unique=True))
                        good = 100 * common >= percent * (len(x) + len(y) - common)
                    keep.append(bool(good))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"]
                )

    left = texts.select(F.col("nid").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("nid").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(check, "a long, b long")


def _cross_pairs(members: DataFrame, percent: int) -> DataFrame:
    """All pairs of a run with different labels that pass the filters.

    Runs stream by sorted by size; only rows a later row can still reach by length are
    held. Runs of one label never get here.
    """

    @released
    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, kept = None, np.zeros((0, 4), np.int64)
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in ("token", "nid", "size", "pos", "label")]
            tokens, rows = cols[0], np.stack([c.astype(np.int64) for c in cols[1:]], axis=1)
            cuts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
            for a, b in zip(cuts, [*cuts[1:], len(tokens)]):
                if tokens[a] != token:
                    token, kept = tokens[a], np.zeros((0, 4), np.int64)
                run = np.concatenate([kept, rows[a:b]])
                for i in range(len(kept), len(run)):
                    nid, size, pos, label = run[i]
                    lo = np.searchsorted(run[:i, 1] * 100, percent * size)
                    o = run[lo:i]
                    rest = np.minimum(size - pos, o[:, 1] - o[:, 2])
                    good = (o[:, 3] != label) & (
                        (100 + percent) * rest >= percent * (size + o[:, 1])
                    )
                    if good.any():
                        other = o[good, 0]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.minimum(other, nid)), pa.array(np.maximum(other, nid))],
                            names=["a", "b"],
                        )
                kept = run[np.searchsorted(run[:, 1] * 100, percent * run[-1, 1]) :]

    n = task_partitions(members.sparkSession)
    return (
        members.repartition(n, "token").sortWithinPartitions("token", "size", "nid")
        .mapInArrow(stream, "a long, b long").distinct()
    )


def similar_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    k: int = 4,
    percent: int = 85,
) -> DataFrame:
    """Groups of documents linked by 100 * |A & B| >= ``percent`` * |A | B|.

    A and B are the documents' sets of distinct ``k``-word shingles (A-Z lower-cased,
    words split at spaces and 0x09-0x0D; fewer words give the whole sequence). Returns one
    row per row of ``docs``: ``nid`` (key of the row), doc_id, n_shingles and component_id,
    the least doc_id reachable by links, and ``group`` (a key of the component). Texts that are null, empty or without words have
    no shingle and link with nothing. Equal rows stay apart rows with the same result; a
    null id is never a component_id unless no other id is reachable. Other columns are
    ignored, whatever their names; an empty table gives no rows.

    Rows with equal shingle sets are copies: one of them (the least key) takes part in the
    join, the others are linked to it, so a large group of copies meets others only once.
    Shingles are ordered rarest first by counters over the whole corpus; each row sends the
    prefix any similar set must meet. A run of rows with the same prefix shingle is not
    compared pair by pair: each row first meets the run's first row, which holds the shingle
    earliest, and its predecessor. After the links found are closed to components, runs that
    still hold very many pairs of different components go on with the first row of each
    other component, as long as that finds links. Then all pairs of a run that are in
    different components, pass the length and positional filters and have not been verified
    are verified, so no link between components is lost. Pairs within a component need no
    check.
    """
    base = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"),
        row_key(id_column, text_column).alias("nid"),
    )
    # Rows with equal shingle sets link with each other and with the same other rows:
    # one of them takes part in the join, the others are linked to it.
    sets = stored(set_digests(base, k), "shingle-sets")
    sizes = sets.select("nid", "doc_id", "n_shingles")
    firsts = stored(
        sets.where("n_shingles > 0").groupBy("digest").agg(F.min("nid").alias("first")), "set-firsts"
    )
    copies = (
        sets.join(firsts, "digest").where("nid != first")
        .select(F.col("first").alias("a"), F.col("nid").alias("b")).distinct()
    )
    base = base.join(_sent_if_few(firsts.select(F.col("first").alias("nid"))), "nid", "left_semi")
    counts = shingle_counts(base, k)
    found = stored(_members(_postings(base, counts, k, percent)), "members")
    runs = found.where("salt IS NOT NULL")
    members = runs.select("token", "nid", "size", "pos")
    met = runs.where("p_nid IS NOT NULL")

    def pair(df: DataFrame, other: str) -> DataFrame:
        return df.select(
            "nid", "size", "pos",
            *[F.col(f"{other}_{c}").alias(f"o_{c}") for c in ("nid", "size", "pos")],
        )

    # The first rows of the parts of a hot shingle meet the first of all.
    parts = runs.where("salt >= 0 AND p_nid IS NULL")
    tops = parts.groupBy("token").agg(F.min(F.struct("pos", "nid", "size")).alias("o"))
    tops = parts.join(tops, "token").select(
        "nid", "size", "pos", F.col("o.nid").alias("o_nid"), F.col("o.size").alias("o_size"),
        F.col("o.pos").alias("o_pos"),
    )
    tried = stored(_pairs(pair(met, "f").union(pair(met, "p")).union(tops), percent), "tried")
    links = stored(verified(tried, base, k, percent), "links")
    labels = components(links)
    for turn in range(STAR_ROUNDS + 1):
        named = members.join(labels.withColumnRenamed("node", "nid"), "nid", "left")
        now = named.withColumn("label", F.coalesce("component", "nid")).drop("component")
        now = stored(now, "members")
        first = F.min(F.struct("pos", "nid", "size")).alias("o")
        mixed = stored(
            now.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"), first)
            .groupBy("token").agg(
                F.min(F.struct("o", "label")).alias("top"), F.count(F.lit(1)).alias("labels"),
                ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("left"),
            ).where("labels > 1"), "mixed",
        )
        left, runs_left = mixed.agg(F.sum("left"), F.count(F.lit(1))).first()
        now = now.join(mixed, "token")
        more = None
        if turn < STAR_ROUNDS and (left or 0) > CROSS_PER_ROW * max(runs_left, 1000):
            top = now.select(
                "nid", "size", "pos", F.col("top.o.nid").alias("o_nid"),
                F.col("top.o.size").alias("o_size"), F.col("top.o.pos").alias("o_pos"),
            ).where("label != top.label")
            more, tried = _new_links(_pairs(top, percent), tried, base, k, percent)
        if more is None:  # all that is left
            more, tried = _new_links(_cross_pairs(now, percent), tried, base, k, percent)
            if more is not None:
                links = links.union(more)
            break
        links = links.union(more)
        labels = components(links)
    return _with_least_id(sizes, components(links.union(copies)))


def _new_links(
    pairs: DataFrame, tried: DataFrame, base: DataFrame, k: int, percent: int
) -> tuple[DataFrame | None, DataFrame]:
    """The links among pairs not tried before, None if there is none; all pairs tried."""
    pairs = stored(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
    if pairs.isEmpty():
        return None, tried
    links = stored(verified(pairs, base, k, percent), "links")
    return (None if links.isEmpty() else links), tried.union(pairs)


def _with_least_id(sizes: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with their group and its least doc_id."""
    nodes = labels.withColumnRenamed("node", "nid")
    least = stored(
        nodes.join(sizes.groupBy("nid").agg(F.min("doc_id").alias("doc_id")), "nid")
        .groupBy("component").agg(F.min("doc_id").alias("component_id")), "least",
    )
    named = nodes.join(least, "component").select("nid", "component", "component_id")
    own = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return sizes.join(named, "nid", "left").select(
        "nid", "doc_id", "n_shingles", F.coalesce("component", "nid").alias("group"),
        own.alias("component_id"),
    )


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """The rows of ``docs`` left when of each group of similar documents one stays.

    That is the one with the least id (then key); null ids come last. Rows with equal id
    and text are one document. Documents without a shingle are no copies of each other.
    """
    groups = stored(similar_groups(docs, id_column, text_column, **options), "groups")
    best = stored(
        groups.groupBy("group").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "nid")).alias("best"),
            F.count(F.lit(1)).alias("n"),
        ).where("n > 1").select("group", F.col("best.nid").alias("stays")), "best",
    )
    gone = stored(
        groups.join(best, "group").where("nid != stays").select(F.col("nid").alias("__nid"))
        .distinct(), "gone",
    )
    keyed = docs.withColumn("__nid", row_key(id_column, text_column))
    kept = keyed.join(_sent_if_few(gone), "__nid", "left_anti")
    equal = stored(
        groups.groupBy(F.col("nid").alias("__nid")).agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("__nid"), "equal-rows",
    )
    if not equal.isEmpty():
        single = kept.join(equal, "__nid", "left_anti")
        kept = single.union(kept.join(equal, "__nid", "left_semi").dropDuplicates(["__nid"]))
    return kept.drop("__nid")
