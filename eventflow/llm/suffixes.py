"""Exact removal of repeated byte strings with a sparse, range-partitioned suffix array.

Every string of ``length`` bytes holds at least one sampled suffix start: the least hash
of its ``HEAD``-byte windows (equal strings sample the same starts). Only suffixes whose
head occurs at least twice can be part of a repeat, so only those are sorted.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import row_key, stored, task_partitions, utf8_column
from eventflow.llm.hashing import CHUNK, SECOND, Powers, byte_codes, mix

HEAD = 32
SMALL = 128  # rows of a head compared by suffix order and left contexts
GROUP_ROWS = 8192  # suffixes of one head sorted in one task; beyond, windows are shuffled


def window_hashes(data: np.ndarray, width: int, powers: Powers, codes: np.ndarray) -> np.ndarray:
    """Hash of each window of ``width`` bytes."""
    n = len(data)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = powers.upto(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(codes[data] * up[:n], out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * down[: n - width + 1])


def least_positions(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost least value of each window of ``width`` values."""
    n = len(values)
    bits = np.uint64(max(int(n).bit_length(), 1))
    low = (np.uint64(1) << bits) - np.uint64(1)
    packed = (values & ~low) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = packed
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return (np.minimum(behind[:m], ahead[width - 1 : width - 1 + m]) & low).astype(np.int64)


def sampled_starts(
    data: np.ndarray, offsets: np.ndarray, length: int, powers: Powers, codes: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, position in the row, head hash) of all sampled suffix starts.

    Texts are taken together in chunks; one over the chunk size goes in overlapping parts.
    """
    width = length - HEAD + 1
    rows, row = len(offsets) - 1, 0
    while row < rows:
        to = int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1
        if to > row:
            part, bounds = data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
            h = window_hashes(part, HEAD, powers, codes)
            if len(h) >= width:
                pos = least_positions(h, width)
                start = np.arange(len(pos))
                own = np.searchsorted(bounds, start, side="right") - 1
                inside = start + length <= bounds[own + 1]
                pos, own = pos[inside], own[inside]
                new = np.append(True, (pos[1:] != pos[:-1])) if len(pos) else np.zeros(0, bool)
                pos, own = pos[new], own[new]
                yield row + own, pos - bounds[own], h[pos]
            row = to
            continue
        text, last = data[offsets[row] : offsets[row + 1]], -1
        for a in range(0, max(len(text) - length, 0) + 1, CHUNK - length):
            h = window_hashes(text[a : a + CHUNK], HEAD, powers, codes)
            if len(h) < width:
                break
            pos = np.unique(least_positions(h, width))
            new = pos + a > last
            if new.any():
                last = int(pos[-1]) + a
                yield np.full(new.sum(), row), pos[new] + a, h[pos[new]]
        row += 1


def multikey_order(keys: np.ndarray, group: np.ndarray | None = None) -> np.ndarray:
    """Order of fixed-width byte strings by multikey quicksort, eight bytes at a time.

    ``keys`` holds them as rows of big-endian words, ``group`` (ascending) the rows to be
    sorted among themselves. Each pass partitions all runs that are still equal by their
    next word; runs of one row are done.
    """
    n = len(keys)
    order = np.arange(n)
    run = np.zeros(n, np.int64) if group is None else np.cumsum(np.append(0, group[1:] != group[:-1]))
    at = order
    for depth in range(keys.shape[1] + 1):
        cut = np.append(True, run[1:] != run[:-1])
        equal = ~(cut & np.append(cut[1:], True))
        at, run = at[equal], run[equal]
        if not len(at) or depth == keys.shape[1]:
            break
        word = keys[order[at], depth]
        by = np.lexsort((word, run))
        order[at] = order[at][by]
        word = word[by]
        run = np.cumsum(np.append(0, (run[1:] != run[:-1]) | (word[1:] != word[:-1])))
    return order


def common_prefix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of rows; bytes as little-endian words."""
    apart = x ^ y
    differ = apart != 0
    first = differ.argmax(axis=1)
    word = apart[np.arange(len(x)), first]
    low = word & (~word + np.uint64(1))  # its lowest set bit
    byte = (np.frexp(low.astype(np.float64))[1] - 1) // 8
    return np.where(differ[np.arange(len(x)), first], first * 8 + byte, x.shape[1] * 8)


def padded(values: list[bytes] | pa.Array, width: int, backward: bool) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as rows of zero-padded words, and their lengths; maybe last byte first."""
    data, offsets = utf8_column(values)
    size = np.diff(offsets)
    columns = -(-width // 8) * 8
    out = np.zeros((len(size), columns), np.uint8)
    if len(data):
        j = np.arange(columns)
        for a in range(0, len(size), 4096):
            n = size[a : a + 4096, None]
            begin = offsets[a : a + 4096][:, None] if len(n) == 4096 else offsets[a:-1][:, None]
            place = begin + n - 1 - j if backward else begin + j
            inside = j < n
            out[a : a + 4096] = np.where(inside, data[np.clip(place, 0, len(data) - 1)], 0)
    return out, size


def repeated_spans(
    left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray,
    group: np.ndarray, length: int,
) -> tuple[np.ndarray, np.ndarray]:
    """How far left and right of each suffix start repeats of ``length`` bytes reach.

    Rows of one ``group`` (ascending) have equal heads. ``left`` holds the ``length - HEAD``
    bytes before each start, last one first, ``right`` the ``length`` bytes from it, both
    padded; ``n_left`` and ``n_right`` say how many of them exist. A string of ``length``
    bytes through the start is a repeat if another row of the group has it at the same
    place. Returns (bytes to the left, bytes to the right), -1 where there is none.

    Rows are put in suffix order. What two rows share to the right is the least common
    prefix of neighbours between them, so only left contexts are compared, for rows ever
    further apart. Groups over ``SMALL`` rows go by hashes of their strings instead.
    """
    order = multikey_order(right.view(">u8").astype(np.uint64), group)
    left, right, group = left[order], right[order], group[order]
    n_left, n_right = n_left[order], n_right[order]
    n, most = len(order), length - HEAD
    lo, hi = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    words, before = right.view("<u8").astype(np.uint64), left.view("<u8").astype(np.uint64)
    lcp = np.zeros(n, np.int64)
    if n > 1:
        shared = np.minimum(common_prefix(words[1:], words[:-1]), np.minimum(n_right[1:], n_right[:-1]))
        lcp[1:] = np.where(group[1:] == group[:-1], shared, 0)
    start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(start, n))
    small = np.repeat(size <= SMALL, size)
    reach = np.full(n, length)
    for apart in range(1, min(SMALL, int(size.max(initial=0)))):
        reach = np.minimum(reach[: n - apart], lcp[apart:])
        able = small[: n - apart] & (reach >= HEAD)
        able &= np.minimum(n_left[: n - apart], n_left[apart:]) + reach >= length
        i = np.flatnonzero(able)
        if not len(i):
            if not (small[: n - apart] & (reach > 0)).any():
                break
            continue
        for a in range(0, len(i), 8192):
            x, y = i[a : a + 8192], i[a : a + 8192] + apart
            l = np.minimum(common_prefix(before[x], before[y]), np.minimum(n_left[x], n_left[y]))
            l = np.minimum(l, most)
            good = l + reach[x] >= length
            for rows in (x[good], y[good]):
                lo[rows] = np.maximum(lo[rows], l[good])
                hi[rows] = np.maximum(hi[rows], reach[x][good])
    for a, m in zip(start[size > SMALL], size[size > SMALL]):
        own = slice(a, a + m)
        near = np.maximum(lcp[own], np.append(lcp[a + 1 : a + m], 0))
        lo[own], hi[own] = _spans_by_hash(left[own], right[own], n_left[own], near, length)
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    return lo[back], hi[back]


def _spans_by_hash(
    left: np.ndarray, right: np.ndarray, n_left: np.ndarray, reach: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """As ``repeated_spans`` for one large group, in time linear in its rows.

    For each number of bytes left of the start the strings are hashed and equal ones
    compared; ``reach`` is the longest right match of a row with any other.
    """
    most = length - HEAD
    lo, hi = np.full(len(left), -1, np.int64), np.full(len(left), -1, np.int64)
    able = np.flatnonzero(reach + n_left >= length)
    if len(able) < 2:
        return lo, hi
    codes, powers = byte_codes(), Powers()
    joined = np.concatenate([left[able, :most][:, ::-1], right[able, :length]], axis=1)
    up, down = powers.upto(joined.shape[1])
    sums = np.zeros((len(able), joined.shape[1] + 1), np.uint64)
    for a in range(0, len(able), 512):
        part = codes[joined[a : a + 512]] * up[: joined.shape[1]]
        np.cumsum(part, axis=1, out=sums[a : a + 512, 1:])
    for o in range(most + 1):
        fits = np.flatnonzero((n_left[able] >= o) & (reach[able] >= length - o))
        if len(fits) < 2:
            continue
        at = most - o
        h = mix((sums[fits, at + length] - sums[fits, at]) * down[at])
        by = np.argsort(h, kind="stable")
        same = h[by][1:] == h[by][:-1]
        if same.any():
            i, j = fits[by][1:][same], fits[by][:-1][same]
            equal = (joined[i, at : at + length] == joined[j, at : at + length]).all(axis=1)
            rows = able[np.unique(np.concatenate([i[equal], j[equal]]))]
            lo[rows] = np.maximum(lo[rows], o)
            hi[rows] = np.maximum(hi[rows], length - o)
    return lo, hi


def _merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of a union of ranges."""
    by = np.argsort(starts, kind="stable")
    starts, ends = starts[by], np.maximum.accumulate(ends[by])
    cut = np.flatnonzero(np.append(True, starts[1:] > ends[:-1]))
    return starts[cut], np.append(ends[cut[1:] - 1], ends[-1])


def repeat_spans(
    rows: DataFrame, first: DataFrame, length: int, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """(key, spans): byte ranges of texts that are covered by repeats.

    ``rows`` (key, text and others) may hold copies; ``first`` has the key of one row of
    each different text, and only for those ranges are found. The rows are joined with all
    their columns, so a later join of the same rows by key can use the same shuffle.
    """
    spark = rows.sparkSession
    n = task_partitions(spark)
    before = length - HEAD

    def sample(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, codes = Powers(), byte_codes()
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = utf8_column(batch.column(1))
            for row, pos, head in sampled_starts(data, offsets, length, powers, codes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(head.view(np.int64)), pa.array(keys[row]), pa.array(pos)],
                    names=["head", "key", "pos"],
                )

    starts = stored(
        rows.select("key", "text").mapInArrow(sample, "head long, key long, pos long"), "suffix-starts"
    )
    heads = stored(
        starts.groupBy("head").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "suffix-heads"
    )
    shared = (
        starts.join(heads, "head").groupBy("key")
        .agg(F.collect_list(F.struct("pos", "head", (F.col("n") > group_rows).alias("hot"))).alias("at"))
    )

    def contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bytes around each start; of a start whose context the text had before, its range."""
        for key_, data, at in _texts(batches):
            first: dict[tuple[bytes, bytes], list[int]] = {}
            for p in sorted(x["pos"] for x in at if not x["hot"]):
                context = data[max(p - before, 0) : p], data[p : p + length]
                first.setdefault(context, []).append(p)
            rows = []
            for (a, b), pos in first.items():
                rows.append((pos[0], a, b, -1))
                if len(pos) > 1 and len(a) + len(b) >= length:
                    rows += [(p - len(a), b"", b[:HEAD], p + len(b)) for p in pos]
            if rows:
                pos, left, right, end = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key_] * len(rows), pa.int64()), pa.array(pos, pa.int64()),
                     pa.array(left, pa.binary()), pa.array(right, pa.binary()),
                     pa.array(end, pa.int64())],
                    names=["key", "pos", "left", "right", "end"],
                )

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Two hashes of each string of ``length`` bytes that holds a start with a hot head."""
        powers, codes = Powers(), byte_codes()
        powers2, codes2 = Powers(SECOND), byte_codes(SECOND)
        for key_, data, at in _texts(batches):
            pos = np.array([x["pos"] for x in at if x["hot"]], np.int64)
            if not len(pos):
                continue
            lo, hi = np.maximum(pos - before, 0), np.minimum(pos, len(data) - length) + 1
            for a, b in zip(*_merge(lo[lo < hi], hi[lo < hi])):
                for c in range(a, b, CHUNK):
                    d = min(c + CHUNK, b)
                    part = np.frombuffer(data[c : d - 1 + length], np.uint8)
                    h = window_hashes(part, length, powers, codes)
                    h2 = window_hashes(part, length, powers2, codes2)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(h2.view(np.int64)),
                         pa.array(np.full(len(h), key_, np.int64)), pa.array(np.arange(c, d))],
                        names=["window", "second", "key", "pos"],
                    )

    marked = rows.join(shared.join(first, "key"), "key")
    found = _light(
        marked.mapInArrow(contexts, "key long, pos long, left binary, right binary, end long"),
        length, n,
    )
    if not heads.where(F.col("n") > group_rows).isEmpty():
        hot = marked.mapInArrow(windows, "window long, second long, key long, pos long")
        found = found.union(_heavy(hot, length))
    return found.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, bytes, list[dict]]]:
    """Each text once; repeated keys follow each other."""
    last = None
    for batch in batches:
        keys, at = batch.column("key").to_pylist(), batch.column("at")
        for key, text, found in zip(keys, batch.column("text"), at):
            if key != last:
                last = key
                yield key, text.as_buffer().to_pybytes(), found.as_py()


def _light(contexts: DataFrame, length: int, n: int) -> DataFrame:
    """Ranges found by sorting suffixes: sampled splitters cut the order of right contexts
    into ranges at head boundaries, so a head's suffixes meet in one range."""
    before = length - HEAD

    def spans(table: pa.Table) -> pa.RecordBatch:
        """Ranges of whole groups of rows in order of their heads."""
        right, n_right = padded(table.column("right"), length, False)
        left, n_left = padded(table.column("left"), before, True)
        heads = right[:, :HEAD].copy().view(np.uint64)
        group = np.cumsum(np.append(0, (heads[1:] != heads[:-1]).any(axis=1)))
        lo, hi = repeated_spans(left, right, n_left, n_right, group, length)
        good = lo >= 0
        pos = table.column("pos").to_numpy()[good]
        key = table.column("key").filter(pa.array(good)).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [key, pa.array(pos - lo[good]), pa.array(pos + hi[good])], names=["key", "start", "end"]
        )

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            known = pc.greater_equal(table.column("end"), 0)
            whole = table.filter(known).combine_chunks()
            if len(whole):
                yield pa.RecordBatch.from_arrays(
                    [whole.column(c).combine_chunks() for c in ("key", "pos", "end")],
                    names=["key", "start", "end"],
                )
            table = table.filter(pc.invert(known))
            table = table if held is None else pa.concat_tables([held, table])
            if not len(table):
                continue
            # The last head may go on in the next batch.
            heads = pc.binary_slice(table.column("right"), 0, HEAD)
            last = pc.index(pc.equal(heads, heads[-1]), True).as_py()
            if last:
                yield spans(table.slice(0, last))
            held = table.slice(last)
        if held is not None and len(held):
            yield spans(held)

    lead = F.substring("right", 1, HEAD)
    ranged = (
        contexts.withColumn("lead", lead).repartitionByRange(n, "lead")
        .sortWithinPartitions("lead").select("key", "pos", "left", "right", "end")
    )
    return ranged.mapInArrow(scan, "key long, start long, end long")


def _heavy(windows: DataFrame, length: int) -> DataFrame:
    """Ranges of heads too frequent for one task: their windows are counted by two hashes.

    Part of one plan with all else, so the texts are shuffled once for both.
    """
    windows = windows.distinct()
    twice = windows.groupBy("window", "second").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return windows.join(twice, ["window", "second"]).select(
        "key", F.col("pos").alias("start"), (F.col("pos") + length).alias("end")
    )


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    length: int = 400,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts elsewhere.

    Texts are UTF-8 bytes; matches never cross rows; strings are judged on the input, and
    all copies go, the first one too. Returns one row per row of ``docs``: id, n_bytes,
    kept (the remaining bytes), n_removed, n_spans (maximal removed runs). A null text is
    empty, texts under ``length`` bytes stay whole; equal rows are copies of each other, so
    from ``length`` bytes on they go completely. A null id stays null. Other columns are
    ignored, whatever their names; an empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        row_key(id_column, text_column).alias("key"),
    ).withColumn("n_bytes", F.octet_length("text").cast("long"))
    slim = stored(
        rows.where(F.col("n_bytes") >= length)
        .select("key", F.md5(F.col("text").cast("binary")).alias("digest")), "suffix-digests",
    )
    classes = stored(
        slim.groupBy("digest").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("copies")),
        "suffix-classes",
    )
    # Texts that occur once, and one of each text that occurs again, are searched.
    spans = repeat_spans(rows, classes.select("key"), length, group_rows)
    again = classes.where("copies > 1").select("digest")
    copied = slim.join(again, "digest").select("key").distinct()
    spans = spans.join(copied, "key", "left_anti").select("key", "spans", F.lit(False).alias("whole"))
    spans = spans.union(copied.select("key", F.lit(None), F.lit(True)))

    out = "id {t}, n_bytes long, kept binary, n_removed long, n_spans long".format(
        t=docs.schema[id_column].dataType.simpleString()
    )

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, runs = [], [], []
            data, offsets = utf8_column(batch.column("text"))
            whole = batch.column("whole").to_pylist()
            for i, found in enumerate(batch.column("spans").to_pylist()):
                text = data[offsets[i] : offsets[i + 1]]
                if whole[i]:
                    kept.append(b"")
                    removed.append(len(text))
                    runs.append(1)
                elif not found:
                    kept.append(text.tobytes())
                    removed.append(0)
                    runs.append(0)
                else:
                    a, b = _merge(*(np.array([s[x] for s in found]) for x in ("start", "end")))
                    gaps = zip(np.append(0, b), np.append(a, len(text)))
                    kept.append(b"".join(text[x:y].tobytes() for x, y in gaps))
                    removed.append(int((b - a).sum()))
                    runs.append(len(a))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(kept, pa.binary()),
                 pa.array(removed, pa.int64()), pa.array(runs, pa.int64())],
                names=["id", "n_bytes", "kept", "n_removed", "n_spans"],
            )

    joined = rows.join(spans, "key", "left")
    return joined.mapInArrow(keep, out).withColumnRenamed("id", id_column)
