"""Line-level deduplication of repeated runs by winnowing over line hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.llm.common import released, row_key, stored


# Repeats that are sent to all tasks at most: documents, and windows in them.
SENT_ROWS, SENT_PLACES = 400_000, 4_000_000


def line_windows(lines: list[bytes], run: int) -> list[tuple[bytes, bytes, int, bool]]:
    """Each window of ``run`` lines: (fingerprint, digest, start, whether a new fingerprint).

    The fingerprint is the least line hash of the window, the leftmost of equals, so equal
    windows have equal fingerprints at equal places and every window has one. Windows of
    nothing but blank lines are left out.
    """
    from hashlib import blake2b

    hashes = [blake2b(line, digest_size=16).digest() for line in lines]
    blank = [not line.strip() for line in lines]
    out, last = [], -1
    for i in range(len(lines) - run + 1):
        if all(blank[i : i + run]):
            continue
        at = min(range(i, i + run), key=hashes.__getitem__)
        digest = blake2b(b"".join(hashes[i : i + run]), digest_size=16).digest()
        out.append((hashes[at], digest, i, at != last))
        last = at
    return out


def long_windows(lines: list[bytes], run: int, words: int) -> list[tuple[bytes, int, int]]:
    """Each window of fewer than ``run`` lines with more than ``words`` words: (digest, start, lines).

    Words are split at spaces and 0x09-0x0D. Windows of different sizes have different digests.
    """
    from hashlib import blake2b

    if run < 2 or sum(map(len, lines)) <= words:
        return []
    upto = np.cumsum([0, *(len(line.split()) for line in lines)])
    out, hashes = [], {}
    for n in range(1, min(run - 1, len(lines)) + 1):
        for i in np.flatnonzero(upto[n:] - upto[:-n] > words).tolist():
            for j in range(i, i + n):
                if j not in hashes:
                    hashes[j] = blake2b(lines[j], digest_size=16).digest()
            whole = b"".join(hashes[j] for j in range(i, i + n))
            out.append((blake2b(whole, digest_size=16).digest(), i, n))
    return out


def drop_repeated_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, run: int = 3,
    long_words: int | None = None,
) -> DataFrame:
    """Delete later repeats of runs of ``run`` or more lines; the first one stays.

    A line goes if it lies in a run of ``run`` lines that also stands earlier: in a row
    with a smaller id or further up in the same row. With ``long_words`` it also goes if it
    lies in such a run of fewer lines that has more than ``long_words`` words in all (split
    at spaces and 0x09-0x0D), so documents of fewer lines can lose lines too. Repeats of a
    part of a line are not found. Adds ``n_lines``, ``n_removed`` (lines)
    and ``n_runs`` (maximal deleted runs) and replaces the text by its remaining lines,
    which is empty if all went. Null texts stay null with no line; an empty text is one
    blank line; runs of blank lines only are kept, as are shorter runs. Null ids
    come last; rows with equal id and text are one place, so both stay; rows with equal id
    and other texts go by the key of the text. Other columns stay as they are; columns with
    the three added names are replaced. An empty table gives no rows.

    Fingerprints (least line hash of each window) that occur once are sorted out first.
    Positions of the others are joined by window; neighbouring windows extend a match both
    ways. A window of fewer lines is its own fingerprint.
    """
    rows = docs.drop("n_lines", "n_removed", "n_runs").withColumn("__run_key", row_key(id_column, text_column))

    @released
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["fingerprint", "digest", "id", "key", "start", "lines", "new"]
        kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
        for batch in batches:
            ids, keys = batch.column("id").to_pylist(), batch.column("key").to_pylist()
            out: list[tuple] = []
            for i, text in enumerate(batch.column("text")):
                if not text.is_valid:
                    continue
                lines = text.as_buffer().to_pybytes().split(b"\n")
                out += [
                    (mark, digest, ids[i], keys[i], start, run, new)
                    for mark, digest, start, new in line_windows(lines, run)
                ]
                if long_words is not None:
                    out += [
                        (digest, digest, ids[i], keys[i], start, n, True)
                        for digest, start, n in long_windows(lines, run, long_words)
                    ]
                if len(out) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    windows = stored(
        rows.select(F.col(id_column).cast("long").alias("id"), F.col("__run_key").alias("key"), F.col(text_column).alias("text"))
        .mapInArrow(emit, "fingerprint binary, digest binary, id long, key long, start int, lines int, new boolean"),
        "line-windows",
    )
    shared = stored(
        windows.groupBy("fingerprint").agg(F.sum(F.col("new").cast("int")).alias("n"))
        .where("n > 1").select("fingerprint"), "line-fingerprints",
    )
    place = F.struct(F.col("id").isNull().alias("last"), "id", "key", "start")
    joined = windows.join(shared, "fingerprint").select("digest", "key", "start", place.alias("place"))
    first = stored(
        joined.groupBy("digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("digest", "first"), "line-firsts",
    )
    coded = F.col("start").cast("long") * run + F.col("lines") - 1
    later = (
        windows.select("digest", "key", "start", "lines", place.alias("place")).join(first, "digest")
        .where("place != first").groupBy("key")
        .agg(F.sort_array(F.collect_set(coded)).alias("__run_starts"))
    )
    later = stored(later, "line-repeats")
    n, places = later.agg(F.count(F.lit(1)), F.sum(F.size("__run_starts"))).first()
    if n <= SENT_ROWS and (places or 0) <= SENT_PLACES:
        later = F.broadcast(later)  # else documents and repeats are shuffled by key
    schema = T.StructType(
        [f for f in rows.schema if f.name != "__run_key"]
        + [T.StructField(c, T.LongType()) for c in ("n_lines", "n_removed", "n_runs")]
    )
    # The outer join puts the columns in this order.
    merged = rows.join(later.withColumnRenamed("key", "__run_key"), "__run_key", "left").drop("__run_key")

    @released
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], [[], [], []]
            for text, starts in zip(batch.column(text_column), batch.column("__run_starts")):
                lines = text.as_py().split("\n") if text.is_valid else []
                gone = np.zeros(len(lines) + 1, bool)
                for code in starts.as_py() or ():
                    gone[code // run : code // run + code % run + 1] = True
                n = int(gone.sum())
                texts.append(
                    text.as_py() if not n else "\n".join(x for x, g in zip(lines, gone) if not g)
                )
                for c, v in zip(counts, (len(lines), n, int((gone[:-1] & ~gone[1:]).sum()))):
                    c.append(v)
            arrays = [
                pa.array(texts, batch.schema.field(n).type) if n == text_column else c
                for n, c in zip(batch.schema.names, batch.columns)
                if n != "__run_starts"
            ]
            names = [n for n in batch.schema.names if n != "__run_starts"]
            yield pa.RecordBatch.from_arrays(
                [*arrays, *(pa.array(c, pa.int64()) for c in counts)],
                names=[*names, "n_lines", "n_removed", "n_runs"],
            )

    return merged.mapInArrow(cut, schema)
