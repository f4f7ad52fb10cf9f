"""Best-fit packing of tokenized documents under several capacities at once."""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import stored

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
TEXT_BYTES = 1 << 24  # text tokenized at once; one longer text makes a block of its own
WORDS = 1 << 14  # words handed to the tokenizer at once
END_MARK = "</w>"  # of the tokenizer's tokens that end a unit of its pattern
#: Latin letters without U+0130, whose lower case holds a mark; then ASCII punctuation.
LATIN_WORD = (
    r"^(?P<core>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}]+)"
    r"(?P<tail>[!-/:-@\[-`{-~]*)$"
)
#: Weights of the residual norm: tokens first, the others decide between like fits.
WEIGHTS = {"tokens": 1.0, "documents": 1e-4, "attention": 1e-4}


def gathered(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum())), sizes


class Words:
    """Ids of single words, encoded together where that cannot change them.

    A word of Latin letters is one unit of the tokenizer's pattern, which lowers its case
    and marks its last token, so many such words are encoded as one text and cut after the
    marked tokens. ASCII punctuation at the end of such a word is a unit of its own.
    """

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        marked = [i for token, i in tokenizer.get_vocab().items() if token.endswith(END_MARK)]
        self.last = np.zeros(tokenizer.get_vocab_size(), bool)
        self.last[marked] = True

    def alone(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word)."""
        parts = [(np.zeros(0, np.uint32), np.zeros(0, np.int64))]
        for at in range(0, len(words), WORDS):
            some = words.slice(at, WORDS).to_pylist()
            parts.append(gathered([e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]))
        return tuple(np.concatenate(x) for x in zip(*parts))

    def together(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = [(np.zeros(0, np.uint32), np.zeros(0, np.int64))]
        for at in range(0, len(words), WORDS):
            some = words.slice(at, WORDS)
            listed = some.to_pylist()
            joined = [" ".join(listed[i : i + 256]) for i in range(0, len(listed), 256)]
            ids, _ = gathered([e.ids for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
            stops = np.flatnonzero(self.last[ids])
            whole = len(stops) == len(listed) and (not len(ids) or stops[-1] == len(ids) - 1)
            parts.append((ids, np.diff(stops, prepend=-1)) if whole else self.alone(some))
        return tuple(np.concatenate(x) for x in zip(*parts))

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of words that hold no ASCII white space."""
        parts = pc.extract_regex(words, LATIN_WORD)
        known = parts.is_valid()
        core = pc.utf8_lower(pc.struct_field(parts, "core")).filter(known).dictionary_encode()
        tail = pc.struct_field(parts, "tail").filter(known).dictionary_encode()
        units = [self.together(core.dictionary), self.alone(tail.dictionary), self.alone(words.filter(pc.invert(known)))]
        ids = np.concatenate([x for x, _ in units])
        sizes = np.concatenate([*(n for _, n in units), [0]])  # the last unit is empty
        known = known.to_numpy(zero_copy_only=False)
        pair = np.full((len(words), 2), len(sizes) - 1)
        cores, tails = len(core.dictionary), len(tail.dictionary)
        pair[known, 0], pair[known, 1] = core.indices.to_numpy(), tail.indices.to_numpy() + cores
        pair[~known, 0] = np.arange(cores + tails, len(sizes) - 1)
        at = (np.cumsum(sizes) - sizes)[pair]
        flat = ids[spread(at.ravel(), sizes[pair].ravel())]
        return flat, np.concatenate([[0], np.cumsum(sizes[pair].sum(1))])


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[0] .. starts[0] + sizes[0] - 1, starts[1] .., one after the other."""
    first = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts - first, sizes)


def encode_texts(encode: Words, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of whole texts, ``end_id`` after each; null counts as empty.

    The tokenizer never joins over white space, so each different word of the block is
    encoded once and its ids are laid out by gathers.
    """
    split = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    bounds = split.offsets.to_numpy().astype(np.int64)
    words = split.flatten().dictionary_encode()
    ids, at = encode(words.dictionary)
    which = words.indices.to_numpy()
    sizes = np.diff(at)[which]
    ends = np.concatenate([[0], np.cumsum(sizes)])[bounds - bounds[0]]
    flat = ids[spread(at[which], sizes)]
    flat = np.insert(flat, ends[1:], end_id)
    return flat, ends + np.arange(len(ends))


def blocks(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``TEXT_BYTES`` of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < len(total):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + TEXT_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def pieces(
    docs: DataFrame,
    *,
    tokenizer: str = TOKENIZER,
    max_tokens: int = 2048,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Documents as token pieces: id, piece, start, length, ids_crc32 (and ids).

    The tokenizer is one that lowers case, splits at white space and marks word ends.

    Only documents of more than ``max_tokens`` are cut, into pieces of that length; the
    last may be shorter. A null or empty text is one piece that holds ``end_id`` alone,
    so every row gives at least one piece; a null id is kept.
    """
    given = docs.schema[id_column].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        encode = Words(Tokenizer.from_file(tokenizer))
        for batch in batches:
            for part in blocks(batch, "text"):
                flat, ends = encode_texts(encode, part.column("text"), end_id)
                flat = flat.astype("<u4")
                n = np.diff(ends)
                count = -(-n // max_tokens)
                row = np.repeat(np.arange(len(n)), count)
                piece = spread(np.zeros(len(n), np.int64), count)
                start = piece * max_tokens
                length = np.minimum(n[row] - start, max_tokens)
                begin = ends[row] + start
                crc = [zlib.crc32(flat[a : a + b].data) for a, b in zip(begin, length)]
                cells = [
                    part.column("id").take(pa.array(row)), pa.array(piece.astype(np.int32)),
                    pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                ]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:  # pieces follow each other, so offsets are their lengths' sums
                    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                    cells.append(pa.ListArray.from_arrays(offsets, flat.astype(np.int32)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cells, names=names)

    schema = f"id {given}, piece int, start long, length long, ids_crc32 long"
    own = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    out = own.mapInArrow(cut, schema + (", ids array<int>" if with_ids else ""))
    return out.withColumnRenamed("id", id_column)


def best_fit(
    demands: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str = "norm"
) -> np.ndarray:
    """The bin of each item (rows of ``demands``), so that no bin exceeds any capacity.

    Items come in decreasing order of weighted demand. Of the open bins in which an item
    fits in every dimension it takes the one with the least weighted norm of what would be
    left (``norm``), or with the largest weighted dot product of the item and what is used
    (``dot``: the item goes where its large demands meet the fullest dimensions). Ties go
    to the oldest bin; where none fits a new bin opens.
    """
    n, dims = demands.shape
    if (demands > capacity).any():
        raise ValueError("an item exceeds a capacity")
    part = demands / capacity
    order = np.argsort(-(part @ weights), kind="stable")
    least = demands.min(0) if n else np.zeros(dims)
    out = np.empty(n, np.int64)
    opened = 0
    left = np.empty((max(n, 1), dims))  # of open bins, in order of opening
    name = np.empty(max(n, 1), np.int64)
    held = 0
    root = np.sqrt(weights)
    for i in order:
        need = demands[i]
        at = -1
        if held:
            room = left[:held] - need
            fits = np.flatnonzero((room >= 0).all(1))
            if len(fits):
                if rule == "norm":
                    cost = (((room[fits] / capacity) * root) ** 2).sum(1)
                else:
                    cost = -((1 - left[fits] / capacity) @ (weights * part[i]))
                at = fits[np.argmin(cost)]
        if at < 0:
            at, opened = held, opened + 1
            left[at], name[at] = capacity, opened - 1
            held += 1
        left[at] -= need
        out[i] = name[at]
        if (left[at] < least).any():  # no item fits any more
            left[at : held - 1], name[at : held - 1] = left[at + 1 : held].copy(), name[at + 1 : held].copy()
            held -= 1
    return out


def pack(
    items: DataFrame,
    *,
    max_tokens: int = 2048,
    max_documents: int | None = None,
    max_attention: int | None = None,
    weights: dict[str, float] = WEIGHTS,
    rule: str = "norm",
    group_rows: int = 16_384,
) -> DataFrame:
    """Pieces with sequence_id and offset: each sequence holds whole pieces without gaps.

    A sequence keeps three capacities: tokens, documents (pieces) and attention cost (the
    sum of squared lengths, for attention that stays inside a piece); a capacity of None
    is the largest that ``max_tokens`` allows. Pieces longer than a capacity allows raise.

    Pieces are dealt evenly, whatever their ids and lengths, into groups of about
    ``group_rows``, each packed in one task; a group costs at most one part-filled
    sequence more than packing all pieces at once would, one in some thousands. Repeated
    rows are packed each; no rows give none. Other columns are kept.
    """
    spark = items.sparkSession
    documents = max_documents or max_tokens
    attention = max_attention or max_tokens * max_tokens
    capacity = np.array([max_tokens, documents, attention], float)
    share = np.array([weights[x] for x in ("tokens", "documents", "attention")])
    held = stored(items, "pieces")
    groups = max(1, -(-held.count() // group_rows))

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows)
        length = table.column("length").to_numpy().astype(np.int64)
        demands = np.stack([length, np.ones(len(length), np.int64), length**2], axis=1).astype(float)
        bins = best_fit(demands, capacity, share, rule)
        order = np.lexsort((np.arange(len(bins)), bins))
        ends = np.cumsum(length[order])
        first = np.flatnonzero(np.diff(bins[order], prepend=-1))
        before = np.repeat((ends - length[order])[first], np.diff(np.append(first, len(bins))))
        sequence = bins[order] + (TaskContext.get().partitionId() << 32)
        table = table.take(pa.array(order)).append_column("sequence_id", pa.array(sequence))
        yield from table.append_column("offset", pa.array(ends - length[order] - before)).to_batches()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema)
    return held.repartition(groups).mapInArrow(fill, f"{schema}, sequence_id long, offset long")


def longest_piece(max_tokens: int, max_attention: int | None) -> int:
    """Tokens of the longest piece that both capacities allow."""
    return min(max_tokens, math.isqrt(max_attention)) if max_attention else max_tokens


def pack_documents(
    docs: DataFrame,
    *,
    tokenizer: str = TOKENIZER,
    max_tokens: int = 2048,
    max_documents: int | None = None,
    max_attention: int | None = None,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
    **options,
) -> DataFrame:
    """``pieces`` of documents, packed by ``pack``; columns other than id and text are ignored."""
    cut = pieces(
        docs, tokenizer=tokenizer, max_tokens=longest_piece(max_tokens, max_attention), end_id=end_id,
        id_column=id_column, text_column=text_column, with_ids=with_ids,
    )
    return pack(
        cut, max_tokens=max_tokens, max_documents=max_documents, max_attention=max_attention, **options
    )


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, ids (all tokens), starts of its pieces.

    Needs pieces with ids; a sequence holds a bounded number of them.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("starts")
    )
