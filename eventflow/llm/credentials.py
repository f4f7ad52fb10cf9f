"""Secret scan with multipart credential linking."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The base patterns of the contract; ASCII letters only, in either case for
# the first.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_VALUE, ACCESS_LENGTH = 12, 18
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")

# Weak parts: nothing alone, reported where complementary parts meet in one scope.
# Each is searched only where a text holds the characters that it cannot do without.
IDENTIFIER = re.compile(
    r"""(?<![A-Za-z0-9])(?:user(?:name)?|login|client_?id|account|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?"""
    r"""[A-Za-z0-9_.@-]{3,}""",
    re.IGNORECASE | re.ASCII,
)
ROLE = re.compile(r"(?<![A-Za-z0-9])(?:ASIA|AROA|AIDA)[A-Z0-9]{12,}")
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", re.ASCII)
WEAK_WORD = re.compile(
    r"""(?<![A-Za-z0-9])(?:pwd|pass|passphrase|private_?key|auth|credential)["']?\x20*[:=]\x20*["']?[!-~]{6,}""",
    re.IGNORECASE | re.ASCII,
)
URL = re.compile(r"(?<![A-Za-z0-9])[a-z][a-z0-9+.-]{1,15}://[!-~]{4,}", re.IGNORECASE | re.ASCII)
HOST = re.compile(
    r"""(?<![A-Za-z0-9])(?:host(?:name)?|server|endpoint|url)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.:/-]{4,}""",
    re.IGNORECASE | re.ASCII,
)
ADDRESS = re.compile(r"(?<![A-Za-z0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{2,5})?(?![0-9])")
DIGIT = re.compile("[0-9]")

IDENT, VALUE, PLACE = 1, 2, 4  # the three parts of a credential
PARTS = {"assign": VALUE, "access": IDENT, "hex": VALUE, "identifier": IDENT, "secret": VALUE, "endpoint": PLACE}
SCOPE_BREAK = re.compile(r"\n[ \t\r]*\n")
Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, leftmost and non-overlapping within each kind."""
    out = []
    if "=" in text or ":" in text:
        out += [
            (m.start(), m.end(), "assign")
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= ASSIGN_VALUE
        ]
    if "AKIA" in text:
        out += [
            (m.start(), m.end(), "access")
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= ACCESS_LENGTH
        ]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def entropy(token: str) -> float:
    """Bits per character."""
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values())


def _random_looking(token: str) -> bool:
    kinds = sum(bool(re.search(p, token)) for p in ("[a-z]", "[A-Z]", "[0-9]"))
    return kinds == 3 and entropy(token) >= 3.5


def weak_spans(text: str) -> list[Span]:
    """Candidates that mean nothing alone."""
    found = [("secret", m) for m in WEAK_SECRET.finditer(text) if _random_looking(m.group())]
    if "=" in text or ":" in text:
        found += [("identifier", m) for m in IDENTIFIER.finditer(text)]
        found += [("secret", m) for m in WEAK_WORD.finditer(text)]
        found += [("endpoint", m) for m in HOST.finditer(text)]
    if "://" in text:
        found += [("endpoint", m) for m in URL.finditer(text)]
    if "ASIA" in text or "AROA" in text or "AIDA" in text:
        found += [("identifier", m) for m in ROLE.finditer(text)]
    if DIGIT.search(text):
        found += [("endpoint", m) for m in ADDRESS.finditer(text)]
    return [(m.start(), m.end(), kind) for kind, m in found]


def linked(text: str, base: list[Span], weak: list[Span], reach: int) -> list[Span]:
    """Weak spans that an interval join pairs with a complementary part.

    Two spans join if they lie in one scope (text between blank lines), at most ``reach``
    characters apart. A weak identifier or endpoint needs a secret, a weak secret an
    identifier or an endpoint. The join sweeps over the ends of each part's spans; it looks
    at no pair. Weak spans inside a stronger one are that one.
    """
    if not weak:
        return []
    strong = sorted(base)
    starts = np.array([s[0] for s in strong], np.int64)
    ends = np.maximum.accumulate([-1, *(s[1] for s in strong)])  # of the strong spans before
    before = ends[np.searchsorted(starts, [s[1] for s in weak])]
    free = [s for s, end in zip(weak, before) if end <= s[0]]
    if not free:
        return []
    breaks = [m.start() for m in SCOPE_BREAK.finditer(text)]
    everything = strong + free
    a, b = (np.array([s[x] for s in everything], np.int64) for x in (0, 1))
    part = np.array([PARTS[s[2]] for s in everything])
    # Each scope has its own stretch of one axis, wider than the text and the reach.
    base_of = np.searchsorted(breaks, a, side="right") * (len(text) + reach + 2)
    near = np.zeros(len(everything), int)
    for bit in (IDENT, VALUE, PLACE):
        own = np.flatnonzero(part == bit)
        if not len(own):
            continue
        # In one scope: the nearest span that begins at or before each end plus reach, and
        # the furthest end among those.
        own = own[np.argsort(base_of[own] + a[own], kind="stable")]
        far = np.maximum.accumulate(base_of[own] + b[own])
        at = np.searchsorted(base_of[own] + a[own], base_of + b + reach, side="right")
        hit = (at > 0) & (far[np.maximum(at - 1, 0)] >= base_of + np.maximum(a - reach, 0))
        near[hit] |= bit
    need = {IDENT: VALUE, PLACE: VALUE, VALUE: IDENT | PLACE}
    n = len(strong)
    return [s for i, s in enumerate(free, n) if near[i] & need[PARTS[s[2]]]]


def in_order(spans: Iterable[Span]) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(docs: DataFrame, text: str = "text", *, reach: int = 200) -> DataFrame:
    """Add ``secrets`` to each row: its spans (start, end, kind, value, linked).

    Starts and ends are code points, end exclusive; ``linked`` marks spans that only
    co-occurrence makes a finding. Spans are sorted by start and kind. A null or empty text
    has none; whole texts are scanned, row by row, without a shuffle; equal rows give equal
    results; a column named secrets is replaced. An empty table gives no rows.
    """
    span = T.StructType(
        [T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
         T.StructField("kind", T.StringType()), T.StructField("value", T.StringType()),
         T.StructField("linked", T.BooleanType())]
    )
    kept = docs.drop("secrets")
    schema = T.StructType([*kept.schema.fields, T.StructField("secrets", T.ArrayType(span))])
    kind = pa.list_(pa.struct([
        ("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()),
        ("value", pa.string()), ("linked", pa.bool_()),
    ]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value in batch.column(text):
                t = value.as_py() or ""
                base = base_spans(t)
                weak, sure = linked(t, base, weak_spans(t), reach), set(base)
                found.append([
                    {"start": s, "end": e, "kind": k, "value": t[s:e], "linked": (s, e, k) not in sure}
                    for s, e, k in in_order(base + weak)
                ])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, "secrets"]
            )

    return kept.mapInArrow(run, schema)
