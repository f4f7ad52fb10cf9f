"""Decoding policies, line splitting, text rendering of events."""

from __future__ import annotations

import codecs

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventflow.functions import headers as hdr
from eventflow.schema import is_utf8

REPLACEMENT = "�"


def decode_text(body: Column, policy: str = "FAIL", charset: str = "UTF-8") -> Column:
    """Bytes to text. FAIL raises on bad input, REPLACE marks it, IGNORE drops it."""
    policy = policy.upper()
    utf8 = is_utf8(charset)
    if policy == "FAIL":
        if utf8:
            return F.when(body.isNotNull(), F.validate_utf8(body.cast("string")))
        return F.decode(body, charset)
    if policy not in ("REPLACE", "IGNORE"):
        raise ValueError(f"unknown decode policy: {policy}")
    if not utf8:
        raise ValueError("REPLACE and IGNORE are defined for UTF-8 input")
    raw = body.cast("string")
    if policy == "REPLACE":
        return F.make_valid_utf8(raw)
    # A replacement character already in the input is data, so protect it first.
    # U+0000 U+E000 cannot arise from repair, hence restores unambiguously unless
    # the very same pair is in the text; valid text skips the detour altogether.
    guard = "\u0000"
    guarded = F.replace(raw, F.lit(REPLACEMENT), F.lit(guard))
    repaired = F.replace(F.make_valid_utf8(guarded), F.lit(REPLACEMENT), F.lit(""))
    return F.when(F.is_valid_utf8(raw), raw).otherwise(
        F.replace(repaired, F.lit(guard), F.lit(REPLACEMENT))
    )


def _terminated(text: Column) -> Column:
    return F.endswith(text, F.lit("\n")) | (text == "")


def whole_lines(parts: Column, text: Column) -> Column:
    """Lines of a text from its parts at newlines; what follows the last one is no line."""
    return F.when(_terminated(text), F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def cut_lines(whole: Column, text: Column, max_length: int, compat: bool = False) -> Column:
    """Cut the lines longer than ``max_length`` into pieces."""
    if max_length < 1:
        raise ValueError("max_length must be positive")
    last = F.size(whole)

    def pieces(line: Column, i: Column) -> Column:
        size = F.length(line)
        count = F.greatest(F.ceil(size / F.lit(max_length)).cast("int"), F.lit(1))
        if compat:
            ended = (i < last - 1) | _terminated(text)
            full = (size > 0) & (F.pmod(size, F.lit(max_length)) == 0) & ended
            count = count + F.when(full, 1).otherwise(0)
        return F.transform(
            F.sequence(F.lit(0), count - 1),
            lambda n: F.substr(line, n * max_length + 1, F.lit(max_length)),
        )

    # Bytes bound characters from above, so most texts skip counting them.
    long = F.exists(whole, lambda line: F.octet_length(line) >= max_length)
    return F.when(long, F.flatten(F.transform(whole, pieces))).otherwise(whole)


def split_lines(text: Column, max_length: int = 2048, compat: bool = False) -> Column:
    """Lines of a text as an array, long lines cut into ``max_length`` pieces.

    ``\\r`` stays; an unterminated last line counts; an empty line gives ``''``.
    With ``compat`` a line whose length is an exact multiple of ``max_length`` is
    followed by one empty line (its own newline, read separately).
    """
    return cut_lines(whole_lines(F.split(text, "\n", -1), text), text, max_length, compat)


def header_and_text(headers: Column, body: Column) -> Column:
    """``{k=v, ...} body``."""
    return F.concat(hdr.render(headers), F.lit(" "), body.cast("string"))


def dump(headers: Column, body: Column, max_bytes: int = 16) -> Column:
    """``{ headers:{...} body: <hex> <ascii> }`` of the first bytes of the body.

    Hex dump layout: 16 bytes per line, each ``HH `` padded to full width, then the
    printable characters (others shown as a dot); later lines start with their offset.
    """
    head = F.substring(body, 1, max_bytes)
    size = F.octet_length(head)

    def dump_line(n: Column) -> Column:
        part = F.substring(head, n * 16 + 1, F.lit(16))
        spaced = F.regexp_replace(F.hex(part), "(..)", "$1 ")
        shown = F.regexp_replace(F.decode(part, "ISO-8859-1"), "[^ -~]", ".")
        offset = F.when(n == 0, F.lit("")).otherwise(
            F.concat(F.lit("\n"), F.lpad(F.hex(n * 16), 8, "0"))
        )
        return F.concat(offset, F.lit(" "), F.rpad(spaced, 48, " "), shown)

    lines = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(size / F.lit(16)).cast("int") - 1, F.lit(0))),
        dump_line,
    )
    text = (
        F.when(body.isNull(), F.lit("null"))
        .when(size == 0, F.lit(""))
        .otherwise(F.array_join(lines, ""))
    )
    return F.concat(F.lit("{ headers:"), hdr.render(headers), F.lit(" body:"), text, F.lit(" }"))


def csv_line(columns: list[str | Column], quote_all: bool = True, sep: str = ",") -> Column:
    """One CSV record from columns; null prints as an empty field."""
    cells = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
        for c in columns
    ]

    def cell(c: Column) -> Column:
        quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
        if quote_all:
            return quoted
        needs = F.contains(c, F.lit(sep)) | F.contains(c, F.lit('"')) | F.contains(c, F.lit("\n"))
        return F.when(needs, quoted).otherwise(c)

    return F.concat_ws(sep, *[cell(c) for c in cells])


def split_delimited(text: Column, names: list[str], delimiter: str = ",") -> list[Column]:
    """Fields of a delimited body as columns; a blank name skips its field.

    Fewer fields than names leaves the missing ones null; extra fields are ignored.
    """
    if not names:
        raise ValueError("field names are required")
    if len(delimiter) > 2 and delimiter[0] == delimiter[-1] == '"':
        delimiter = delimiter[1:-1]
    parts = F.split(text, "\\Q" + delimiter + "\\E", -1)
    return [F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names) if n.strip()]


def regex_groups(text: Column, pattern: str, names: list[str]) -> list[Column]:
    """Groups of a full match as columns, null where the text does not match."""
    hit = text.rlike(rf"\A(?:{pattern})\z")
    return [
        F.when(hit, F.regexp_extract(text, rf"\A(?:{pattern})\z", i + 1)).alias(n)
        for i, n in enumerate(names)
    ]


def decode_by(value: Column, charset: Column, names: list[str]) -> Column:
    """Bytes to text, each row by its own charset; what a charset lacks becomes U+FFFD.

    ``names`` lists the charsets that occur. UTF-8 and ISO-8859-1 stay in the JVM; others,
    which Spark's ``decode`` lacks, are decoded by Python for whole Arrow batches.
    """
    canon = {n: codecs.lookup(n).name for n in dict.fromkeys(names)}
    latin = [n for n, c in canon.items() if c == "iso8859-1"]
    rest = [n for n, c in canon.items() if c not in ("iso8859-1", "utf-8")]
    out = value.cast("string")
    if latin:
        out = F.when(charset.isin(*latin), F.decode(F.when(charset.isin(*latin), value), "ISO-8859-1")).otherwise(out)
    if rest:
        other = charset.isin(*rest)
        out = F.when(other, _decoder()(F.when(other, value), F.when(other, charset))).otherwise(out)
    return out


def _decoder():
    def decode(values, charsets):
        import pyarrow as pa

        return pa.array([
            None if v is None else v.decode(c, "replace")
            for v, c in zip(values.to_pylist(), charsets.to_pylist())
        ], pa.string())

    return F.arrow_udf(decode, "string")
