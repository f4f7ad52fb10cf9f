"""Record schemas, and resolving what one schema wrote to what another reads, as Columns.

A pair of schemas compiles once, on the driver, to three Column functions: the type that a
JSON body is parsed to, whether a parsed value is one of the writer's, and its value as the
reader sees it. Everything runs inside the plan; a body is parsed once.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

# Primitive types and the types they may be read as.
PRIMITIVES = {
    "null": "void", "boolean": "boolean", "int": "int", "long": "bigint", "float": "float",
    "double": "double", "bytes": "binary", "string": "string",
}
PROMOTIONS = {
    "int": ("long", "float", "double"), "long": ("float", "double"), "float": ("double",),
    "string": ("bytes",), "bytes": ("string",),
}
# Logical types by the type that carries them.
LOGICAL = {
    ("int", "date"): "date", ("long", "timestamp-millis"): "timestamp", ("long", "timestamp-micros"): "timestamp",
    ("long", "local-timestamp-millis"): "timestamp_ntz", ("long", "local-timestamp-micros"): "timestamp_ntz",
}

Read = Callable[[Column], Column]


class Incompatible(ValueError):
    """What the writer wrote can never be read as the reader's type."""


@dataclass(frozen=True)
class Kind:
    """One type of a schema; only the parts of its own kind are set."""

    name: str
    label: str = ""  # of a record, enum or fixed, without its namespace
    aliases: tuple[str, ...] = ()
    logical: str | None = None
    precision: int = 0
    scale: int = 0
    size: int = 0
    inner: "Kind | None" = None  # array items, map values
    fields: tuple["Field", ...] = ()
    symbols: tuple[str, ...] = ()
    default: str | None = None  # of an enum
    branches: tuple["Kind", ...] = ()

    @property
    def nullable(self) -> bool:
        return self.name == "null" or any(b.name == "null" for b in self.branches)

    @property
    def choices(self) -> tuple["Kind", ...]:
        return tuple(b for b in self.branches if b.name != "null")

    @property
    def is_decimal(self) -> bool:
        return self.logical == "decimal"

    def known_as(self, other: str) -> bool:
        return other == self.label or other in self.aliases


@dataclass(frozen=True)
class Field:
    name: str
    kind: Kind
    aliases: tuple[str, ...] = ()
    has_default: bool = False
    default: object = field(default=None, compare=False)


def short(name: str) -> str:
    return name.rsplit(".", 1)[-1]


def parse_schema(text: str) -> Kind:
    """A schema's JSON text to its types. Schemas that contain themselves raise ValueError."""
    return _parse(json.loads(text), {}, "")


def _parse(doc, names: dict[str, Kind | None], space: str) -> Kind:
    if isinstance(doc, list):
        return Kind("union", branches=tuple(_parse(b, names, space) for b in doc))
    if isinstance(doc, str):
        if doc in PRIMITIVES:
            return Kind(doc)
        full = doc if "." in doc or not space else f"{space}.{doc}"
        known = full if full in names else doc
        if known not in names:
            raise ValueError(f"unknown type {doc!r}")
        if names[known] is None:
            raise ValueError(f"{doc!r} contains itself; rows cannot")
        return names[known]
    kind = doc["type"]
    if isinstance(kind, (list, dict)):
        return _parse(kind, names, space)
    if kind == "array":
        return Kind("array", inner=_parse(doc["items"], names, space))
    if kind == "map":
        return Kind("map", inner=_parse(doc["values"], names, space))
    logical, precision = doc.get("logicalType"), int(doc.get("precision", 0))
    if logical == "decimal":
        sound = kind in ("bytes", "fixed") and 0 < precision <= 38 and 0 <= int(doc.get("scale", 0)) <= precision
        logical = "decimal" if sound else None
    elif (kind, logical) not in LOGICAL:  # an unknown logical type is its plain type
        logical = None
    extra = {"logical": logical}
    if logical == "decimal":
        extra |= {"precision": precision, "scale": int(doc.get("scale", 0))}
    if kind not in ("record", "error", "enum", "fixed"):
        return replace(_parse(kind, names, space), **extra)
    full = doc["name"]
    if "." not in full and (own := doc.get("namespace", space)):
        full = f"{own}.{full}"
    space = full.rpartition(".")[0]
    extra |= {"label": short(full), "aliases": tuple(short(a) for a in doc.get("aliases", ()))}
    names[full] = None
    if kind == "enum":
        out = Kind("enum", symbols=tuple(doc["symbols"]), default=doc.get("default"), **extra)
    elif kind == "fixed":
        out = Kind("fixed", size=int(doc["size"]), **extra)
    else:
        out = Kind("record", fields=tuple(
            Field(f["name"], _parse(f["type"], names, space), tuple(f.get("aliases", ())), "default" in f, f.get("default"))
            for f in doc["fields"]
        ), **extra)
    names[full] = out
    return out


def spark_type(kind: Kind) -> str:
    """The type of a value: a union of several types is a struct of member0, member1, ..."""
    if kind.is_decimal:
        return f"decimal({kind.precision},{kind.scale})"
    if kind.name == "union":
        some = kind.choices
        if not some:
            return "void"
        if len(some) == 1:
            return spark_type(some[0])
        wide = _one_number(some)
        if wide:
            return wide
        return f"struct<{', '.join(f'member{i}: {spark_type(b)}' for i, b in enumerate(some))}>"
    if kind.name == "record":
        return f"struct<{', '.join(f'`{f.name}`: {spark_type(f.kind)}' for f in kind.fields)}>"
    if kind.name == "array":
        return f"array<{spark_type(kind.inner)}>"
    if kind.name == "map":
        return f"map<string, {spark_type(kind.inner)}>"
    if kind.name == "enum":
        return "string"
    return LOGICAL.get((kind.name, kind.logical), PRIMITIVES.get(kind.name, "binary"))


def _one_number(some: tuple[Kind, ...]) -> str | None:
    names = {b.name for b in some if not b.logical}
    if len(names) == len(some) == 2 and names in ({"int", "long"}, {"float", "double"}):
        return "bigint" if "long" in names else "double"
    return None


# How a value is held: parsed JSON is TYPED where the parser itself is strict, and a variant
# (LOOSE) below a union of several types; NATIVE values have the types of spark_type.
TYPED, LOOSE, NATIVE = "typed", "loose", "native"


def _as_variant(kind: Kind, mode: str) -> bool:
    if mode != TYPED:
        return mode == LOOSE
    if kind.name == "union":
        return len(kind.choices) != 1 or _as_variant(kind.choices[0], mode)
    return kind.name in ("string", "bytes", "enum", "fixed", "null")


def json_type(kind: Kind) -> str:
    """What a JSON body is parsed to. Numbers and containers are checked by the parser; a
    text stays a variant, since the parser would take any value as text."""
    if kind.name == "union" and len(kind.choices) == 1:
        return json_type(kind.choices[0])
    if _as_variant(kind, TYPED):
        return "variant"
    if kind.name == "record":
        return f"struct<{', '.join(f'`{f.name}`: {json_type(f.kind)}' for f in kind.fields)}>"
    if kind.name == "array":
        return f"array<{json_type(kind.inner)}>"
    if kind.name == "map":
        return f"map<string, {json_type(kind.inner)}>"
    return PRIMITIVES[kind.name]


def _missing(kind: Kind, mode: str, value: Column) -> Column:
    if _as_variant(kind, mode):
        return value.isNull() | F.coalesce(F.is_variant_null(value), F.lit(False))
    return value.isNull()


def _item(value: Column, name: str, mode: str) -> Column:
    return F.try_variant_get(value, f"$['{name}']", "variant") if mode == LOOSE else value[name]


def _items(value: Column, mode: str) -> Column:
    return F.try_variant_get(value, "$", "array<variant>") if mode == LOOSE else value


def _entries(value: Column, mode: str) -> Column:
    return F.try_variant_get(value, "$", "map<string, variant>") if mode == LOOSE else value


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _text(value: Column, variant: bool) -> Column:
    return F.try_variant_get(value, "$", "string") if variant else value.cast("string")


def _raw(kind: Kind, mode: str, value: Column) -> Column:
    """The plain value; JSON bodies hold bytes as base64 and decimals as numbers."""
    variant = _as_variant(kind, mode)
    if kind.is_decimal:
        return F.try_variant_get(value, "$", spark_type(kind)) if variant else value
    if kind.name in ("bytes", "fixed"):
        return F.try_to_binary(_text(value, True), F.lit("base64")) if variant else value
    if kind.name in ("string", "enum"):
        return _text(value, variant)
    return F.try_variant_get(value, "$", PRIMITIVES[kind.name]) if variant else value


def _member(kind: Kind, i: int, mode: str, value: Column) -> Column:
    """The i-th choice of a union of several types; null where it is another."""
    branch = kind.choices[i]
    if mode == NATIVE:
        return value if _one_number(kind.choices) else value[f"member{i}"]
    return F.when(written(branch, LOOSE, value), value)


def written(kind: Kind, mode: str, value: Column) -> Column:
    """Whether a parsed value is one the schema could have written; never null."""
    if kind.name == "null":
        return _missing(kind, mode, value)
    if kind.name == "union":
        some = kind.choices
        given = F.lit(False)
        if len(some) == 1:
            given = written(some[0], mode, value)
        elif some:
            for i in range(len(some)):
                given = given | _member(kind, i, mode, value).isNotNull()
        return (_missing(kind, mode, value) | given) if kind.nullable else given
    if kind.name == "record":
        own = [written(f.kind, mode, _item(value, f.name, mode)) for f in kind.fields]
        is_object = _entries(value, mode).isNotNull() if mode == LOOSE else value.isNotNull()
        return _sure(is_object & _all(own))
    if kind.name == "array":
        return _sure(F.forall(_items(value, mode), lambda x: written(kind.inner, mode, x)))
    if kind.name == "map":
        return _sure(F.forall(F.map_values(_entries(value, mode)), lambda x: written(kind.inner, mode, x)))
    raw = _raw(kind, mode, value)
    if not _as_variant(kind, mode):
        return raw.isNotNull()
    held = F.schema_of_variant(value)
    number = held.isin("BIGINT", "DOUBLE", "FLOAT") | held.startswith("DECIMAL")
    if kind.is_decimal:  # no digit may be lost
        return _sure(number & (F.try_variant_get(value, "$", "decimal(38,18)") == raw.cast("decimal(38,18)")))
    if kind.name in ("int", "long"):
        return _sure((held == "BIGINT") & raw.isNotNull())
    if kind.name in ("float", "double"):
        return _sure(number & raw.isNotNull())
    if kind.name == "boolean":
        return _sure(held == "BOOLEAN")
    fits = (held == "STRING") & raw.isNotNull()
    if kind.name == "enum":
        fits = fits & raw.isin(*kind.symbols)
    if kind.name == "fixed":
        fits = fits & (F.length(raw) == kind.size)
    return _sure(fits)


def _logical(kind: Kind, plain: Column) -> Column:
    if kind.logical == "date":
        return F.date_from_unix_date(plain)
    if kind.logical in ("timestamp-millis", "timestamp-micros"):
        return (F.timestamp_millis if kind.logical.endswith("millis") else F.timestamp_micros)(plain)
    if kind.logical and kind.logical.startswith("local-"):
        unit = 1000 if kind.logical.endswith("millis") else 1_000_000
        seconds = (plain.cast("decimal(20,0)") / F.lit(unit)).cast("decimal(18,6)")
        zero = F.lit(0)
        return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)
    return plain


@dataclass(frozen=True)
class Resolved:
    """``value`` of what was written; ``fits`` says whether the reader has a place for it."""

    value: Read
    fits: Read | None = None  # None: always

    def sure(self, value: Column) -> Column:
        return F.lit(True) if self.fits is None else self.fits(value)


def resolve(writer: Kind, reader: Kind, mode: str = TYPED) -> Resolved:
    """How the reader sees what the writer wrote; raises Incompatible where it never can.

    Numbers widen, text and bytes turn into each other, fields and types are found by name
    or by the reader's aliases, what the writer lacks takes its default, symbols that the
    reader lacks take the enum's default, and the choices of a union are resolved one by
    one: a value only fails if its own choice does.
    """
    if writer.name == "union":
        return _from_union(writer, reader, mode)
    if reader.name == "union":
        return _into_union(writer, reader, mode)
    if writer.name == reader.name == "null":
        return Resolved(lambda v: F.lit(None))
    if writer.name == reader.name == "record":
        return _record(writer, reader, mode)
    if writer.name == reader.name == "array":
        own = resolve(writer.inner, reader.inner, mode)
        fits = own.fits and (lambda v: F.forall(_items(v, mode), own.sure))
        return Resolved(lambda v: F.transform(_items(v, mode), own.value), fits)
    if writer.name == reader.name == "map":
        own = resolve(writer.inner, reader.inner, mode)
        fits = own.fits and (lambda v: F.forall(F.map_values(_entries(v, mode)), own.sure))
        return Resolved(lambda v: F.transform_values(_entries(v, mode), lambda _, x: own.value(x)), fits)
    if writer.name == reader.name == "enum" and reader.known_as(writer.label):
        if set(writer.symbols) <= set(reader.symbols):
            return Resolved(lambda v: _raw(writer, mode, v))
        known = lambda v: _raw(writer, mode, v).isin(*reader.symbols)
        if reader.default is None:
            return Resolved(lambda v: _raw(writer, mode, v), lambda v: _sure(known(v)))
        return Resolved(lambda v: F.when(known(v), _raw(writer, mode, v)).otherwise(F.lit(reader.default)))
    return _plain(writer, reader, mode)


def _plain(writer: Kind, reader: Kind, mode: str) -> Resolved:
    named = writer.name == reader.name and writer.name in (*PRIMITIVES, "fixed")
    if writer.name == "fixed" and not (named and writer.size == reader.size and reader.known_as(writer.label)):
        named = False
    if not named and reader.name not in PROMOTIONS.get(writer.name, ()):
        raise Incompatible(f"{writer.name} {writer.label} is not read as {reader.name} {reader.label}".strip())
    shape = lambda k: (k.precision, k.scale) if k.is_decimal else None
    if shape(writer) != shape(reader):
        raise Incompatible("decimals of different precision or scale")
    target = spark_type(reader)
    if mode == NATIVE and writer.logical:
        if spark_type(writer) != target:
            raise Incompatible(f"{writer.logical} is not read as {target}")
        return Resolved(lambda v: v)
    if named:
        return Resolved(lambda v: _logical(reader, _raw(writer, mode, v)))
    return Resolved(lambda v: _logical(reader, _raw(writer, mode, v).cast(PRIMITIVES[reader.name])))


def _record(writer: Kind, reader: Kind, mode: str) -> Resolved:
    if not reader.known_as(writer.label):
        raise Incompatible(f"record {writer.label} is not {reader.label}")
    values, checks = [], []
    for f in reader.fields:
        source = next((w for n in (f.name, *f.aliases) for w in writer.fields if w.name == n), None)
        if source is None:
            if not f.has_default:
                raise Incompatible(f"{f.name} is neither written nor defaulted")
            values.append((f.name, lambda v, f=f: default_value(f.kind, f.default)))
            continue
        own = resolve(source.kind, f.kind, mode)
        values.append((f.name, lambda v, own=own, n=source.name, t=spark_type(f.kind): own.value(_item(v, n, mode)).cast(t)))
        if own.fits is not None:
            checks.append(lambda v, own=own, n=source.name: own.fits(_item(v, n, mode)))
    value = lambda v: F.struct(*[read(v).alias(n) for n, read in values])
    return Resolved(value, (lambda v: _all([c(v) for c in checks])) if checks else None)


def _from_union(writer: Kind, reader: Kind, mode: str) -> Resolved:
    some, target = writer.choices, spark_type(reader)
    one = len(some) == 1
    below = mode if one or mode == NATIVE else LOOSE
    tries: list[Resolved | None] = []
    for b in some:
        try:
            tries.append(resolve(b, reader, below))
        except Incompatible:
            tries.append(None)
    if not any(tries) and not (writer.nullable and reader.nullable):
        raise Incompatible("no choice of the union can be read")
    pick = (lambda v, i: v) if one else (lambda v, i: _member(writer, i, mode, v))

    def value(v: Column) -> Column:
        out = F.lit(None).cast(target)
        for i, own in reversed(list(enumerate(tries))):
            if own is not None:
                part = pick(v, i)
                here = ~_missing(some[i], below, part)
                out = F.when(here, own.value(part).cast(target)).otherwise(out)
        return out

    def fits(v: Column) -> Column:
        out = _missing(writer, mode, v) if writer.nullable and reader.nullable else F.lit(False)
        for i, own in enumerate(tries):
            if own is not None:
                part = pick(v, i)
                out = out | (~_missing(some[i], below, part) & own.sure(part))
        return out

    whole = all(t is not None and t.fits is None for t in tries) and (reader.nullable or not writer.nullable)
    return Resolved(value, None if whole else fits)


def _wrap(reader: Kind, i: int) -> Read:
    """A value of the i-th choice as a value of the union."""
    some = reader.choices
    if len(some) == 1 or _one_number(some):
        return lambda v: v.cast(spark_type(reader))
    types = [spark_type(b) for b in some]
    return lambda v: F.struct(*[
        (v.cast(t) if j == i else F.lit(None).cast(t)).alias(f"member{j}") for j, t in enumerate(types)
    ])


def _into_union(writer: Kind, reader: Kind, mode: str) -> Resolved:
    if writer.name == "null":
        if not reader.nullable:
            raise Incompatible("null is not read")
        return Resolved(lambda v: F.lit(None).cast(spark_type(reader)))
    # The first choice of the writer's own type, else the first that can read it.
    order = sorted(enumerate(reader.choices), key=lambda c: (c[1].name != writer.name or c[1].logical != writer.logical, c[0]))
    for i, branch in order:
        try:
            own = resolve(writer, branch, mode)
        except Incompatible:
            continue
        wrap = _wrap(reader, i)
        return Resolved(lambda v: wrap(own.value(v)), own.fits)
    raise Incompatible(f"no choice of the union reads {writer.name}")


def default_value(kind: Kind, given: object) -> Column:
    """A default of a schema as a constant Column; bytes are given as Latin-1 text."""
    target = spark_type(kind)
    if kind.name == "union":
        for i, branch in enumerate(kind.choices):
            if _is_default(branch, given):
                return _wrap(kind, i)(default_value(branch, given))
        return F.lit(None).cast(target)
    if given is None:
        return F.lit(None).cast(target)
    if kind.name == "record":
        parts = [
            default_value(f.kind, given[f.name] if f.name in given else f.default).alias(f.name)
            for f in kind.fields
        ]
        return F.struct(*parts).cast(target)
    if kind.name == "array":
        return F.array(*[default_value(kind.inner, x) for x in given]).cast(target)
    if kind.name == "map":
        flat = [c for k, x in given.items() for c in (F.lit(k), default_value(kind.inner, x))]
        return F.create_map(*flat).cast(target)
    if kind.name in ("bytes", "fixed"):
        data = given.encode("latin-1")
        if not kind.is_decimal:
            return F.lit(data).cast("binary")
        digits = str(abs(n := int.from_bytes(data, "big", signed=True))).rjust(kind.scale + 1, "0")
        cut = len(digits) - kind.scale
        return F.lit(f"{'-' if n < 0 else ''}{digits[:cut]}.{digits[cut:]}").cast(target)
    return _logical(kind, F.lit(given).cast(PRIMITIVES.get(kind.name, "string"))).cast(target)


def _is_default(kind: Kind, given: object) -> bool:
    if given is None:
        return kind.name == "null"
    want = {"boolean": bool, "int": int, "long": int, "float": (int, float), "double": (int, float), "array": list,
            "map": dict, "record": dict}.get(kind.name, str)
    return isinstance(given, want) and (kind.name == "boolean" or not isinstance(given, bool))
