import base64
import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from eventflow.functions import records as R
from eventflow.schema import EVENT_SCHEMA, make_rows
from eventflow.sinks import tables

FAILS = object()
SUIT = {"type": "enum", "name": "suit", "symbols": ["red", "black"]}
PAIR = {"type": "record", "name": "pair", "fields": [{"name": "a", "type": "int"}, {"name": "b", "type": "string"}]}
MONEY = {"type": "bytes", "logicalType": "decimal", "precision": 6, "scale": 2}
b64 = lambda b: base64.b64encode(b).decode()

# writer type, reader type, given value, value read (FAILS: to the failure policy)
CASES = [
    ("int", "long", 5, 5), ("int", "double", 5, 5.0), ("long", "float", 5, 5.0), ("float", "double", 1.5, 1.5),
    ("long", "int", 5, FAILS), ("double", "float", 1.5, FAILS), ("int", "string", 5, FAILS),
    ("int", "int", 2**31, FAILS), ("int", "int", 1.5, FAILS), ("int", "int", "5", FAILS), ("int", "int", None, FAILS),
    ("boolean", "boolean", True, True), ("boolean", "boolean", "true", FAILS), ("boolean", "int", True, FAILS),
    ("string", "string", "x", "x"), ("string", "string", 5, FAILS), ("string", "string", {"a": 1}, FAILS),
    ("string", "bytes", "é", "é".encode()), ("bytes", "string", b64("é".encode()), "é"),
    ("bytes", "bytes", b64(b"\0\xff"), b"\0\xff"), ("bytes", "bytes", "%%", FAILS), ("bytes", "bytes", 1, FAILS),
    ({"type": "fixed", "name": "f", "size": 2}, {"type": "fixed", "name": "f", "size": 2}, b64(b"ab"), b"ab"),
    ({"type": "fixed", "name": "f", "size": 2}, {"type": "fixed", "name": "f", "size": 2}, b64(b"abc"), FAILS),
    ({"type": "fixed", "name": "f", "size": 2}, {"type": "fixed", "name": "f", "size": 3}, b64(b"ab"), FAILS),
    ({"type": "fixed", "name": "f", "size": 2}, {"type": "fixed", "name": "g", "size": 2}, b64(b"ab"), FAILS),
    ({"type": "fixed", "name": "n.f", "size": 2}, {"type": "fixed", "name": "g", "aliases": ["m.f"], "size": 2}, b64(b"ab"), b"ab"),
    (SUIT, SUIT, "red", "red"), (SUIT, SUIT, "green", FAILS), (SUIT, "string", "red", FAILS),
    (SUIT, {**SUIT, "symbols": ["black"]}, "red", FAILS), (SUIT, {**SUIT, "symbols": ["black"]}, "black", "black"),
    (SUIT, {**SUIT, "symbols": ["none"], "default": "none"}, "red", "none"), (SUIT, {**SUIT, "name": "x"}, "red", FAILS),
    ({"type": "array", "items": "int"}, {"type": "array", "items": "long"}, [1, 2], [1, 2]),
    ({"type": "array", "items": "int"}, {"type": "array", "items": "long"}, [1, None], FAILS),
    ({"type": "array", "items": "int"}, {"type": "array", "items": "string"}, [], FAILS),
    ({"type": "array", "items": SUIT}, {"type": "array", "items": {**SUIT, "symbols": ["red"]}}, ["red", "black"], FAILS),
    ({"type": "array", "items": SUIT}, {"type": "array", "items": {**SUIT, "symbols": ["red"]}}, ["red"], ["red"]),
    ({"type": "array", "items": "int"}, {"type": "array", "items": "int"}, "x", FAILS),
    ({"type": "map", "values": "int"}, {"type": "map", "values": "double"}, {"k": 1}, {"k": 1.0}),
    ({"type": "map", "values": "string"}, {"type": "map", "values": "string"}, {"k": 1}, FAILS),
    ({"type": "map", "values": ["null", "int"]}, {"type": "map", "values": ["int", "null"]}, {"k": None, "l": 2}, {"k": None, "l": 2}),
    (["null", "int"], ["long", "null"], None, None), (["null", "int"], "long", None, FAILS), (["null", "int"], "long", 4, 4),
    ("int", ["null", "string"], 4, FAILS), ("int", ["null", "string", "long"], 4, (None, 4)), ("int", ["double", "int"], 4, (None, 4)),
    (["int", "string"], ["null", "string", "double"], 4, (None, 4.0)), (["int", "string"], ["null", "string", "double"], "s", ("s", None)),
    (["int", "string"], "int", "s", FAILS), (["int", "string"], "int", 7, 7), (["int", "string"], "int", True, FAILS),
    (["int", "long"], ["long", "int"], 2**40, 2**40), (["int", "string"], "boolean", 7, FAILS),
    (["null", PAIR, "string"], ["null", PAIR], {"a": 1, "b": "x"}, (1, "x")), (["null", PAIR, "string"], ["null", PAIR], "s", FAILS),
    (["null", PAIR, "string"], ["null", PAIR], {"a": "1", "b": "x"}, FAILS), (["null", PAIR, "string"], ["null", PAIR], None, None),
    ([{"type": "array", "items": "int"}, {"type": "map", "values": "string"}], {"type": "map", "values": "string"}, {"q": "w"}, {"q": "w"}),
    ([{"type": "array", "items": "int"}, {"type": "map", "values": "string"}], {"type": "array", "items": "long"}, [3], [3]),
    ([{"type": "array", "items": "int"}, "string"], {"type": "array", "items": "long"}, ["3"], FAILS),
    (PAIR, PAIR, {"a": 1, "b": "x"}, (1, "x")), (PAIR, PAIR, {"a": 1}, FAILS), (PAIR, PAIR, "x", FAILS),
    (PAIR, {**PAIR, "name": "n.pair"}, {"a": 1, "b": "x"}, (1, "x")), (PAIR, {**PAIR, "name": "two"}, {"a": 1, "b": "x"}, FAILS),
    (PAIR, {"type": "record", "name": "two", "aliases": ["pair"], "fields": [
        {"name": "c", "type": {"type": "map", "values": SUIT}, "default": {"k": "red"}}, {"name": "z", "aliases": ["a"], "type": "long"}]},
     {"a": 1, "b": "x"}, ({"k": "red"}, 1)),
    (PAIR, {"type": "record", "name": "pair", "fields": [{"name": "new", "type": "int"}]}, {"a": 1, "b": "x"}, FAILS),
    (PAIR, {"type": "record", "name": "pair", "fields": [
        {"name": "u", "type": ["null", "string"], "default": None}, {"name": "v", "type": ["int", "string"], "default": 3},
        {"name": "w", "type": "bytes", "default": "\xff"}, {"name": "m", "type": MONEY, "default": "\xff\x38"},
        {"name": "r", "type": {"type": "record", "name": "in", "fields": [
            {"name": "p", "type": "int", "default": 1}, {"name": "q", "type": {"type": "array", "items": "string"}}]},
         "default": {"q": []}}]},
     {"a": 1, "b": "x"}, (None, (3, None), b"\xff", Decimal("-2.00"), (1, []))),
    ({"type": "int", "logicalType": "date"}, {"type": "int", "logicalType": "date"}, 365, dt.date(1971, 1, 1)),
    ({"type": "long", "logicalType": "timestamp-millis"}, {"type": "long", "logicalType": "timestamp-millis"}, 1500,
     dt.datetime(1970, 1, 1, 0, 0, 1, 500000)),
    ({"type": "long", "logicalType": "local-timestamp-micros"}, {"type": "long", "logicalType": "local-timestamp-micros"},
     -1, dt.datetime(1969, 12, 31, 23, 59, 59, 999999)),
    ({"type": "long", "logicalType": "timestamp-millis"}, "long", 1500, 1500), ({"type": "int", "logicalType": "odd"}, "int", 3, 3),
    (MONEY, MONEY, 12.25, Decimal("12.25")), (MONEY, MONEY, 12.255, FAILS), (MONEY, MONEY, 123456.0, FAILS), (MONEY, MONEY, "1", FAILS),
    (MONEY, {**MONEY, "scale": 1}, 1, FAILS), ("null", ["null", "int"], None, None), ("null", "int", None, FAILS),
]


def plain(value):
    if hasattr(value, "asDict"):
        return tuple(plain(v) for v in value)
    if isinstance(value, bytearray):
        return bytes(value)
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    return [plain(v) for v in value] if isinstance(value, list) else value


def record(kind):
    return json.dumps({"type": "record", "name": "top", "fields": [{"name": "f", "type": kind}]})


@pytest.mark.parametrize("part", range(4))
def test_resolution(spark, part):
    for writer, reader, given, want in CASES[part::4]:
        text = record(writer)
        df = spark.createDataFrame(
            make_rows([({tables.LITERAL_HEADER: text}, json.dumps({"f": given, "unknown": [1]}))]), EVENT_SCHEMA
        )
        out = tables.decode_dataset(df, tables.RecordSchema.parse(record(reader)), {text: text}).first().row
        got = FAILS if out is None else plain(out.f)
        assert got == want or (got is want), (writer, reader, given, got)


def test_native_values_resolve_alike(spark):
    """Values that a parser of one's own gives in the writer's types."""
    writer = record({"type": "record", "name": "w", "fields": [
        {"name": "n", "type": ["null", "int"]}, {"name": "u", "type": ["int", "string"]},
        {"name": "l", "type": {"type": "array", "items": SUIT}}]})
    reader = record({"type": "record", "name": "w", "fields": [
        {"name": "n", "type": ["null", "double"]}, {"name": "u", "type": ["string", "long"]},
        {"name": "l", "type": {"type": "array", "items": {**SUIT, "symbols": ["red"]}}}]})
    kind = R.spark_type(R.parse_schema(writer))
    bodies = ['{"f":{"n":1,"u":{"member0":4},"l":["red"]}}', '{"f":{"u":{"member1":"t"},"l":[]}}', '{"f":{"l":["black"]}}', "no"]
    df = spark.createDataFrame(make_rows([({tables.LITERAL_HEADER: writer}, b) for b in bodies]), EVENT_SCHEMA)
    parser = lambda body, _: F.from_json(body.cast("string"), kind[len("struct<"):-1].replace(": ", " ", 1))
    out = tables.decode_dataset(df, tables.RecordSchema.parse(reader), {writer: writer}, parser=parser)
    got = [None if r.row is None else plain(r.row.f) for r in out.collect()]
    assert got == [(1.0, (None, 4), ["red"]), (None, ("t", None), []), None, None]


def test_bodies_are_parsed_once(spark):
    text = record(["null", "int", "string", PAIR])
    df = spark.createDataFrame(make_rows([({tables.LITERAL_HEADER: text}, '{"f":1}')] * 3), EVENT_SCHEMA)
    out = tables.decode_dataset(df, tables.RecordSchema.parse(record(["string", "long", "null"])), {text: text})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "parse_json" not in plan


def test_schemas_that_rows_cannot_hold():
    with pytest.raises(ValueError, match="itself"):
        R.parse_schema('{"type":"record","name":"n","fields":[{"name":"next","type":["null","n"]}]}')
    with pytest.raises(ValueError, match="unknown"):
        R.parse_schema(record("missing"))
    with pytest.raises(ValueError):
        tables.RecordSchema.parse('"int"')


def test_names_are_found_in_their_namespace():
    kind = R.parse_schema(json.dumps({"type": "record", "name": "a.b.top", "fields": [
        {"name": "x", "type": {"type": "enum", "name": "e", "symbols": ["s"]}},
        {"name": "y", "type": "e"}, {"name": "z", "type": "a.b.e"}]}))
    assert [f.kind.label for f in kind.fields] == ["e", "e", "e"]
    assert R.spark_type(kind) == "struct<`x`: string, `y`: string, `z`: string>"
