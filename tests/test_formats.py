import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.functions import fingerprint as FP
from eventflow.functions import text as X
from eventflow.schema import EVENT_SCHEMA, make_rows
from eventflow.sinks import tables as S
from eventflow.sources import payloads as P


def lines_of(text, limit, compat):
    """Character by character, as a line reader with a size limit would."""
    out, current, read = [], [], 0
    for c in text:
        read += 1
        if c == "\n":
            out.append("".join(current))
            current, read = [], 0
            continue
        current.append(c)
        if read >= limit:
            out.append("".join(current))
            current, read = [], 0
    if read:
        out.append("".join(current))
    if compat:
        return out
    # Without the quirk, a newline right after a full piece adds no empty line.
    sane = []
    for line in text.split("\n")[: -1 if text.endswith("\n") or not text else None]:
        sane += [line[i : i + limit] for i in range(0, max(len(line), 1), limit)]
    return sane


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.text(alphabet="ab\nü\r", max_size=25), min_size=10, max_size=30),
    st.integers(1, 6),
    st.booleans(),
)
def test_split_lines_against_a_reader(spark, texts, limit, compat):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(X.split_lines(F.col("t"), limit, compat)).collect()]
    assert got == [lines_of(t, limit, compat) for t in texts]


def test_line_cases(spark):
    df = spark.createDataFrame(
        [("line 1\nline 2\n",), ("abcdefghijklmnopqrstuvwxyz\n",), ("abcdefghij\n",)], "t string"
    )
    got = [r[0] for r in df.select(X.split_lines(F.col("t"), 10)).collect()]
    assert got == [["line 1", "line 2"], ["abcdefghij", "klmnopqrst", "uvwxyz"], ["abcdefghij"]]
    exact = df.select(X.split_lines(F.col("t"), 10, compat=True)).collect()[2][0]
    assert exact == ["abcdefghij", ""]


@pytest.mark.parametrize(
    "raw, replaced, ignored",
    [
        (b"ok", "ok", "ok"),
        (b"a\xffb", "a�b", "ab"),
        ("k�x".encode() + b"\xc3", "k�x�", "k�x"),
        ("k�x".encode(), "k�x", "k�x"),
    ],
)
def test_decode_policies(spark, raw, replaced, ignored):
    df = spark.createDataFrame([(raw,)], "b binary")
    b = F.col("b")
    got = df.select(X.decode_text(b, "REPLACE"), X.decode_text(b, "IGNORE")).first()
    assert tuple(got) == (replaced, ignored)
    if replaced != ignored:
        with pytest.raises(Exception):
            df.select(X.decode_text(b, "FAIL")).collect()
    else:
        assert df.select(X.decode_text(b, "FAIL")).first()[0] == replaced
    with pytest.raises(ValueError):
        X.decode_text(b, "GUESS")


def test_dump(spark):
    df = spark.createDataFrame(
        make_rows([({"b": "2", "a": None}, "Hi\t!"), ({}, ""), ({}, "0123456789abcdefXY")]), EVENT_SCHEMA
    )
    got = [r[0] for r in df.select(X.dump(F.col("headers"), F.col("body"), 32)).collect()]
    pad = " " * 36
    assert got[0] == "{ headers:{a=null, b=2} body: 48 69 09 21 " + pad + "Hi.! }"
    assert got[1] == "{ headers:{} body: }"
    assert "\n00000010 58 59 " in got[2] and got[2].endswith("XY }")
    null = df.limit(1).select(X.dump(F.col("headers"), F.lit(None).cast("binary"))).first()[0]
    assert null.endswith("body:null }")


def test_csv_line(spark):
    df = spark.createDataFrame([("string1", 1, None), ('a"b', 2, "x,y")], "a string, b int, c string")
    got = [tuple(r) for r in df.select(X.csv_line(["a", "b", "c"]), X.csv_line(["a", "c"], False)).collect()]
    assert got == [('"string1","1",""', "string1,"), ('"a""b","2","x,y"', '"a""b","x,y"')]


def test_delimited(spark):
    df = spark.createDataFrame(make_rows([({}, "1|skip|x"), ({}, "2||"), ({}, "3")]), EVENT_SCHEMA)
    schema = T.StructType.fromDDL("id int, msg string, other int")
    rows = S.delimited_rows(df, ["id", " ", "MSG"], schema, "|").collect()
    assert [tuple(r) for r in rows] == [(1, "x", None), (2, "", None), (3, None, None)]
    tab = df.withColumn("body", F.lit("7\t8").cast("binary"))
    assert tuple(S.delimited_rows(tab, ["id", "other"], schema, '"\t"').first()) == (7, None, 8)
    with pytest.raises(ValueError):
        X.split_delimited(F.col("body"), [])


def test_json_rows_are_strict(spark):
    schema = T.StructType.fromDDL("id int, msg string")
    good = spark.createDataFrame(make_rows([({}, '{"id": 1, "msg": "m", "z": 0}')]), EVENT_SCHEMA)
    assert tuple(S.json_rows(good, schema).first()) == (1, "m")
    bad = spark.createDataFrame(make_rows([({}, "{nope")]), EVENT_SCHEMA)
    with pytest.raises(Exception):
        S.json_rows(bad, schema).collect()


TWO = '[{"headers":{"a":"b"},"body":"random_body"},{"headers":{"e":"f"},"body":"random_body2"}]'


@pytest.mark.parametrize("charset", ["UTF-8", "UTF-16", "UTF-32"])
def test_json_events(spark, charset):
    df = spark.createDataFrame([(TWO,)], "payload string").select(
        F.encode("payload", charset).alias("payload")
    )
    events, rejected = P.parse_json_events(df, charset=charset)
    rows = events.collect()
    assert [r.headers for r in rows] == [{"a": "b"}, {"e": "f"}]
    codec = "utf-32-be" if charset == "UTF-32" else charset  # the JVM writes no mark for it
    assert [bytes(r.body).decode(codec) for r in rows] == ["random_body", "random_body2"]
    assert rejected.count() == 0


def test_json_payloads_that_only_look_wrong_or_right(spark):
    one = '{"headers":{"a":"b"},"body":"x"}'
    good = ['[{"headers":{"a":"[1]"},"body":"x"}]', '[{"headers":{"a":"{}"},"body":"{\\"k\\":1}"}]', f" [{one},{one}]\n",
            '[{"headers":{"a":5,"c":true,"d":null},"body":"[x"}]', '[{"body":"no headers"}]', "[]", '[{"headers":{"a":"x],1]"},"body":"],1"}]']
    bad = [f'[{one}],"y":[1]', f"[{one}],1]", f"[{one}]]", f"[{one}],[{one}]", f"[{one}] x", one, f"[{one}]}}", f'[{one}],"z":1',
           '[{"headers":{"a":[1]},"body":"x"}]', '[{"headers":{"a":{}},"body":"x"}]', '[{"headers":{"a":"1"},"body":{"k":1}}]',
           '[{"headers":{"a":"[1]"},"body":"x"},{"headers":{"a":[1]},"body":"x"}]', "", "[", f"[{one}", "1", f"[{one}],"]
    df = spark.createDataFrame([(p,) for p in [*good, *bad, None]], "payload string")
    events, rejected = P.parse_json_events(df)
    assert rejected.columns == ["payload"]
    assert sorted(r.payload or "" for r in rejected.collect()) == sorted([*bad, ""])
    got = sorted((sorted(r.headers.items()), bytes(r.body).decode()) for r in events.collect())
    assert got == sorted([
        ([("a", "[1]")], "x"), ([("a", "{}")], '{"k":1}'), ([("a", "b")], "x"), ([("a", "b")], "x"),
        ([("a", "5"), ("c", "true"), ("d", None)], "[x"), ([], "no headers"), ([("a", "x],1]")], "],1"),
    ])


def test_json_events_reject_whole_payload(spark):
    df = spark.createDataFrame(
        [(TWO[:-3],), ("not json",), ('{"headers":{},"body":"x"}',), ("[]",), ('[{"body":null}]',)],
        "payload string",
    )
    events, rejected = P.parse_json_events(df)
    assert rejected.count() == 3
    assert [(r.headers, bytes(r.body)) for r in events.collect()] == [({}, b"")]
    with pytest.raises(ValueError):
        P.parse_json_events(df, charset="latin1")


def test_blob_request(spark):
    df = spark.createDataFrame(
        [({"a": ["1", "2"], "b": ["x"]}, b"\x00\x01"), ({"b": ["y"]}, b"")],
        "params map<string,array<string>>, payload binary",
    )
    good, bad = P.parse_blob_request(df, mandatory=["a"])
    assert [(r.headers, bytes(r.body)) for r in good.collect()] == [({"a": "1", "b": "x"}, b"\x00\x01")]
    assert bad.count() == 1


def test_frame_lines(spark):
    df = spark.createDataFrame([(1, "a\nbb\nrest"), (2, "a\ntoolong\nb\n"), (3, "none")], "c int, body string")
    events, refused = P.frame_lines(df, max_length=4)
    assert [(r.c, r.line_no, bytes(r.body)) for r in events.collect()] == [
        (1, 0, b"a"), (1, 1, b"bb"), (2, 0, b"a")
    ]
    assert [tuple(r) for r in refused.collect()] == [(2, 2)]


def test_schema_hash():
    # Published fingerprints of primitive schemas.
    assert FP.crc64(b'"int"') == 0x7275D51A3F395C8F
    assert FP.crc64(b'"string"') == 0x8F014872634503C7
    spaced = {"type": "record", "name": "R", "namespace": "a.b", "doc": "x",
              "fields": [{"name": "f", "type": {"type": "long"}, "default": 1}]}
    compact = '{"name":"a.b.R","type":"record","fields":[{"name":"f","type":"long"}]}'
    assert FP.canonical(json.dumps(spaced)) == compact
    assert FP.schema_hash(spaced) == FP.crc64(compact.encode()).to_bytes(8, "little").hex()
