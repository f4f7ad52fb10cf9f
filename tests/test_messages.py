import pytest
from pyspark.sql import functions as F

from eventflow.sources import messages as M
from eventflow.sources import tables as T


def rows(df):
    return [(r.headers, bytes(r.body)) for r in df.collect()]


def test_topic_headers(spark):
    df = spark.createDataFrame(
        [(b"k", b"v", "t", 3), (None, None, "t", 0)], "key binary, value binary, topic string, partition int"
    )
    got = rows(M.topic_to_events(df, clock=F.lit(9)))
    assert got == [
        ({"timestamp": "9", "topic": "t", "partition": "3", "key": "k"}, b"v"),
        ({"timestamp": "9", "topic": "t", "partition": "0"}, b""),
    ]
    got = rows(M.topic_to_events(df, clock=F.lit(9), set_topic_header=False))
    assert "topic" not in got[0][0]


def test_amqp_user_headers_win_but_routing_wins_over_all(spark):
    df = spark.createDataFrame(
        [("a", "ex", "", {"app-id": "mine", "exchange": "user", "x": None}, b"b")],
        "app_id string, exchange string, routing_key string, headers map<string,string>, body binary",
    )
    assert rows(M.amqp_to_events(df)) == [({"app-id": "mine", "exchange": "ex", "x": ""}, b"b")]


def test_jms_null_text_is_empty(spark):
    df = spark.createDataFrame(
        [({"a": "1"}, "text", None, None), ({}, "text", "ü", None), ({}, "bytes", None, b"\x01")],
        "properties map<string,string>, type string, text string, bytes binary",
    )
    assert rows(M.jms_to_events(df, "ISO-8859-1")) == [({"a": "1"}, b""), ({}, b"\xfc"), ({}, b"\x01")]


def test_legacy_fields_lose_to_the_marker(spark):
    df = spark.createDataFrame(
        [("h", 5, "INFO", 7, {"host": b"other", "legacy": b"no"}, b"b")],
        "host string, timestamp long, priority string, nanos long, fields map<string,binary>, body binary",
    )
    assert rows(M.legacy_to_events(df)) == [
        ({"host": "other", "timestamp": "5", "pri": "INFO", "nanos": "7", "legacy": "yes"}, b"b")
    ]


def test_batches_are_bounded(spark):
    df = spark.range(250).select(
        F.lit(1).alias("hot"), "id", F.create_map(F.lit("n"), F.col("id").cast("string")).alias("headers"),
        F.lit(b"x").alias("body"),
    )
    batches = M.events_to_batches(df, ["hot"], "id", size=100)
    assert sorted(r[0] for r in batches.select(F.size("batch")).collect()) == [50, 100, 100]
    assert M.batches_to_events(batches).count() == 250


def test_log_records_fan_out(spark):
    df = spark.createDataFrame([("l", 1, 20000, ["a", "b"])], "logger string, ts_ms long, level int, messages array<string>")
    got = rows(M.logs_to_events(df))
    assert [b for _, b in got] == [b"a", b"b"] and got[0][0]["client.log.message.encoding"] == "UTF8"


def test_table_rows(spark):
    df = spark.createDataFrame([("string1", 1, None)], "a string, b int, c date")
    assert rows(T.rows_to_events(df, clock=F.lit(3))) == [({"timestamp": "3"}, b'"string1","1",""')]
    assert rows(T.rows_to_events(df.limit(0))) == []


def test_incremental_status(tmp_path):
    path = f"file://{tmp_path}/status.json"
    fresh = T.ReadStatus("s", "jdbc:x", "t", "*", None, "0")
    assert T.load_status(path, fresh) == fresh
    T.save_status(path, T.ReadStatus("s", "jdbc:x", "t", "*", None, "40"))
    assert T.load_status(path, fresh).last == "40"
    other = T.ReadStatus("s", "jdbc:y", "t", "*", None, "0")
    assert T.load_status(path, other).last == "0"
    assert (tmp_path / "status.json.bak").exists()


def test_incremental_queries(spark):
    assert T.page_query("t", "a, b", "a", "20", 10) == (
        "SELECT a, b FROM t ORDER BY a OFFSET 20 ROWS FETCH NEXT 10 ROWS ONLY"
    )
    assert T.custom_query("SELECT * FROM t WHERE id > $@$", "7") == "SELECT * FROM t WHERE id > 7"
    paged = T.ReadStatus("s", "u", "t", "*", None, "20")
    assert T.advance(paged, spark.range(10)).last == "30"
    custom = T.ReadStatus("s", "u", None, None, "q", "7")
    assert T.advance(custom, spark.range(8, 12)).last == "11"
    assert T.advance(custom, spark.range(0)).last == "7"


def test_poll_moves_only_after_success(spark, tmp_path):
    table = [(i, f"v{i}") for i in range(25)]
    path, seen = f"file://{tmp_path}/s.json", []
    fresh = T.ReadStatus("s", "jdbc:x", "t", "*", None, "0")

    def read(spark, url, status, order_by, max_rows):
        at = int(status.last)
        return spark.createDataFrame(table[at : at + max_rows], "id int, v string")

    def fail(rows):
        raise OSError("sink is down")

    with pytest.raises(OSError):
        T.poll(spark, "jdbc:x", path, fresh, fail, order_by="id", max_rows=10, read=read)
    for _ in range(4):
        T.poll(
            spark, "jdbc:x", path, fresh, lambda df: seen.extend(r.id for r in df.collect()),
            order_by="id", max_rows=10, read=read,
        )
    assert seen == list(range(25))
    assert T.load_status(path, fresh).last == "25"
