import pytest
from pyspark.sql import functions as F

from eventflow.operators import routing as R
from eventflow.operators.indexing import with_arrival_index
from eventflow.schema import EVENT_SCHEMA, make_rows

MAPPING = {"foo": "ch1 ch2", "bar": "ch2 ch3", "xyz": "ch1 ch2 ch3"}
OPTIONAL = {"foo": "ch2 ch3", "xyz": "ch1 ch3", "zebra": "ch1 ch2"}
CHANNELS = ["ch1", "ch2", "ch3"]


@pytest.mark.parametrize(
    "value, required, optional",
    [
        ("foo", "ch1 ch2", "ch3"),
        ("bar", "ch2 ch3", ""),
        ("xyz", "ch1 ch2 ch3", ""),
        ("zebra", "ch1 ch3", "ch2"),
        ("bar1", "ch1 ch3", ""),
        (" foo", "ch1 ch3", ""),
        ("  ", "ch1 ch3", ""),
        (None, "ch1 ch3", ""),
        ("absent", "ch1 ch3", ""),
    ],
)
def test_multiplex_table(spark, value, required, optional):
    headers = {} if value == "absent" else {"myheader": value}
    df = spark.createDataFrame(make_rows([(headers, "x")]), EVENT_SCHEMA)
    rows = R.multiplex(df, "myheader", MAPPING, "ch1 ch3", OPTIONAL, CHANNELS).collect()
    assert [r.channel for r in rows if r.required] == required.split()
    assert [r.channel for r in rows if not r.required] == optional.split()


def test_multiplex_configuration_errors():
    with pytest.raises(ValueError):
        R.channel_names("ch9", CHANNELS)
    with pytest.raises(ValueError):
        R.multiplex_columns(None, {"a": ""}, "ch1")


def test_multiplex_without_channels_drops(spark):
    df = spark.createDataFrame(make_rows([({}, "x")]), EVENT_SCHEMA)
    assert R.multiplex(df, "h", {"a": "c"}).count() == 0


def test_replicate(spark):
    df = spark.createDataFrame(make_rows([({}, "x")]), EVENT_SCHEMA)
    rows = R.replicate(df, ["a", "b", "c"], optional=["b"]).collect()
    assert [(r.channel, r.required) for r in rows] == [("a", True), ("c", True), ("b", False)]


def test_round_robin_rotates_both_lists(spark):
    df = spark.createDataFrame([(i, {}, b"") for i in range(7)], "k int, headers map<string,string>, body binary")
    rows = R.round_robin(df, ["a", "b", "c", "o"], optional=["o"], order_by=["k"]).collect()
    got = {r.k: r.channel for r in rows if r.required}
    assert [got[i] for i in range(7)] == list("abcabca")
    assert sum(not r.required for r in rows) == 7


def test_round_robin_without_order_is_even_per_task(spark):
    df = spark.range(0, 900, 1, 3).select(F.create_map().cast("map<string,string>").alias("headers"), F.lit(b"").alias("body"))
    counts = {r.channel: r["count"] for r in R.round_robin(df, ["a", "b", "c"]).groupBy("channel").count().collect()}
    assert counts == {"a": 300, "b": 300, "c": 300}


@pytest.mark.parametrize("hot", [False, True])
def test_arrival_index_is_dense_even_with_a_hot_first_key(spark, hot):
    first = F.lit(1) if hot else F.pmod(F.xxhash64("id"), F.lit(50))
    df = spark.range(5000).select(first.alias("a"), F.col("id").alias("b"))
    rows = with_arrival_index(df, ["a", "b"], "i").collect()
    ordered = sorted((r.a, r.b) for r in rows)
    assert [ordered[r.i] for r in rows] == [(r.a, r.b) for r in rows]


def test_arrival_index_spreads_a_hot_key(spark):
    df = spark.range(8000).select(F.lit(1).alias("a"), F.col("id").alias("b"))
    placed = df.repartitionByRange(8, "a", "b").groupBy(F.spark_partition_id().alias("p")).count()
    assert placed.count() == 8


def test_balance_needs_sinks_and_order(spark):
    df = spark.range(4)
    with pytest.raises(ValueError):
        R.split_balance(df, ["a"], order_by=["id"])
    with pytest.raises(ValueError):
        R.split_balance(df, ["a", "b"])
    with pytest.raises(ValueError):
        R.split_balance(df, ["a", "b"], mode="other", order_by=["id"])


def test_partition_header_must_be_a_number(spark):
    df = spark.createDataFrame(make_rows([({"p": "x"}, "")]), EVENT_SCHEMA)
    with pytest.raises(Exception):
        R.to_partition(df, "p").collect()


def test_union_keeps_duplicates(spark):
    df = spark.createDataFrame(make_rows([({}, "x")]), EVENT_SCHEMA)
    assert R.union_flows(df, df, df).count() == 3
