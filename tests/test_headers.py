"""Header edits against a dictionary."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventflow.functions import headers as H

maps = st.dictionaries(st.sampled_from("abcd"), st.one_of(st.none(), st.sampled_from("xyz")), max_size=4)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(maps, maps), min_size=5, max_size=20), maps.filter(bool))
def test_edits(spark, pairs, entries):
    df = spark.createDataFrame(pairs, "h map<string,string>, t map<string,string>")
    h, t = F.col("h"), F.col("t")
    new = {k: F.lit(v).cast("string") for k, v in entries.items()}
    got = df.select(
        H.put(h, new), H.put(h, new, preserve=True), H.put_present(h, new), H.overlay(h, t), H.render(h)
    ).collect()
    for row, (base, top) in zip(got, pairs):
        present = {k: v for k, v in entries.items() if v is not None}
        assert row[0] == {**base, **entries}
        assert row[1] == {**entries, **base}
        assert row[2] == {**base, **present}
        assert row[3] == {**base, **top}
        shown = ", ".join(f"{k}={'null' if v is None else v}" for k, v in sorted(base.items()))
        assert row[4] == "{" + shown + "}"
