"""The pipeline on the smallest table: each stage on what its predecessor kept."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from eventflow.llm import langid, queries
from eventflow.llm.reports import WEIGHTS
from tests.conftest import SF
from tests.llm import brute
from tests.test_registry import check_oracle


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(name, rows before, rows after) of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, before, docs.collect(), docs.columns))
    return {name: rest for name, *rest in out}


def test_order_and_columns(spark, stages):
    assert list(stages) == ["language_id", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [s[2] for s in list(stages.values())[:-1]] == [columns] * 4
    assert all(s[1] for s in stages.values())


def test_language_stage(spark, stages):
    before, after, _ = stages["language_id"]
    model = langid.train(spark.read.parquet(f"{SF}/documents.parquet"))
    names, score = model.predict([r.text for r in before], langid.Subwords())
    assert after == [r for r, n, s in zip(before, names, score) if n != "und" and s >= model.reject_below]
    assert {r.doc_id for r in after} >= {r.doc_id for r in before if len(r.text.split()) >= 3}


def test_line_stage(stages):
    before, after, _ = stages["line_dedup"]
    want = brute.drop_repeated_runs([(r.doc_id, r.text) for r in before], 3)
    kept = [(r.doc_id, w[2], len(w[2])) for r, w in zip(before, want) if not w[1] or w[1] < w[0]]
    assert sorted((r.doc_id, r.text, r.n_chars) for r in after) == sorted(kept)


def test_join_stage(stages):
    before, after, _ = stages["ngram_jaccard_join"]
    groups = brute.similar_groups([(r.doc_id, r.text) for r in before], 5, 80)
    assert sorted(r.doc_id for r in after) == sorted({g[1] if g[0] else r.doc_id for r, g in zip(before, groups)})


def test_decontamination_stage(spark, stages):
    before, after, _ = stages["benchmark_decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert sorted(after) == sorted(r for r in before if not brute.contamination(r.text, items))


def test_mixing_stage(stages):
    before, after, _ = stages["source_mixing"]
    rows = [(r.doc_id, f"sites{int(r.source[3:]) % 3}", r.lang, r.source, r.text) for r in before]
    copies = brute.mix(rows, WEIGHTS, None, 2, 17)
    assert sorted((r.doc_id, r.copies) for r in after) == sorted((r[0], c) for r, c in zip(rows, copies) if c)


COLUMNS = {"language_id": "score", "line_dedup": "N_lines", "ngram_jaccard_join": "__nid", "benchmark_decontamination": "contamination"}


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_edges_of_stages(spark, name):
    """Nulls in any column, equal rows, clashing names of extra columns, empty tables."""
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in docs.schema)
    odd = docs.selectExpr(*columns.split(", ")).limit(2)
    kind = docs.schema["doc_id"].dataType.simpleString()
    for i, text in ((-1, "''"), (-2, "'12 34 ...'"), (-3, "'one short line'"), (-3, "'one short line'")):
        other = [f.name for f in docs.schema if f.name not in ("doc_id", "text")]
        row = spark.range(1).selectExpr(f"CAST({i} AS {kind}) AS doc_id", f"{text} AS text", *[f"CAST(NULL AS {docs.schema[c].dataType.simpleString()}) AS {c}" for c in other])
        odd = odd.union(row.select(*docs.columns))
    plain = docs.union(odd)
    taken = corpus_pipeline.TAKEN[name]
    extra = plain.selectExpr("*", *[f"concat('own ', coalesce(CAST(doc_id AS STRING), 'null')) AS {COLUMNS.get(name, c) if c.lower() == COLUMNS.get(name, '').lower() else c}" for c in taken], "1 AS `a.b`")
    rows = stage(spark, extra, SF)
    if name != "source_mixing":
        assert rows.columns == extra.columns
        names = {c.lower(): c for c in rows.columns}
        got = [(r["doc_id"], *(r[names[c]] for c in taken)) for r in rows.collect()]
    else:
        assert {"domain", "n_tokens", "copies", "own_domain", "own_n_tokens", "own_copies"} <= set(rows.columns)
        got = [(r["doc_id"], r["own_domain"], r["own_copies"], r["__full"]) for r in rows.collect()]
        assert all(r["copies"] > 0 for r in rows.collect())
    assert got and all(set(values) == {f"own {'null' if i is None else i}"} for i, *values in got)
    want = stage(spark, plain, SF).select("doc_id", "text").collect()
    assert sorted(map(str, want)) == sorted(str(r) for r in rows.select("doc_id", "text").collect())
    ids = [r.doc_id for r in want]
    stays = {"language_id": (0, 0), "line_dedup": (2, 2), "ngram_jaccard_join": (1, 1), "benchmark_decontamination": (2, 2)}
    if name in stays:
        assert (ids.count(None), ids.count(-3)) == stays[name] or name == "language_id"
        assert (ids.count(-1) == 1) == (name != "language_id")
    assert stage(spark, plain.where("false"), SF).count() == 0


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in check_oracle.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF).toArrow()
    want = con.execute(queries.SQL[name]).to_arrow_table()
    assert check_oracle.kinds(got) == check_oracle.kinds(want)
    assert check_oracle.rows_of(got) == check_oracle.rows_of(want)
