"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.llm import credentials, crf, langid
from eventflow.llm.common import QUERIES, SQL, query, table
from eventflow.llm.decontaminate import find_contamination
from eventflow.llm.forest import nearest
from eventflow.llm.hard_negatives import mine
from eventflow.llm.lines import drop_repeated_runs
from eventflow.llm.ngram_join import similar_groups
from eventflow.llm.packing import pack_documents
from eventflow.llm.reports import LINES_SQL, MIX_SQL, NEGATIVES_SQL, RESAMPLE_SQL, WARC_SQL, mixed
from eventflow.llm.resampling import resample
from eventflow.llm.suffixes import remove_repeats
from eventflow.llm.warc import page_records, read_warc, write_warc
from eventflow.session import shared_dir

__all__ = ["QUERIES", "SQL"]


@query("op1_warc", WARC_SQL)
def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records, read back by byte ranges."""
    path = shared_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return page_records(read_warc(spark, path)).drop("target_uri")


@query("op2_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages learned from three quarters of the ids, predicted for all texts."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out("doc_id"))
    model = langid.train(docs.where("NOT held_out AND doc_id IS NOT NULL"))
    # Only the text enters a prediction.
    named = langid.identify(docs.select("doc_id", "held_out", "text"), model)
    return named.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query("op3_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans, and weak ones that complementary parts confirm."""
    found = credentials.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: ~s["linked"])

    def joined(spans):
        one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        return F.array_join(F.transform(spans, one), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.withColumn("base", base).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


@query("op4_hash_prefix_forest")
def hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every 20th vector."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op5_line_dedup", LINES_SQL)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later repeats of runs of three or more lines deleted."""
    out = drop_repeated_runs(table(spark, sf_dir, "documents"), run=3)
    return out.select(
        "doc_id", "n_lines", "n_removed", "n_runs",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


@query("op6_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    items = F.transform("contamination", lambda c: c["item_id"].cast("string"))
    return found.select(
        "doc_id", F.size("contamination").cast("long").alias("n_items"),
        F.array_join(items, ",").alias("items"),
        F.array_max(F.transform("contamination", lambda c: c["similarity"])).alias("similarity"),
    )


@query("op7_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"), length=400)
    return out.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op8_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by a field fitted on labelled pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = crf.extract(pages, crf.trained())
    return found.select(
        "page_id", "url", F.col("main_text").alias("text"),
        F.char_length("main_text").cast("long").alias("n_chars"),
    )


@query("op9_source_mixing", MIX_SQL)
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents selected so that tokens follow target weights."""
    out = mixed(table(spark, sf_dir, "documents"))
    names = [F.coalesce(F.col(c), F.lit("unknown")).alias(c) for c in ("lang", "source")]
    return out.select("doc_id", "domain", *names, "n_tokens", "copies")


@query("op10_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = similar_groups(table(spark, sf_dir, "documents"), k=4, percent=85)
    return groups.select("doc_id", "n_shingles", "component_id")


@query("op11_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokenized documents packed whole into sequences of 2,048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), max_tokens=2048)


@query("op12_importance_resampling", RESAMPLE_SQL)
def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn towards the words of the benchmark."""
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_hard_negatives", NEGATIVES_SQL)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 100th vector, labels of every seventh row moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)
