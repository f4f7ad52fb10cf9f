"""A corpus from raw documents: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

import sys
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from eventflow.llm import langid  # noqa: E402
from eventflow.llm.common import table  # noqa: E402
from eventflow.llm.decontaminate import decontaminate  # noqa: E402
from eventflow.llm.lines import drop_repeated_runs  # noqa: E402
from eventflow.llm.ngram_join import one_of_each  # noqa: E402
from eventflow.llm.reports import mixed  # noqa: E402
from eventflow.session import shared_dir  # noqa: E402

#: Trained and fuzzy stages are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


BATCH_BYTES = 8 << 20  # of texts that a task holds at once

#: Names that the operators use themselves, beside the columns of documents.
TAKEN = {
    "language_id": ("lang_pred", "score", "rejected"),
    "line_dedup": ("n_lines", "n_removed", "n_runs", "__run_key", "__run_starts"),
    "ngram_jaccard_join": ("__nid",),
    "benchmark_decontamination": ("contamination",),
    "source_mixing": (
        "domain", "n_tokens", "copies", "__domain", "__lang", "__source", "__id", "__tokens", "__full",
        "__cut", "__copies",
    ),
}


def stage(function):
    """A stage that leaves columns of the caller alone, also those with a taken or a dotted name.

    Such a column has another name while the operator runs and gets its own one back; where
    the stage itself returns a column of that name, it becomes ``own_<name>``. Batches sent
    to Python are cut by bytes (a session setting), so memory does not hang on text lengths.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        aside = {
            c: f"__aside_{i}" for i, c in enumerate(docs.columns)
            if c.lower() in TAKEN[function.__name__] or "." in c or "`" in c
        }
        out = function(spark, docs.withColumnsRenamed(aside), sf_dir)
        held = {c.lower() for c in out.columns}
        back = {}
        for name, other in aside.items():
            back[other] = name if name.lower() not in held else f"own_{name}"
            while back[other].lower() in held and back[other] != name:
                back[other] = f"own_{back[other]}"
        return out.withColumnsRenamed(back)

    return run_stage


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; a missing language is filled in.

    A text that is null, empty or without letters is not recognised. Null ids and sources
    stay; equal rows all stay or all go. An empty table, or one without a language to learn
    from, gives no rows. Other columns stay, whatever their names.
    """
    model = langid.train(docs)
    named = langid.identify(docs, model).where("NOT rejected")
    return named.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of three or more lines deleted; a document that loses all lines goes.

    Null and empty texts stay. The first place by id stays, null ids come last; rows with
    equal id and text are one place, so all stay. ``n_chars`` follows a changed text. An
    empty table gives no rows. Other columns stay, whatever their names.
    """
    out = drop_repeated_runs(docs, run=3).where("n_removed = 0 OR n_removed < n_lines")
    changed = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long"))
    return out.withColumn("n_chars", F.coalesce(changed, "n_chars")).select(*docs.columns)


@stage
def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 5-word shingles, similarity 0.8.

    The least id stays, null ids come last; rows with equal id and text are one document.
    Documents without a word (null and empty ones too) are no copies of other ids. An empty
    table gives no rows. Other columns stay, whatever their names.
    """
    return one_of_each(docs, k=5, percent=80)


@stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null, empty and short texts hold none and stay; equal rows all stay or all go. An empty
    table gives no rows, an empty benchmark takes none. Other columns stay, whatever their names.
    """
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


@stage
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights, with the number of copies to take.

    Adds ``domain``, ``n_tokens`` and ``copies``; own columns of these names become
    ``own_domain`` and so on. Null languages and sources count as "unknown"; null and empty
    texts take no token. Rows of a leaf with equal ids are taken together or not at all. An
    empty table gives no rows.
    """
    return mixed(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, made from the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
