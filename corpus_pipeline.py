"""A training-corpus pipeline: five stages, each calling one operator.

Every stage takes (spark, docs, sf_dir), works on all that the stage before
kept and returns a DataFrame; :func:`run` writes each stage's rows as Parquet
in the shared checkpoint folder and reads them back as the next one's input.
All stages but the last return the columns of ``documents``:

1. ``quality``: documents that the classifier rejects (score under 0.3) go.
2. ``line_dedup``: repeated lines go, but for the smallest ``doc_id`` with one.
3. ``simhash_dedup``: of each group of near copies the smallest ``doc_id`` stays.
4. ``decontaminate``: documents that hold a benchmark window go.
5. ``mix``: the words of the rest in blocks, mixed to the sources' targets; a
   row per slot and document in it (shard, slot, piece, the document's columns,
   words, text).

``n_chars`` follows the text where a stage changes it.  Rows with a null
``doc_id`` pass all stages (they never are a group's smallest document).
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import decontaminate as benchmarks
from stratum.llm import knn_quality, line_runs, simhash_trie, source_mix
from stratum.llm.common import table, written
from stratum.session import apply_defaults

MIN_SCORE = 0.3


def with_defaults(stage):
    """A stage may be called by itself: it sets the library's session defaults
    (small Arrow batches among them) where the session has none."""
    @wraps(stage)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        apply_defaults(spark)
        return stage(spark, docs, sf_dir)
    return call


@with_defaults
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = knn_quality.score_quality(docs, table(spark, sf_dir, "labels"), knn_quality.in_training())
    return scored.where(F.col(scored.columns[-1]) >= MIN_SCORE).select(*docs.columns)


@with_defaults
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_runs.dedup_lines(docs).select(*docs.columns)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


@with_defaults
def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    grouped = simhash_trie.simhash_components(docs, shingle=4, max_bits=4)
    component = F.col(grouped.columns[-1])
    return grouped.where(F.col("doc_id").isNull() | (F.col("doc_id") == component)).select(*docs.columns)


@with_defaults
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return benchmarks.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents")


@with_defaults
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.mix_sources(docs)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup),
          ("decontaminate", decontaminate), ("mix", mix)]

#: The classifier and the draw of the mix are beyond SQL; tests hold the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
