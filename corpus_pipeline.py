"""The corpus pipeline: toxicity, line dedup, near-duplicates, decontamination, token ids.

Each stage takes all rows its predecessor kept and returns the columns of
``documents`` (the last one token ids). Each keeps null and empty texts unless
its operator says otherwise: such rows aren't toxic, lose no lines, have no
duplicates, hold no leaks and have no tokens.

A stage returns a plan that is run later, so the size of its Arrow batches can't
be held for a while as the operators do: the pipeline sets it for its session, as
a batch of whole documents stands several times outside the heap of an executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm import decontaminate, line_dedup, near_dup, sentencepiece_codec, toxicity
from corpusloom.llm.names import unused
from corpusloom.session import stage_table

#: Rows of an Arrow batch of documents, unless the session has fewer.
BATCH_ROWS = 512
#: SQL can't express the stages; tests/llm compare them with brute force.
ORACLE_SQL = None


def small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at or above the threshold go."""
    small_batches(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~toxicity.held_out())
    score = unused(docs.columns, "toxicity_score")
    scored = toxicity.score_documents(docs, model, score)
    return scored.filter(F.col(score) < toxicity.THRESHOLD).drop(score)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of equal and near lines the first stays; rows keep their place with what text is left."""
    small_batches(spark)
    return line_dedup.line_dedup(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest doc_id; repeated rows of one doc_id become one."""
    small_batches(spark)
    return near_dup.drop_duplicates(docs, size=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    small_batches(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens`` and the checks of the codec."""
    small_batches(spark)
    return sentencepiece_codec.encode_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
