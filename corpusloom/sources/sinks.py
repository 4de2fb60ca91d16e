"""Sinks (K rows)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.operators.relational import last_wins, upsert
from corpusloom.sources.readers import exists


def write_jsonl(df: DataFrame, path: str, partitions: list[str] | None = None) -> None:
    """K1."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partitions) if partitions else writer).json(path)


def write_csv(df: DataFrame, path: str, columns: list[str], compression: str = "none") -> None:
    """K3: the named columns, all quoted."""
    df.select(columns).write.mode("overwrite").option("compression", compression).option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def put_in_place(spark: SparkSession, staged: str, path: str) -> None:
    """Folder ``staged`` becomes ``path`` by renames: at any moment the old or the new rows stand whole in one of ``path``, ``path.old`` and ``staged``.

    ``recover`` ends what a lost run left half done. On stores where a rename copies, the same holds, only slower.
    """
    fs, at = _files(spark, path)
    live, old, new = at(path), at(f"{path.rstrip('/')}.old"), at(staged)
    fs.delete(old, True)
    if fs.exists(live) and not fs.rename(live, old):
        raise OSError(f"can't move {path} aside")
    if not fs.rename(new, live):
        raise OSError(f"can't put {staged} in place")
    fs.delete(old, True)


def recover(spark: SparkSession, path: str) -> None:
    """After a lost ``put_in_place``: where ``path`` is gone, the old table comes back; leftovers beside a live one go."""
    fs, at = _files(spark, path)
    live, old = at(path), at(f"{path.rstrip('/')}.old")
    if fs.exists(old):
        if fs.exists(live):
            fs.delete(old, True)
        elif not fs.rename(old, live):
            raise OSError(f"can't bring back {path}")


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def delete(spark: SparkSession, path: str) -> None:
    """A file or folder goes, if it is there."""
    fs, at = _files(spark, path)
    fs.delete(at(path), True)


def write_upsert(source: DataFrame, path: str, keys: list[str], seq: str = "seq") -> None:
    """K4, K5: merge into a Parquet table; a run lost at any step leaves the old or the new table whole (``put_in_place``)."""
    spark = source.sparkSession
    recover(spark, path)
    merged = upsert(spark.read.parquet(path), source, keys, seq) if exists(spark, path) else last_wins(source, keys, seq)
    staged = path.rstrip("/") + ".next"
    merged.write.mode("overwrite").parquet(staged)
    put_in_place(spark, staged, path)


def feedback_rows(df: DataFrame) -> DataFrame:
    """K6: query id from the query, blank expert ``anonymous``, blank comment null."""
    return df.withColumn("query_id", F.substring(F.sha2("query_text", 256), 1, 16)).withColumn("expert_id", F.coalesce(F.nullif(F.trim("expert_id"), F.lit("")), F.lit("anonymous"))).withColumn("comment", F.nullif(F.trim("comment"), F.lit("")))


def write_checked(df: DataFrame, path: str, checks: dict[str, Callable[[DataFrame], bool]]) -> None:
    """K7: staged, checked, and only then put in place; a run lost at any step leaves the old or the new table whole."""
    spark = df.sparkSession
    recover(spark, path)
    staged = path.rstrip("/") + ".staged"
    df.write.mode("overwrite").parquet(staged)
    found = spark.read.parquet(staged)
    failed = [name for name, check in checks.items() if not check(found)]
    if failed:
        raise ValueError(f"checks failed: {', '.join(failed)}")
    put_in_place(spark, staged, path)


def write_report(metrics: DataFrame, path: str) -> None:
    """K8: one JSON object per stage with averages and the rows of each query."""
    values = [c for c in metrics.columns if c not in ("stage", "id", "query", "retrieved", "relevant")]
    per = F.collect_list(F.struct(*[c for c in metrics.columns if c != "stage"])).alias("per_query")
    metrics.groupBy("stage").agg(F.count("*").alias("n_queries"), F.struct(*[F.avg(v).alias(v) for v in values]).alias("averages"), per).write.mode("overwrite").json(path)


def write_triplets(df: DataFrame, path: str) -> None:
    """K9."""
    df.select("query", "positive", "negative", "positive_chunk_id", "negative_chunk_id", "negative_score").write.mode("overwrite").json(path)
