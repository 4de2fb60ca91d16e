"""Corpus profile and checks (V rows, U3)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class SourceSpec:
    name: str
    min_records: int
    required: tuple[str, ...]


#: Minimum rows and required fields of each source.
SPECS = {
    "statutes": SourceSpec("statutes", 500, ("id", "source", "text", "section_citation", "chapter_num", "act_id")),
    "admin_code": SourceSpec("admin_code", 200, ("id", "source", "text", "section_citation", "title_num", "part_num")),
    "directives": SourceSpec("directives", 50, ("id", "source", "text", "title", "category")),
    "policy_reports": SourceSpec("policy_reports", 50, ("id", "source", "text", "title", "category")),
    "annual_reports": SourceSpec("annual_reports", 5, ("id", "source", "text", "title", "fiscal_year")),
    "federal": SourceSpec("federal", 3, ("id", "source", "text", "title", "citation")),
    "advocacy": SourceSpec("advocacy", 10, ("id", "source", "text", "page_title", "section")),
    "defender": SourceSpec("defender", 5, ("id", "source", "text", "page_title", "category")),
}


def profile(df: DataFrame, id_col: str = "id", text: str = "text", source: str = "source", stub: int = 100) -> DataFrame:
    """One row of counters in one pass, plus the duplicate ids."""
    blank = F.coalesce(F.trim(text), F.lit("")) == ""
    counts = df.agg(
        F.count("*").alias("n_rows"), F.count_if(blank).alias("empty_text"), F.count_if(~blank & (F.length(text) < stub)).alias("stubs"),
        F.count_distinct(source).alias("n_sources"), F.count_if(F.col(id_col).isNull()).alias("missing_id"),
    )
    twice = df.groupBy(id_col).count().filter("count > 1").agg(F.count("*").alias("duplicate_ids"), F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("extra_rows"))
    return counts.crossJoin(twice)


def verdict(profiled: DataFrame, min_records: int) -> DataFrame:
    stub_ratio = F.coalesce(F.try_divide(F.col("stubs").cast("double"), F.col("n_rows")), F.lit(0.0))
    fail = (F.col("n_rows") < min_records) | (F.col("n_rows") == 0) | (F.col("duplicate_ids") > 0) | (F.col("empty_text") > 0)
    warn = (stub_ratio > 0.2) | (F.col("n_sources") > 3)
    return profiled.withColumn("status", F.when(fail, "fail").when(warn, "warn").otherwise("ok"))


def missing_fields(raw: DataFrame, required: tuple[str, ...], json_col: str = "raw") -> DataFrame:
    """Required keys absent from each JSON record; a key with a null value is present."""
    have = F.coalesce(F.json_object_keys(json_col), F.array().cast("array<string>"))
    return raw.withColumn("missing", F.array_except(F.array(*[F.lit(r) for r in required]), have))


def leaks(df: DataFrame, predicate, n: int = 3) -> DataFrame:
    """V5: up to n rows that a filter should have dropped."""
    return df.filter(~F.coalesce(predicate, F.lit(False))).limit(n)


def label_check(label) -> object:
    """V6."""
    return label.isin("BINDING", "RELEVANT", "IRRELEVANT")
