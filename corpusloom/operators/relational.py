"""Joins, deduplication, aggregates, windows and set operations (J, D, A, W, U, O rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def keep_longest(df: DataFrame, keys: list[str], text: str = "text", seq: str = "seq") -> DataFrame:
    return first_by(df, keys, F.length(text).desc_nulls_last(), F.col(seq).asc())


def last_wins(df: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    return first_by(df, keys, F.col(seq).desc())


def upsert(target: DataFrame, source: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """K5: source rows (last per key) replace or join the target's."""
    new = last_wins(source, keys, seq).select(target.columns)
    return new.unionByName(target.join(new.select(keys), keys, "left_anti"))


def left_lookup(facts: DataFrame, dim: DataFrame, key: str, columns: list[str], seq: str | None = None) -> DataFrame:
    """The dimension's columns, missing ones blank; of repeated dimension ids the last counts."""
    one = last_wins(dim, [key], seq) if seq else dim.dropDuplicates([key])
    out = facts.join(one.select(key, *columns), key, "left")
    return out.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns})


def semi_cascade(levels: list[tuple[DataFrame, str, str]], base: DataFrame) -> DataFrame:
    """From the top down, each level keeps the rows whose parent was kept; levels are (frame, own id, parent id)."""
    kept, own = base, None
    for frame, parent, own_id in levels:
        ids = kept.select(F.col(own or own_id).alias(parent)) if own else kept.select(F.col(parent))
        kept, own = frame.join(ids.distinct(), parent, "left_semi"), own_id
    return kept


def not_done(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """J4."""
    return df.join(done.select(keys).distinct(), keys, "left_anti")


def merge_sides(bulk: DataFrame, api: DataFrame, key: str, size: str = "token_count") -> DataFrame:
    """Per key the side with more tokens, a tie to ``api``; returns ``key, side, bulk_tokens, api_tokens``."""
    total = lambda df, name: df.groupBy(key).agg(F.sum(size).alias(name))
    both = total(bulk, "bulk_tokens").join(total(api, "api_tokens"), key, "full")
    side = F.when(F.col("api_tokens").isNull() | (F.col("bulk_tokens") > F.col("api_tokens")), "bulk").otherwise("api")
    return both.withColumn("side", side)


def merged_rows(bulk: DataFrame, api: DataFrame, key: str, size: str = "token_count") -> DataFrame:
    chosen = merge_sides(bulk, api, key, size)
    part = lambda df, name: df.join(chosen.filter(F.col("side") == name).select(key), key, "left_semi").withColumn("side", F.lit(name))
    return part(bulk, "bulk").unionByName(part(api, "api"), allowMissingColumns=True)


def overlap_report(merged: DataFrame) -> DataFrame:
    """A14."""
    b, a = F.col("bulk_tokens").isNotNull(), F.col("api_tokens").isNotNull()
    return merged.agg(F.count_if(b & ~a).alias("bulk_only"), F.count_if(a & ~b).alias("api_only"), F.count_if(a & b).alias("both"), F.count("*").alias("total"))


def numbered(df: DataFrame, parent: list[str], *order: Column) -> DataFrame:
    """0-based index and total per parent."""
    return df.withColumn("chunk_index", F.row_number().over(Window.partitionBy(*parent).orderBy(*order)) - 1).withColumn("chunk_total", F.count("*").over(Window.partitionBy(*parent)))


def heading_sections(lines: DataFrame, key: str, pos: str, heading: Column) -> DataFrame:
    """Lines numbered by the count of headings so far."""
    w = Window.partitionBy(key).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("section", F.sum(heading.cast("int")).over(w))


def fill_forward(df: DataFrame, key: str, pos: str, columns: list[str]) -> DataFrame:
    """W5."""
    w = Window.partitionBy(key).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def collection_precision(feedback: DataFrame) -> DataFrame:
    """A1, J8, W9."""
    per = feedback.groupBy("collection_id").agg(
        F.count("*").alias("shown"), F.count_if(F.col("label") == "BINDING").alias("binding"), F.count_if(F.col("label") == "RELEVANT").alias("relevant"),
        F.count_if(F.col("label") == "IRRELEVANT").alias("irrelevant"), F.round(F.avg("rrf_score").cast("decimal(20,10)"), 5).alias("avg_rrf"), F.round(F.avg("ce_score").cast("decimal(20,10)"), 3).alias("avg_ce"),
    )
    shown = F.col("shown").cast("decimal(20,6)")
    total = F.sum("shown").over(Window.partitionBy(F.lit(1))).cast("decimal(20,6)")
    return per.withColumn("share", F.round(shown * 100 / total, 1).cast("double")).withColumn("precision", F.round((F.col("binding") + F.col("relevant")).cast("decimal(20,6)") * 100 / F.nullif(shown, F.lit(0).cast("decimal(20,6)")), 1).cast("double"))


def training_triplets(rows: DataFrame) -> DataFrame:
    """Per query the best positive and the hardest negative by score (null 0, ties to the smaller id)."""
    side = lambda cond, name: first_by(rows.filter(cond & F.col("text").isNotNull()), ["query"], F.coalesce("ce_score", F.lit(0.0)).desc(), F.col("chunk_id").asc()).select("query", F.col("text").alias(name), F.col("chunk_id").alias(f"{name}_chunk_id"), F.coalesce("ce_score", F.lit(0.0)).alias(f"{name}_score"))
    return side(F.col("label").isin("BINDING", "RELEVANT"), "positive").join(side(F.col("label") == "IRRELEVANT", "negative"), "query")
