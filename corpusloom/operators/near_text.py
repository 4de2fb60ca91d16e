"""Removal of near texts in rank order, as a similarity join and rounds of greedy choice.

A row goes if the start of its text is near that of a kept row before it: the
ratio of matched characters (``2 * matched / both lengths``, of
``difflib.SequenceMatcher``) is at least ``ratio``. Two such texts are at most
``d = (1 - ratio) * both lengths`` insertions and deletions apart, so they share
all but ``Q * d`` of the longer one's runs of Q characters. Of each text the
``Q * d + 1`` runs that are rarest in its list are therefore enough to meet every
near text in an equi-join, and texts that only share a frequent run don't meet.
Pairs are compared by length, then by counts of characters, then exactly.

Which rows go follows from the near pairs alone: rows that no row before them is
near to stay, what is near to them goes, and so on with the pairs left. Each
round is a join over pairs; no list is gathered in a task.

Null texts count as empty. Equal starts are near. Ties in rank go to the smaller
id. Rows equal in list, rank and id are one row.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.session import stage_table

#: Characters of a run. Texts of fewer than ten are near equal ones only, longer ones have more than ``Q * d`` runs.
Q = 5


def most_apart(size: Column, ratio: float) -> Column:
    """Insertions and deletions between a text of ``size`` characters and the longest that may be near."""
    return F.floor((1 - ratio) * (size + F.floor(size * (2 - ratio) / ratio + 1e-9)) + 1e-9)


def _runs(text: Column, size: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), size - Q + 1), lambda i: F.substr(text, i, F.lit(Q)))


def candidates(texts: DataFrame, ratio: float, label: str = "near-text") -> DataFrame:
    """``list, early, late``: all near pairs of ``texts(list, node, size, start)``, distinct within a list, and some others; nodes are in order."""
    each = texts.filter(F.col("size") >= Q).select("list", "node", (most_apart(F.col("size"), ratio) * Q + 1).alias("wanted"), F.explode(_runs(F.col("start"), F.col("size"))).alias("run"))
    # a run that stands in a text several times is as many runs
    runs = each.groupBy("list", "node", "wanted", "run").agg(F.count("*").alias("times"))
    runs = runs.select("list", "node", "wanted", F.explode(F.transform(F.sequence(F.lit(1), F.col("times").cast("int")), lambda k: F.concat(F.col("run"), F.chr(k % 128), k.cast("string")))).alias("run"))
    runs = stage_table(runs, f"{label}-runs")
    often = runs.groupBy("list", "run").agg(F.count("*").alias("often")).filter("often > 1")
    met = runs.join(often, ["list", "run"], "left").withColumn("often", F.coalesce("often", F.lit(1)))
    # the rarest of each text in one array: as many as the text has characters at most
    order = F.array_sort(F.collect_list(F.struct("often", "run")))
    rare = met.groupBy("list", "node").agg(F.max("wanted").cast("int").alias("wanted"), order.alias("runs"))
    rare = rare.select("list", "node", F.explode(F.slice("runs", F.lit(1), F.col("wanted"))).alias("x")).filter("x.often > 1").select("list", "node", F.col("x.run").alias("run"))
    rare = stage_table(rare, f"{label}-rare")
    left, right = rare.withColumnRenamed("node", "early"), rare.withColumnRenamed("node", "late")
    return left.join(right, ["list", "run"]).filter("early < late").select("list", "early", "late").distinct()


def near_pairs(texts: DataFrame, ratio: float, label: str = "near-text") -> DataFrame:
    """``list, early, late`` of all near pairs of ``texts(list, node, size, start)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for late, early in zip(batch.column("b").to_pylist(), batch.column("a").to_pylist(), strict=True):
                pair = difflib.SequenceMatcher(None, late, early)
                near.append(pair.real_quick_ratio() >= ratio and pair.quick_ratio() >= ratio and pair.ratio() >= ratio)
            yield batch.select(["list", "early", "late"]).filter(pa.array(near, pa.bool_()))

    pairs = stage_table(candidates(texts, ratio, label), f"{label}-candidates")
    one = lambda end, name: texts.select("list", F.col("node").alias(end), F.col("start").alias(name), F.col("size").alias(f"{name}_size"))
    both = pairs.join(one("early", "a"), ["list", "early"]).join(one("late", "b"), ["list", "late"])
    both = both.filter(2 * F.least("a_size", "b_size") >= ratio * (F.col("a_size") + F.col("b_size")) - 1e-9)
    kind = dict(texts.dtypes)
    schema = f"list {kind['list']}, early {kind['node']}, late {kind['node']}"
    return stage_table(both.select("list", "early", "late", "a", "b").mapInArrow(run, schema), f"{label}-pairs")


def dropped(pairs: DataFrame, label: str = "near-text") -> DataFrame:
    """``list, node`` that a greedy choice in order leaves out: of the near ``pairs(list, early, late)`` the late one of each kept early one."""
    gone = pairs.select("list", F.col("late").alias("node")).limit(0)
    left = pairs
    while not left.isEmpty():
        late = left.select("list", F.col("late").alias("early")).distinct()
        now = stage_table(left.join(late, ["list", "early"], "left_anti").select("list", F.col("late").alias("node")).distinct(), f"{label}-gone")
        gone = gone.unionByName(now)
        for end in ("early", "late"):
            left = left.join(now.withColumnRenamed("node", end), ["list", end], "left_anti")
        left = stage_table(left, f"{label}-left")
    return gone


def drop_near(ranked: DataFrame, query_id: str = "query_id", ratio: float = 0.95, chars: int = 500, id_col: str = "chunk_id") -> DataFrame:
    """The rows of ``ranked(query_id, id, rank0, text, ...)`` whose first ``chars`` characters are near no kept row's before them in their list."""
    node = F.struct(F.col("rank0").cast("long").alias("rank0"), F.col(id_col).alias("id"))
    rows = stage_table(ranked.select(F.struct("*").alias("row"), F.struct(query_id).alias("list"), node.alias("node"), F.substring(F.coalesce("text", F.lit("")), 1, chars).alias("start")), "near-text-rows")
    # the first of equal starts stands for all: the others go in any case
    texts = rows.groupBy("list", "start").agg(F.min("node").alias("node")).select("list", "node", F.length("start").alias("size"), "start")
    texts = stage_table(texts, "near-text-texts")
    kept = texts.join(dropped(near_pairs(texts, ratio)), ["list", "node"], "left_anti").select("list", "node")
    return rows.join(kept, ["list", "node"]).select(*[F.col("row")[c].alias(c) for c in ranked.columns]).dropDuplicates([query_id, "rank0", id_col])
