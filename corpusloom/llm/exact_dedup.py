"""Exact dedup of arriving batches against immutable snapshots, screened by static binary-fuse filters.

A snapshot holds the texts (normalised) that were new when it was made, in a
table bucketed by digest, and for each shard of the digests a binary-fuse filter.
It is never changed: a later batch makes a snapshot of its own.

A batch is reduced to one row a digest first, so that copies within it are
grouped apart and a digest that a third of all rows share is screened once. The
digests are dealt in blocks to their shard's filter; what passes (all that are
known, one in 256 of the others) meets the snapshot's buckets in an equi-join
and is compared byte by byte. Only texts of such digests and of those that the
batch repeats move; the least and the greatest text of a digest are equal exactly
if all are, which needs one row a task and digest.

Texts that share a digest but not their bytes are told apart in a second pass: one
text, the first that was stored or the least of the batch, keeps the digest as
its class key, that of the others is the digest and the text.

Defined results: a null text counts as empty. Whitespace of ``[\\x20\\x09-\\x0D]``
doesn't count. Of equal texts the row with the most code points stays, then that
of the smallest doc_id (null last), then one of the repeated rows; ``keep_id`` is
its doc_id. Texts of any length are compared whole. Only named columns are read.
An empty table returns no row.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.llm import fuse_filter
from corpusloom.llm.bitmap import maybe_in
from corpusloom.llm.numbering import join_hot
from corpusloom.session import setting, shared_dir, stage_table

BLANKS = " \t\n\x0b\x0c\r"
#: Digests of a filter, about, and of a block that is screened by one.
FILTER_KEYS, BLOCK_KEYS = 1 << 16, 1 << 16
#: Bytes of texts in a bucket, about, and the most buckets.
BUCKET_BYTES, MAX_BUCKETS = 32 << 20, 50_000


def normalised(text: Column) -> Column:
    return reduce(lambda c, blank: F.replace(c, F.lit(blank), F.lit("")), BLANKS, F.coalesce(text, F.lit("")))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@dataclass
class Snapshot:
    """``table``: texts (class_key, norm) bucketed by key; ``filters(shard, seed, segment, cells)``; how many shards."""

    table: str
    filters: DataFrame
    shards: int


def _shard(shards: int) -> Column:
    return F.pmod(F.col("h"), F.lit(shards)).cast("int").alias("shard")


def build_filters(keys: DataFrame, shards: int, label: str) -> DataFrame:
    """A filter for each shard of ``keys(h)``."""

    def run(table: pa.Table) -> pa.Table:
        made = fuse_filter.build(table.column("h").to_numpy())
        one = [[table.column("shard")[0].as_py()], [made.seed], [made.segment], [made.cells.tobytes()]]
        return pa.table(dict(zip(("shard", "seed", "segment", "cells"), map(pa.array, one, (pa.int32(), pa.int64(), pa.int64(), pa.binary())), strict=True)))

    return stage_table(keys.select(_shard(shards), "h").groupBy("shard").applyInArrow(run, "shard int, seed long, segment long, cells binary"), label)


def screen(keys: DataFrame, n: int, snapshot: Snapshot) -> DataFrame:
    """The keys of ``keys(class_key, h)``, n of them and none twice, that the snapshot's filters let pass."""
    blocks = max(1, -(-n // (snapshot.shards * BLOCK_KEYS)))

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not len(asked) or not len(held):
            return asked.select(["class_key"]).slice(0, 0)
        one = held.to_pylist()[0]
        made = fuse_filter.Fuse(one["seed"], one["segment"], np.frombuffer(one["cells"], np.uint8))
        return asked.select(["class_key"]).filter(pa.array(made.has(asked.column("h").to_numpy())))

    asked = keys.select(_shard(snapshot.shards), F.pmod(F.xxhash64("h"), F.lit(blocks)).cast("int").alias("block"), "class_key", "h").groupBy("shard", "block")
    held = snapshot.filters.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("shard", "block", "seed", "segment", "cells").groupBy("shard", "block")
    return asked.cogroup(held).applyInArrow(run, "class_key binary")


def commit(texts: DataFrame, old: DataFrame, n: int, size: int, label: str) -> Snapshot:
    """A snapshot of ``texts(class_key, norm)``, rows to group by key, without the keys of ``old``: n keys of ``size`` bytes."""
    spark = texts.sparkSession
    table = f"corpusloom_{label}_{uuid.uuid4().hex}".replace("-", "_")
    buckets = min(MAX_BUCKETS, max(1, -(-size // BUCKET_BYTES)))
    # grouped into as many partitions as there are buckets: each is one file
    with setting(spark, "spark.sql.shuffle.partitions", str(buckets)):
        one = texts.groupBy("class_key").agg(F.min("norm").alias("norm")).join(old, "class_key", "left_anti")
        one.write.bucketBy(buckets, "class_key").sortBy("class_key").option("path", f"{shared_dir(spark)}/snapshots/{table}").saveAsTable(table)
    shards = max(1, -(-n // FILTER_KEYS))
    return Snapshot(table, build_filters(spark.table(table).select(F.xxhash64("class_key").alias("h")), shards, f"{label}-filters"), shards)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _clash(checked: DataFrame, known: DataFrame) -> DataFrame:
    """``class_key, base``: keys whose texts differ, within the batch or from the snapshots' text, and the text that keeps the key."""
    both = checked.join(known, "class_key", "left").filter("norm <> top or not same")
    return both.select("class_key", F.coalesce("kept", "norm").alias("base"))


class Dedup:
    """Snapshots of what has been ingested, and the batches' rows by class."""

    def __init__(self, spark: SparkSession, label: str = "exact", digest: Callable[[Column], Column] = sha256):
        self.spark, self.label, self.digest = spark, label, digest
        self.snapshots: list[Snapshot] = []
        self.rows: list[DataFrame] = []
        self.classes: list[DataFrame] = []

    def ingest(self, batch: DataFrame, last: bool = False) -> None:
        """Take in ``batch(doc_id, text)``; a ``last`` one makes no snapshot."""
        label = f"{self.label}-{len(self.rows)}"
        norm = normalised(F.col("text"))
        whole = batch.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("points"), norm.alias("norm")).withColumn("class_key", self.digest(F.col("norm")))
        rows, groups, checked, known = self._group(whole, label)
        clash = stage_table(_clash(checked, known), f"{label}-clash")
        if not clash.isEmpty():
            told = F.when(F.col("norm") != F.col("base"), F.concat("class_key", F.encode("norm", "UTF-8"))).otherwise(F.col("class_key"))
            whole = whole.join(clash, "class_key", "left").withColumn("class_key", told).drop("base")
            rows, groups, checked, known = self._group(whole, f"{label}-told")
        self.rows.append(rows)
        self.classes.append(groups)
        if last:
            return
        old = known.select("class_key")
        new = groups.join(old, "class_key", "left_anti").agg(F.count("*").alias("n"), F.sum("bytes").alias("size")).first()
        if new["n"]:
            self.snapshots.append(commit(whole, old, new["n"], new["size"], label))

    def _group(self, whole: DataFrame, label: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """Narrow rows, one row a class of the batch, the texts of classes that must be compared, and the snapshots' texts of those that are known."""
        rows = whole.select(F.monotonically_increasing_id().alias("at"), "doc_id", "points", "class_key", self.digest(F.col("norm")).alias("digest"), F.octet_length("norm").alias("bytes"))
        rows = stage_table(rows, f"{label}-rows")
        best = F.max(F.struct("points", F.bitwise_not("doc_id").alias("rank"), F.bitwise_not("at").alias("at"))).alias("best")
        groups = stage_table(rows.groupBy("class_key").agg(F.count("*").alias("n"), best, F.max("bytes").alias("bytes")), f"{label}-groups")
        keys, asked = groups.select("class_key", F.xxhash64("class_key").alias("h")), groups.count()
        positive = [screen(keys, asked, s) for s in self.snapshots]
        wanted = stage_table(_union([groups.filter("n > 1").select("class_key"), *positive]).distinct(), f"{label}-wanted")
        # what the bitmap lets pass besides is compared with itself and meets no bucket
        checked = maybe_in(wanted, ["class_key"])(whole).groupBy("class_key").agg(F.min("norm").alias("norm"), F.max("norm").alias("top"))
        checked = stage_table(checked, f"{label}-checked")
        met = [checked.join(self.spark.table(s.table).withColumnRenamed("norm", "kept"), "class_key") for s in self.snapshots]
        known = _union([checked.limit(0).withColumn("kept", F.col("norm")), *met]).select("class_key", "kept", (F.col("norm") == F.col("kept")).alias("same"))
        return rows, groups, checked, stage_table(known, f"{label}-known")

    def result(self) -> DataFrame:
        """``doc_id, keep_id, group_size, kept, digest`` of every row ingested."""
        rows = _union([r.select(F.lit(k).alias("batch"), "at", "doc_id", "class_key", "digest") for k, r in enumerate(self.rows)])
        classes = _union([c.select("class_key", "n", F.struct("best.points", "best.rank", F.lit(-k).alias("batch"), "best.at").alias("best")) for k, c in enumerate(self.classes)])
        classes = classes.groupBy("class_key").agg(F.sum("n").alias("group_size"), F.max("best").alias("best"))
        classes = stage_table(classes.select("class_key", "group_size", "best"), f"{self.label}-result")
        total = classes.agg(F.sum("group_size")).first()[0] or 0
        out = join_hot(rows, classes, ["class_key"], "group_size", total)
        kept = (F.col("batch") == -F.col("best.batch")) & (F.col("at") == F.bitwise_not("best.at"))
        return out.select("doc_id", F.bitwise_not("best.rank").alias("keep_id"), "group_size", kept.alias("kept"), "digest")


#: Batches in which the query takes in the documents.
BATCHES = 3


def op11_exact_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    dedup = Dedup(spark, "op11")
    for k in range(BATCHES):
        dedup.ingest(docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(BATCHES)) == k), last=k == BATCHES - 1)
    return dedup.result().select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP11_SQL = r"""
with norm as (select doc_id, length(coalesce(text, '')) as points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents),
best as (select *, first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size
  from norm window w as (partition by text_sha256 order by points desc, doc_id))
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from best
"""
