"""A stored BM25 index: postings by (collection, shard, term) with what bounds their scores, and a search that skips blocks.

Documents are dealt into shards of about ``SHARD_DOCS`` or ``SHARD_BYTES`` within a
collection and a class of text length, so a frequent term is split over many blocks and the short
documents, whose scores can be high, stand together. A block holds a shard's
postings of one term (id, frequency, length) and their greatest frequency and
least length. These bound every score in the block whatever the mean length of
the whole index is, so a collection can change without touching the others.

A search adds up the bounds of a query's terms in each shard from the blocks'
heads alone. The postings of a query's ``PILOTS`` most promising shards are
scored first; of the other shards only those whose bound reaches the k-th score
found are read. The result is that of scoring everything. A document's postings
are in one shard, so a shard adds up whole scores and tells the k best of a query.

``refresh`` compares each collection's rows and a checksum of ids and texts with
those of the index and rebuilds only what changed. The counts lose a collection
before its blocks are touched and get it back at the end: a run lost in between
leaves it stale, and the next refresh rebuilds it.

Null texts are no documents; empty ones are, without postings. A null collection
is one of its own. Rows without an id take no part. Repeated ids count as
documents of their own and return one row, their scores added; where rows of one
id stand in several shards (``spread``), every score is told and added.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.functions.text import bm25_tokens
from corpusloom.operators.retrieval import B, K1, top_k
from corpusloom.session import stage_table
from corpusloom.sources.readers import exists
from corpusloom.sources.sinks import delete, put_in_place, recover

#: Documents and bytes of text of a shard, about; shards scored first; terms of the queries that may be broadcast.
SHARD_DOCS, SHARD_BYTES, PILOTS, BROADCAST_TERMS = 16_384, 16 << 20, 4, 200_000
#: A score is rounded to six digits; a bound reaches it from here.
SLACK = 2e-6
COUNTS = "part string, rows long, mark long, n_docs long, sum_dl long"


def part_of(collection: Column) -> Column:
    """A name for a collection that a folder may have."""
    text = collection.cast("string")
    return F.concat(F.lit("c"), F.substring(F.sha2(F.when(text.isNull(), "-").otherwise(F.concat(F.lit("="), text)), 256), 1, 32))


def length_class(text: Column) -> Column:
    return F.floor(F.log2(F.octet_length(text) + 1)).cast("int")


def saturation(tf: Column, dl: Column, avgdl: float) -> Column:
    return tf / (tf + K1 * (1 - B + B * dl / F.lit(avgdl)))


def _best_of_shard(k: int, avgdl: float):
    """The k best documents of each query in a shard: ``asks(query_id, term, w)`` met with the shard's blocks."""

    def run(asks: pa.Table, blocks: pa.Table) -> pa.Table:
        blocks = blocks.combine_chunks()
        out = []
        if len(blocks) and len(asks):
            held = blocks.column("postings").chunk(0)
            stop = np.cumsum(held.value_lengths().to_numpy(zero_copy_only=False))
            each = held.flatten()
            tf, dl = (each.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("tf", "dl"))
            part = tf / (tf + K1 * (1 - B + B * dl / avgdl))
            ids, doc = np.unique(each.field("id").to_numpy(zero_copy_only=False), return_inverse=True)
            at: dict[str, list[int]] = {}
            for i, term in enumerate(blocks.column("term").to_pylist()):
                at.setdefault(term, []).append(i)
            asks = asks.sort_by("query_id")
            names, query = np.unique(asks.column("query_id").to_numpy(), return_inverse=True)
            cut = np.searchsorted(query, np.arange(len(names) + 1))
            terms, w = asks.column("term").to_pylist(), asks.column("w").to_numpy()
            for q, name in enumerate(names):
                met = [(slice(stop[i - 1] if i else 0, stop[i]), w[j]) for j in range(cut[q], cut[q + 1]) for i in at.get(terms[j], ())]
                if not met:
                    continue
                total = np.bincount(np.concatenate([doc[s] for s, _ in met]), np.concatenate([part[s] * x for s, x in met]), len(ids))
                score = np.round(total, 6)
                some = np.flatnonzero(score > 0)
                if len(some) > k:
                    some = some[score[some] >= np.partition(score[some], -k)[-k]]
                some = some[np.lexsort((ids[some], -score[some]))[:k]]
                out.append((np.full(len(some), name), ids[some], total[some], score[some]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query_id", "chunk_id", "part_score", "score"])

    return run


@dataclass
class Bm25Index:
    spark: SparkSession
    path: str
    #: Rows that a shard tells of a query in a search; 0: all.
    told: int = 0

    def counts(self) -> DataFrame:
        recover(self.spark, f"{self.path}/counts")
        if not exists(self.spark, f"{self.path}/counts"):
            return self.spark.createDataFrame([], COUNTS)
        return self.spark.read.schema(COUNTS).parquet(f"{self.path}/counts")

    def changed(self, docs: DataFrame, id_col: str = "chunk_id", text: str = "text", collection: str = "collection_id") -> DataFrame:
        """``part, there`` of the collections that differ from the index; ``there``: the documents have rows of it."""
        now = docs.filter(F.col(id_col).isNotNull()).groupBy(part_of(F.col(collection)).alias("part")).agg(F.count("*").alias("rows"), F.bit_xor(F.xxhash64(id_col, text)).alias("mark"), F.count(text).alias("n_docs"))
        then = self.counts().select("part", F.col("rows").alias("old_rows"), F.col("mark").alias("old_mark"))
        both = now.join(then, "part", "full").filter(~F.col("rows").eqNullSafe(F.col("old_rows")) | ~F.col("mark").eqNullSafe(F.col("old_mark")))
        return both.select("part", F.col("rows").isNotNull().alias("there"), "rows", "mark", "n_docs")

    def refresh(self, docs: DataFrame, force: bool = False, id_col: str = "chunk_id", text: str = "text", collection: str = "collection_id") -> int:
        """Rebuild the collections that changed (all with ``force``); how many those were."""
        if force:
            self._put_counts(self.spark.createDataFrame([], COUNTS))
        changed = stage_table(self.changed(docs, id_col, text, collection), "bm25-changed")
        names = [r["part"] for r in changed.select("part").collect()]  # a name for each collection
        if not names and not force:
            return 0
        kept = stage_table(self.counts().join(changed, "part", "left_anti"), "bm25-kept")
        self._put_counts(kept)
        if force:
            delete(self.spark, f"{self.path}/blocks")
        for name in names:
            delete(self.spark, f"{self.path}/blocks/part={name}")
        rows = docs.filter(F.col(id_col).isNotNull()).select(part_of(F.col(collection)).alias("part"), F.col(id_col).alias("id"), F.col(text).alias("text"))
        rows = rows.filter("text is not null").join(changed.filter("there").select("part"), "part", "left_semi")
        self._blocks(rows).write.mode("append").partitionBy("part").parquet(f"{self.path}/blocks")
        lengths = self.blocks().join(changed.select("part"), "part", "left_semi").groupBy("part").agg(F.sum("cf").alias("sum_dl"))
        new = changed.filter("there").join(lengths, "part", "left").select("part", "rows", "mark", "n_docs", F.coalesce("sum_dl", F.lit(0)).alias("sum_dl"))
        self._put_spread(docs.filter(F.col(text).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), part_of(F.col(collection)).alias("part"), length_class(F.col(text)).alias("length")))
        self._put_counts(stage_table(kept.unionByName(new), "bm25-counts"))
        return len(names)

    def _put_spread(self, places: DataFrame) -> None:
        """Whether rows of one id stand in several shards."""
        several = places.groupBy("id").agg(F.min(F.struct("part", "length")).alias("a"), F.max(F.struct("part", "length")).alias("b")).filter("a <> b")
        several.agg((F.count("*") > 0).alias("spread")).write.mode("overwrite").parquet(f"{self.path}/spread")

    def spread(self) -> bool:
        return not exists(self.spark, f"{self.path}/spread") or self.spark.read.parquet(f"{self.path}/spread").first()[0]

    def _put_counts(self, counts: DataFrame) -> None:
        counts.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/counts.next")
        put_in_place(self.spark, f"{self.path}/counts.next", f"{self.path}/counts")

    @staticmethod
    def _blocks(rows: DataFrame) -> DataFrame:
        """``part, shard, term, df, cf, max_tf, min_dl, postings`` of ``rows(part, id, text)``; texts are shuffled once."""
        length = length_class(F.col("text")).alias("length")
        shards = F.greatest(F.ceil(F.count("*") / SHARD_DOCS), F.ceil(F.sum(F.octet_length("text")) / SHARD_BYTES)).alias("shards")
        sizes = stage_table(rows.groupBy("part", length).agg(shards), "bm25-sizes")
        shard = (F.col("length") * F.lit(1 << 32) + F.pmod(F.xxhash64("id"), F.col("shards"))).alias("shard")
        dealt = rows.withColumn("length", length).join(sizes, ["part", "length"]).select("part", shard, "id", "text").repartition("part", "shard")
        tokens = dealt.select("part", "shard", "id", bm25_tokens(F.col("text")).alias("tokens"))
        # both groupings keep to the shards' partitioning
        each = tokens.select("part", "shard", "id", F.size("tokens").alias("dl"), F.explode("tokens").alias("term")).groupBy("part", "shard", "term", "id", "dl").agg(F.count("*").cast("int").alias("tf"))
        return each.groupBy("part", "shard", "term").agg(
            F.count("*").alias("df"), F.sum("tf").alias("cf"), F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl"), F.collect_list(F.struct("id", "tf", "dl")).alias("postings")
        ).sortWithinPartitions("part", "term")

    def blocks(self) -> DataFrame:
        if not exists(self.spark, f"{self.path}/blocks") or not self._any():
            return self.spark.createDataFrame([], "part string, shard long, term string, df long, cf long, max_tf int, min_dl int, postings array<struct<id:long,tf:int,dl:int>>")
        return self.spark.read.parquet(f"{self.path}/blocks")

    def _any(self) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/blocks")
        return any("part=" in str(f.getPath().getName()) for f in at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).listStatus(at))

    def search(self, queries: DataFrame, k: int = 20, query_id: str = "query_id", query: str = "query") -> DataFrame:
        """``query_id, chunk_id, score, rank0`` of the k best documents, ties to the smaller id."""
        whole = self.counts().agg(F.sum("n_docs").alias("n"), F.sum("sum_dl").alias("dl")).first()
        n, avgdl = whole["n"] or 0, (whole["dl"] or 0) / whole["n"] if whole["n"] else 0.0
        terms = queries.select(F.col(query_id).alias("query_id"), F.explode(bm25_tokens(F.col(query))).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("qtf"))
        terms = stage_table(terms, "bm25-terms")
        wanted = terms.select("term").distinct()
        wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_TERMS else wanted
        blocks = self.blocks().join(wanted, "term", "left_semi")
        heads = stage_table(blocks.select("part", "shard", "term", "df", "max_tf", "min_dl"), "bm25-heads")
        df = heads.groupBy("term").agg(F.sum("df").alias("df"))
        weight = F.col("qtf") * F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        terms = terms.join(df, "term").select("query_id", "term", weight.alias("w"))
        bound = F.col("w") * saturation(F.col("max_tf"), F.col("min_dl"), avgdl)
        asks = stage_table(terms.join(heads, "term").select("query_id", "part", "shard", "term", "w", bound.alias("bound")), "bm25-asks")
        shards = asks.groupBy("query_id", "part", "shard").agg(F.sum("bound").alias("score"))
        pilots = stage_table(top_k(shards, PILOTS, id_col="shard").select("query_id", "part", "shard"), "bm25-pilots")
        at = ["query_id", "part", "shard"]
        whole = not self.spread() and all(kind == "bigint" for kind in (dict(asks.dtypes)["query_id"], blocks.select(F.explode("postings").alias("x")).select("x.id").dtypes[0][1]))
        by_shard = replace(self, told=k if whole else 0)
        first = by_shard._scored(asks.join(pilots, at, "left_semi"), blocks, avgdl, "first")
        kth = top_k(first, k).groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("found"))
        rest = shards.join(pilots, at, "left_anti").join(kth, "query_id", "left").filter(F.coalesce(F.col("found"), F.lit(0)).__lt__(k) | (F.col("score") + SLACK >= F.col("floor")))
        later = by_shard._scored(asks.join(rest.select(*at), at, "left_semi"), blocks, avgdl, "later")
        return top_k(first.unionByName(later).groupBy("query_id", "chunk_id").agg(F.round(F.sum("part_score"), 6).alias("score")).filter("score > 0"), k).withColumnRenamed("query_id", query_id)

    def _scored(self, asks: DataFrame, blocks: DataFrame, avgdl: float, label: str) -> DataFrame:
        """``query_id, chunk_id, part_score, score`` of all postings asked for, or of each shard and query the ``told`` best; ``score`` rounded."""
        if self.told:
            # postings are shuffled once, whatever the number of queries that ask for them
            at = ["part", "shard"]
            asks = stage_table(asks.select("query_id", *at, "term", "w"), f"bm25-asked-{label}")
            some = blocks.join(F.broadcast(asks.select(*at).distinct()), at, "left_semi").select(*at, "term", "postings")
            best = asks.groupBy(*at).cogroup(some.groupBy(*at)).applyInArrow(_best_of_shard(self.told, avgdl), "query_id long, chunk_id long, part_score double, score double")
            return stage_table(best, f"bm25-{label}")
        met = asks.select("query_id", "part", "shard", "term", "w").join(blocks.select("part", "shard", "term", "postings"), ["part", "shard", "term"])
        each = met.select("query_id", "w", F.explode("postings").alias("x"))
        score = F.sum(F.col("w") * saturation(F.col("x.tf"), F.col("x.dl"), avgdl)).alias("part_score")
        return stage_table(each.groupBy("query_id", F.col("x.id").alias("chunk_id")).agg(score).withColumn("score", F.round("part_score", 6)), f"bm25-{label}")
