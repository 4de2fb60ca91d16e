"""Exact top-k inner products by a KD-tree per shard.

Vectors are dealt into shards by a hash of their id. A task builds one tree per
shard: median splits along the widest dimension down to leaves, with tight
bounding boxes. A query's inner product with any vector of a box is at most
``sum(max(q * lo, q * hi))``, so the tree is walked best bound first until the
best bound left can't beat the k-th score found. Query blocks first search one
pilot shard each; the k-th score found there is carried to every other shard as
the starting bound.

Queries are dealt in blocks to every shard by an equi-join on the block number.
Memory in a task: one shard's vectors and one block of queries.

Defined results: vectors that are null or hold null or non-finite components
take no part, neither do those whose length differs from the most common one
(ties: the shorter). Rows without an id take no part. Repeated ids count as
rows of their own. Ties go to the smaller id. An empty table returns no row.
Components quantise to integers; scores are exact below 2**53.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from corpusloom.session import stage_table

LEAF, SHARD_ROWS, BLOCK_QUERIES = 256, 4096, 1024


class Tree:
    """A KD-tree of integer vectors; leaves are runs of ``order``."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        self.lo, self.hi, self.least, self.child, self.span = [], [], [], [], []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            v = vectors[order[a:b]]
            lo, hi = v.min(0), v.max(0)
            me = len(self.lo)
            self.lo.append(lo), self.hi.append(hi), self.least.append(ids[order[a:b]].min()), self.child.append([-1, -1]), self.span.append((a, b))
            if parent >= 0:
                self.child[parent][side] = me
            wide = int(np.argmax(hi - lo))
            if b - a > leaf and hi[wide] > lo[wide]:
                mid = (a + b) // 2
                part = np.argpartition(v[:, wide], mid - a, kind="introselect")
                order[a:b] = order[a:b][part]
                todo += [(a, mid, me, 0), (mid, b, me, 1)]
        self.lo, self.hi, self.least = np.array(self.lo), np.array(self.hi), np.array(self.least)
        self.ids, self.vectors = ids[order], vectors[order]

    def search(self, q_ids: np.ndarray, q: np.ndarray, k: int, floor: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query: its number, and the ids and scores of its best rows here that reach its floor."""
        bound = np.maximum(q, 0) @ self.hi.T + np.minimum(q, 0) @ self.lo.T
        for i in range(len(q_ids)):
            kth, best_id, best = floor[i], np.zeros(0, np.int64), np.zeros(0)
            heap = [(-bound[i, 0], 0)]
            while heap and -heap[0][0] >= kth:
                top, node = heapq.heappop(heap)
                full = len(best) >= k
                if full and -top == kth and self.least[node] > best_id[k - 1]:
                    continue
                left, right = self.child[node]
                if left >= 0:
                    for c in (left, right):
                        if bound[i, c] >= kth:
                            heapq.heappush(heap, (-bound[i, c], c))
                    continue
                a, b = self.span[node]
                score = self.vectors[a:b] @ q[i]
                ids = self.ids[a:b]
                ok = (score >= kth) & (ids != q_ids[i])
                if ok.any():
                    best, best_id = np.concatenate([best, score[ok]]), np.concatenate([best_id, ids[ok]])
                    rank = np.lexsort((best_id, -best))[:k]
                    best, best_id = best[rank], best_id[rank]
                    if len(best) >= k:
                        kth = max(kth, best[k - 1])
            yield i, best_id, best


def clean_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``id, v``: quantised as floor(scale * x), usable rows only."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    df = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter("id is not null and v is not null and size(v) > 0")
    df = df.filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    widths = df.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    df = df.join(F.broadcast(widths.select("n")), F.size("v") == F.col("n"), "left_semi")
    return df.select("id", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("v"))


def _pack(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    order = pdf["id"].to_numpy().argsort(kind="stable")
    return pdf["id"].to_numpy(np.int64)[order], np.stack(pdf["v"].to_numpy()[order]).astype(np.float64)


def _build(key, pdf: pd.DataFrame) -> pd.DataFrame:
    ids, vectors = _pack(pdf)
    return pd.DataFrame({"shard": [int(key[0])], "tree": [pickle.dumps(Tree(ids, vectors))]})


def _blocks(key, pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"block": [int(key[0])], "queries": [pickle.dumps(_pack(pdf))]})


def _search(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                tree, (q_ids, q) = pickle.loads(row.tree), pickle.loads(row.queries)
                floor = np.full(len(q_ids), -np.inf)
                if row.floors is not None:
                    known = pickle.loads(row.floors)
                    floor = np.array([known.get(int(i), -np.inf) for i in q_ids])
                out = [(np.full(len(ids), q_ids[i]), ids, score) for i, ids, score in tree.search(q_ids, q, k, floor) if len(ids)]
                if out:
                    yield pd.DataFrame({"query_id": np.concatenate([x[0] for x in out]), "id": np.concatenate([x[1] for x in out]), "score": np.concatenate([x[2] for x in out]).astype(np.int64), "block": row.block})

    return run


def _floors(k: int):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        kth = {int(i): float(s.nlargest(k).iloc[-1]) for i, s in pdf.groupby("query_id")["score"] if len(s) >= k}
        return pd.DataFrame({"block": [int(key[0])], "floors": [pickle.dumps(kth)]})

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """The k best rows of ``vectors(id, v)`` for each row of ``queries(id, v)``, the query's own id left out.

    Returns ``query_id, rank, id, score``.
    """
    shards = max(1, -(-vectors.count() // shard_rows))
    n_blocks = max(1, -(-queries.count() // block_queries))
    trees = vectors.groupBy(F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard")).applyInPandas(_build, "shard long, tree binary")
    trees = stage_table(trees, "kd-trees")
    blocks = queries.groupBy(F.pmod(F.hash("id"), F.lit(n_blocks)).cast("long").alias("block")).applyInPandas(_blocks, "block long, queries binary")
    out = "query_id long, id long, score long, block long"
    spread = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("shard", F.col("shard").cast("long"))
    pilot = F.col("shard") == F.pmod("block", F.lit(shards))
    first = spread.filter(pilot).join(trees, "shard").select("block", "queries", "tree", F.lit(None).cast("binary").alias("floors")).mapInPandas(_search(k), out)
    first = stage_table(first, "kd-pilot")
    floors = first.groupBy("block").applyInPandas(_floors(k), "block long, floors binary")
    rest = spread.filter(~pilot).join(floors, "block", "left").join(trees, "shard").select("block", "queries", "tree", "floors").mapInPandas(_search(k), out)
    found = first.unionByName(rest)
    best = F.transform(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("id").alias("id")))), 1, k), lambda x: x)
    # at most k rows of each shard reach a query, so a query's list is bounded by k * shards
    return (
        found.groupBy("query_id").agg(best.alias("best"))
        .select("query_id", F.posexplode("best").alias("pos", "hit"))
        .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.id").alias("id"), (-F.col("hit.s")).alias("score"))
    )


def op3_topk_search(spark, sf_dir):
    rows = clean_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", 256)
    return top_k(rows, rows.filter("id % 50 = 0"), 5).withColumnRenamed("id", "vec_id")


OP3_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e from embeddings
  where embedding is not null and list_count(embedding) = len(embedding) and len(list_filter(embedding, lambda x: not isfinite(x))) = 0),
p as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(cast(q.e as double[]), cast(c.e as double[])) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 5
"""
