"""Retrieval: BM25 statistics and top-k, vector top-k, rank fusion, reranking (R, M rows)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from corpusloom.functions.text import bm25_tokens

K1, B = 1.5, 0.75
RRF_K = 60
#: Queries of a block and rows of a shard, about; rows below which a shard isn't cut for more tasks.
MAX_QUERIES, MAX_ROWS, LEAST_ROWS = 8192, 65_536, 256
#: Queries and rows of one matrix product, and what rounding may change.
STEP_QUERIES, STEP_ROWS, SLACK = 512, 2048, 2e-6
#: Weights of the retrieval arms.
WEIGHTS = {"ilcs": 1.5, "iscr": 1.5, "opinions": 0.8, "regulations": 1.0, "documents": 0.7, "bm25": 1.2}


def postings(docs: DataFrame, id_col: str = "chunk_id", text: str = "text") -> DataFrame:
    """``id, term, tf``; map-side partial counts keep the shuffle to distinct (id, term)."""
    return docs.filter(F.col(text).isNotNull()).select(F.col(id_col), F.explode(bm25_tokens(F.col(text))).alias("term")).groupBy(id_col, "term").agg(F.count("*").alias("tf"))


def doc_lengths(docs: DataFrame, id_col: str = "chunk_id", text: str = "text") -> DataFrame:
    return docs.filter(F.col(text).isNotNull()).select(id_col, F.size(bm25_tokens(F.col(text))).alias("dl"))


def bm25_scores(docs: DataFrame, queries: DataFrame, id_col: str = "chunk_id", text: str = "text", query_id: str = "query_id", query: str = "query") -> DataFrame:
    """Lucene-form BM25 of every (query, document) that share a term; a term repeated in the query counts again.

    The statistics (number of documents, mean length) are one row; only terms
    of the queries are counted per document, so rare queries read the text once
    and shuffle little.
    """
    terms = queries.select(query_id, F.explode(bm25_tokens(F.col(query))).alias("term")).groupBy(query_id, "term").agg(F.count("*").alias("qtf"))
    lengths = doc_lengths(docs, id_col, text)
    whole = lengths.agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"))
    tf = docs.filter(F.col(text).isNotNull()).select(id_col, bm25_tokens(F.col(text)).alias("tokens"))
    hits = tf.select(id_col, F.size("tokens").alias("dl"), F.explode("tokens").alias("term")).join(terms.select("term").distinct(), "term", "left_semi").groupBy(id_col, "term", "dl").agg(F.count("*").alias("tf"))
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    scored = hits.join(df, "term").join(terms, "term").crossJoin(F.broadcast(whole))
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = F.col("qtf") * idf * F.col("tf") / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    return scored.groupBy(query_id, id_col).agg(F.round(F.sum(part), 6).alias("score"))


def top_k(scores: DataFrame, k: int, query_id: str = "query_id", id_col: str = "chunk_id") -> DataFrame:
    """Best k per query with a 0-based rank; ties to the smaller id (W1). F14: non-positive scores are left out by callers."""
    w = Window.partitionBy(query_id).orderBy(F.desc("score"), F.asc(id_col))
    # the filter on the bare row number becomes a group limit, which cuts each partition before the shuffle
    return scores.withColumn("rank0", F.row_number().over(w)).filter(F.col("rank0") <= k).withColumn("rank0", F.col("rank0") - 1)


def bm25_top_k(docs: DataFrame, queries: DataFrame, k: int = 20, **names: str) -> DataFrame:
    return top_k(bm25_scores(docs, queries, **names).filter("score > 0"), k, names.get("query_id", "query_id"), names.get("id_col", "chunk_id"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def checked_vector(v: Column, dim: int) -> Column:
    """R13."""
    return F.when(F.size(v) == dim, v).otherwise(F.raise_error(F.concat(F.lit(f"expected {dim} components, got "), F.size(v).cast("string"))))


def _wide(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Vectors of ``dim`` components as rows, null components as NaN."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _best(asks: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, row and rounded cosine of each query's k best rows, ties to the earlier row; -inf is a cosine of no value, inf one that isn't a number."""
    none = np.zeros(0, np.int64)
    at, to, best = none, none, np.zeros(0)
    floor = np.full(len(asks), -np.inf)
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        asks_n, rows_n = np.sqrt((asks * asks).sum(1)), np.sqrt((rows * rows).sum(1))
        for start in range(0, len(rows), STEP_ROWS):
            sim = asks @ rows[start : start + STEP_ROWS].T
            size = asks_n[:, None] * rows_n[start : start + STEP_ROWS]
            sim = np.where(size == 0, -np.inf, np.divide(sim, size))
            sim[np.isnan(sim)] = np.inf
            if not start and sim.shape[1] > k:
                floor = np.partition(sim, -k, axis=1)[:, -k] - SLACK
            q, r = np.nonzero(sim >= floor[:, None])
            at, to, best = np.concatenate([at, q]), np.concatenate([to, r + start]), np.concatenate([best, np.round(sim[q, r], 6)])
            order = np.lexsort((to, -best, at))
            at, to, best = at[order], to[order], best[order]
            first = np.searchsorted(at, np.arange(len(asks)))
            place = np.arange(len(at)) - first[at]
            full = np.flatnonzero(np.bincount(at, minlength=len(asks)) >= k)
            floor[full] = best[first[full] + k - 1] - SLACK
            at, to, best = at[place < k], to[place < k], best[place < k]
    return at, to, best


def _cell_hits(k: int, names: tuple[str, str]):
    """The k best rows of each query of a cell, one block of queries with one shard of the rows."""

    def run(asks: pa.Table, rows: pa.Table) -> pa.Table:
        # in the order of the ids, so that a place breaks ties
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("id", "ascending")], null_placement="at_start"))
        ask_dim, row_dim = (pc.fill_null(pc.list_value_length(t["v"]), -1).to_numpy() for t in (asks, rows))
        out = []
        for dim in np.unique(ask_dim):
            fits = np.flatnonzero(row_dim == dim) if dim > 0 else np.zeros(0, np.int64)
            vectors = _wide(rows["v"].take(pa.array(fits)), dim) if len(fits) else None
            # rows of another length have no cosine and come last
            unfit = np.flatnonzero(row_dim != dim)[:k] if dim > 0 else np.arange(min(k, len(rows)))
            mine = np.flatnonzero(ask_dim == dim)
            for start in range(0, len(mine), STEP_QUERIES):
                some = mine[start : start + STEP_QUERIES]
                if len(fits):
                    q, r, best = _best(_wide(asks["v"].take(pa.array(some)), dim), vectors, k)
                    out.append((some[q], fits[r], best))
                if len(unfit):
                    out.append((np.repeat(some, len(unfit)), np.tile(unfit, len(some)), np.full(len(some) * len(unfit), -np.inf)))
        q, r, best = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        score = pa.array(np.where(np.isposinf(best), np.nan, best), mask=np.isneginf(best))
        return pa.table([asks["id"].take(pa.array(q)), rows["id"].take(pa.array(r)), score], names=[*names, "score"])

    return run


def vector_top_k(vectors: DataFrame, queries: DataFrame, k: int = 40, id_col: str = "chunk_id", vec: str = "embedding", query_id: str = "query_id", max_queries: int = MAX_QUERIES, max_rows: int = MAX_ROWS) -> DataFrame:
    """Exact cosine top-k, of every query with every row.

    Queries are dealt to blocks of about ``max_queries`` and rows to shards of
    about ``max_rows``; a cell of both is one matrix product after another in one
    task, that keeps k rows a query. Vectors of length zero, with null components
    or of another length than the query's have no score and come last.
    """
    spark = vectors.sparkSession
    n_asks, n_rows = queries.count(), vectors.count()
    blocks = max(1, -(-n_asks // max_queries))
    shards = max(1, -(-n_rows // max_rows), min(-(-spark.sparkContext.defaultParallelism // blocks), n_rows // LEAST_ROWS))
    sound = lambda v: F.when(~F.exists(v, lambda x: x.isNull()), v)

    def dealt(df: DataFrame, name: str, own: int, others: int, cell) -> DataFrame:
        mine = F.pmod(F.xxhash64(name, vec), F.lit(own)).cast("int").alias("mine")
        each = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("other")
        return df.select(F.col(name).alias("id"), sound(F.col(vec)).alias("v"), mine).select("id", "v", "mine", each).select(cell(F.col("mine"), F.col("other")).alias("cell"), "id", "v").repartition(blocks * shards, "cell")

    asks = dealt(queries, query_id, blocks, shards, lambda mine, other: mine * shards + other)
    rows = dealt(vectors, id_col, shards, blocks, lambda mine, other: other * shards + mine)
    kinds = StructType([StructField(query_id, queries.schema[query_id].dataType), StructField(id_col, vectors.schema[id_col].dataType), StructField("score", DoubleType())])
    hits = asks.groupBy("cell").cogroup(rows.groupBy("cell")).applyInArrow(_cell_hits(k, (query_id, id_col)), kinds)
    return top_k(hits, k, query_id, id_col)


def fuse(arms: DataFrame, weights: dict[str, float], top_n: int = 40, query_id: str = "query_id", id_col: str = "chunk_id") -> DataFrame:
    """Weighted reciprocal rank fusion of ``query_id, arm, rank0, chunk_id``; ties keep first-seen order."""
    order = {a: i for i, a in enumerate(weights)}
    pick = lambda values: F.create_map(*[x for a, v in values.items() for x in (F.lit(a), F.lit(v))])[F.col("arm")]
    part = arms.withColumn("w", pick(weights) / (F.col("rank0") + RRF_K)).withColumn("seen", F.struct(pick(order).alias("arm"), F.col("rank0")))
    fused = part.groupBy(query_id, id_col).agg(F.round(F.sum("w"), 9).alias("score"), F.min("seen").alias("seen"))
    w = Window.partitionBy(query_id).orderBy(F.desc("score"), F.asc("seen"), F.asc(id_col))
    return fused.withColumn("rank0", F.row_number().over(w)).filter(F.col("rank0") <= top_n).select(query_id, id_col, "score", (F.col("rank0") - 1).alias("rank0"))


def append_unseen(first: DataFrame, second: DataFrame, query_id: str = "query_id", id_col: str = "chunk_id") -> DataFrame:
    """The first list, then what only the second has."""
    both = first.select(query_id, id_col, F.lit(0).alias("arm"), "rank0").unionByName(second.select(query_id, id_col, F.lit(1).alias("arm"), "rank0"))
    one = both.groupBy(query_id, id_col).agg(F.min(F.struct("arm", "rank0")).alias("at"))
    w = Window.partitionBy(query_id).orderBy("at", id_col)
    return one.withColumn("rank0", F.row_number().over(w) - 1).select(query_id, id_col, "rank0")


def overlap_scorer(queries: pd.Series, texts: pd.Series) -> pd.Series:
    """A deterministic stand-in for a cross-encoder: shared distinct words over the query's, scaled to -6..6."""
    def one(q: str, t: str) -> float:
        a, b = set(q.lower().split()), set(t.lower().split())
        return 12 * len(a & b) / len(a) - 6 if a else -6.0

    return pd.Series([one(q or "", t or "") for q, t in zip(queries, texts, strict=True)], dtype=float)


def rerank(ranked: DataFrame, scorer: Callable[[pd.Series, pd.Series], pd.Series] | Column = overlap_scorer, top_n: int = 6, threshold: float = -3.0, query_id: str = "query_id", id_col: str = "chunk_id") -> DataFrame:
    """Every candidate scored; ``survived`` marks score and position, ``post_rank`` the order by score.

    The scorer is a function of queries and texts, or a column.
    """

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for q, t in batches:
            yield scorer(q, t)

    w = Window.partitionBy(query_id).orderBy(F.desc("ce_score"), F.asc("rank0"), F.asc(id_col))
    out = ranked.withColumn("ce_score", scorer if isinstance(scorer, Column) else score("query", "text")).withColumn("post_rank", F.row_number().over(w) - 1)
    return out.withColumn("survived", (F.col("ce_score") >= threshold) & (F.col("post_rank") < top_n))


# --- evaluation (M1 to M9): columns over arrays of retrieved and relevant ids ---


def hit_at(r: Column, rel: Column, k: int) -> Column:
    return F.exists(F.slice(r, 1, k), lambda x: F.array_contains(rel, x)).cast("double")


def _hits(r: Column, rel: Column, k: int) -> Column:
    return F.size(F.filter(F.slice(r, 1, k), lambda x: F.array_contains(rel, x)))


def precision_at(r: Column, rel: Column, k: int) -> Column:
    return _hits(r, rel, k) / F.lit(float(k))


def recall_at(r: Column, rel: Column, k: int) -> Column:
    return F.when(F.size(rel) == 0, 1.0).otherwise(F.try_divide(_hits(r, rel, k).cast("double"), F.size(rel)))


def _gains(r: Column, rel: Column, k: int | None = None) -> Column:
    part = F.slice(r, 1, k) if k else r
    return F.transform(part, lambda x, i: F.struct(i.alias("i"), F.array_contains(rel, x).alias("rel")))


def mrr(r: Column, rel: Column) -> Column:
    first = F.array_min(F.transform(F.filter(_gains(r, rel), lambda g: g["rel"]), lambda g: g["i"]))
    return F.coalesce(1.0 / (first + 1), F.lit(0.0))


def ndcg_at(r: Column, rel: Column, k: int) -> Column:
    total = lambda gains: F.aggregate(gains, F.lit(0.0), lambda s, i: s + 1.0 / F.log2(i + 2.0))
    dcg = total(F.transform(F.filter(_gains(r, rel, k), lambda g: g["rel"]), lambda g: g["i"].cast("double")))
    ideal = total(F.filter(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: i.cast("double")), lambda i: i < F.size(rel)))
    return F.when(F.size(rel) == 0, 1.0).otherwise(F.try_divide(dcg, ideal))


def average_precision(r: Column, rel: Column) -> Column:
    zero = F.struct(F.lit(0.0).alias("hits"), F.lit(0.0).alias("sum"))

    def step(acc, g):
        hits = acc["hits"] + g["rel"].cast("double")
        return F.struct(hits.alias("hits"), (acc["sum"] + F.when(g["rel"], hits / (g["i"] + 1)).otherwise(0.0)).alias("sum"))

    ap = F.aggregate(_gains(r, rel), zero, step, lambda acc: acc["sum"])
    return F.when(F.size(rel) == 0, 1.0).otherwise(F.try_divide(ap, F.size(rel)))


def ir_metrics(runs: DataFrame, ks: tuple[int, ...] = (3, 6, 10)) -> DataFrame:
    """One row per run row (``retrieved``, ``relevant`` arrays) with all metrics, rounded to 6."""
    r, rel = F.col("retrieved"), F.col("relevant")
    cols = {"mrr": mrr(r, rel), "ap": average_precision(r, rel)}
    for k in ks:
        cols |= {f"hit_{k}": hit_at(r, rel, k), f"p_{k}": precision_at(r, rel, k), f"r_{k}": recall_at(r, rel, k), f"ndcg_{k}": ndcg_at(r, rel, k)}
    return runs.withColumns({n: F.round(c, 6) for n, c in cols.items()})


def target_status(value: Column, demo: float, refined: float) -> Column:
    """M8."""
    return F.when(value >= refined, "refined").when(value >= demo, "demo").otherwise("gap")
