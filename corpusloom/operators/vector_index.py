"""An inverted file over vectors: every row stored in the cell of its nearest centroid, searched by cells.

Centroids are fitted on a bounded sample by spherical k-means on the driver
(``MAX_CELLS`` of them at most, from ``MAX_SAMPLE`` rows at most, picked by a
hash of the id); every row is then assigned, in tasks. A cell is stored in blocks
of ``BLOCK_ROWS`` vectors, so a cell that holds a third of all rows is many
blocks, and as one partition of a Parquet table, so a search reads the cells it
probes only.

A search sends each query to its ``probes`` nearest cells by an equi-join on the
cell and scores the stored vectors themselves in double precision. That is
approximate. The exact form goes on: a cell's least cosine to its centroid bounds
the cosine of any of its rows with a query, and the cells whose bound reaches the
k-th score found are searched too.

How many cells to probe is measured when the index is built: a bounded sample of
its rows (``TRIALS``) is searched exactly, and the place of each neighbour's cell
in its query's order gives the fewest probes that find the wanted share of them.

Vectors that are null, of another length than ``dim``, of length zero or not
finite are in no cell and match nothing; as queries they get no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.operators.retrieval import dot, top_k
from corpusloom.session import arrow_batches, stage_table

MAX_CELLS, MAX_SAMPLE = 4096, 65_536
#: Vectors of a stored block, and queries that meet it at once.
BLOCK_ROWS, BLOCK_QUERIES = 1024, 256
#: Block pairs of an Arrow batch.
PAIRS = 8
#: Rows that meet all centroids at once.
ROWS = 64
#: Rows searched exactly to set the probes, and neighbours of each.
TRIALS, TRIAL_K = 256, 10
#: A score is rounded; a bound reaches it from here.
SLACK = 2e-6


def valid(vector: Column, dim: int) -> Column:
    """A vector of ``dim`` finite components that aren't all zero."""
    sound = (F.size(vector) == dim) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & sound & (dot(vector, vector) > 0)


def fit_centroids(sample: np.ndarray, cells: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit rows by spherical k-means; rows far from theirs replace empty ones."""
    sample = np.unique(sample, axis=0)
    cells = min(cells, len(sample))
    at = np.random.default_rng(17).permutation(len(sample))
    found = sample[at[:cells]].copy()
    for _ in range(rounds):
        near = sample @ found.T
        own = near.argmax(1)
        total = np.zeros_like(found)
        np.add.at(total, own, sample)
        size = np.linalg.norm(total, axis=1)
        full = size > 1e-9
        found[full] = total[full] / size[full, None]
        if not full.all():
            worst = near[np.arange(len(sample)), own].argsort()[: int((~full).sum())]
            found[~full] = sample[worst]
    return found


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``ROWS`` rows at a time: what is worked out for every row and cell stays small, however many cells there are."""
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield batch.slice(at, ROWS)


@dataclass
class VectorIndex:
    """``blocks(cell, chunk, rows)`` at ``path``; per cell its centroid and the least cosine of its rows to it."""

    spark: SparkSession
    path: str
    dim: int
    centroids: np.ndarray
    least: np.ndarray
    probes: int = 1

    @classmethod
    def build(cls, vectors: DataFrame, path: str, dim: int, cells: int | None = None, id_col: str = "chunk_id", vec: str = "embedding", recall: float = 0.95) -> VectorIndex:
        """Fit, assign, write and set the probes for ``recall``; the number of cells is the square root of the rows unless given."""
        spark = vectors.sparkSession
        rows = vectors.filter(F.col(id_col).isNotNull() & valid(F.col(vec), dim)).select(F.col(id_col).cast("long").alias("id"), F.col(vec).cast("array<float>").alias("v"))
        n = rows.count()
        cells = max(1, min(cells or int(n**0.5), MAX_CELLS))
        centroids = fit_centroids(cls._sample(rows, n, min(MAX_SAMPLE, 64 * cells), dim), cells) if n else np.zeros((0, dim))

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                near = unit(_matrix(batch.column("v"), dim)) @ centroids.T
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(near.argmax(1).astype(np.int32)), pa.array(near.max(1))], names=["id", "v", "cell", "cosine"])

        placed = stage_table(rows.mapInArrow(assign, "id long, v array<float>, cell int, cosine double"), "vector-cells")
        sizes = placed.groupBy("cell").agg(F.count("*").alias("m"), F.min("cosine").alias("least"))
        sizes = stage_table(sizes, "vector-sizes")  # a row for each cell, MAX_CELLS at most
        chunk = F.pmod(F.xxhash64("id"), F.ceil(F.col("m") / BLOCK_ROWS)).alias("chunk")
        blocks = placed.join(F.broadcast(sizes), "cell").select("cell", chunk, F.struct("id", "v").alias("row")).groupBy("cell", "chunk").agg(F.collect_list("row").alias("rows"))
        blocks.repartition("cell", F.floor(F.col("chunk") / 64)).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/blocks")
        least = np.full(len(centroids), np.inf)
        for r in sizes.collect():
            least[r["cell"]] = r["least"]
        made = cls(spark, path, dim, centroids, least)
        if n:
            made.probes = made._calibrated(stage_table(cls._some(placed, n, TRIALS), "vector-trials"), recall)
        table = [(k, c.tolist(), float(x), made.probes) for k, (c, x) in enumerate(zip(centroids, least, strict=True))]
        spark.createDataFrame(table, "cell int, centroid array<double>, least double, probes int").coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
        return made

    @staticmethod
    def _some(rows: DataFrame, n: int, size: int) -> DataFrame:
        """``size`` rows, those of the least hashes of the id."""
        share = min(1.0, 2 * size / n)
        return rows.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1).orderBy(F.xxhash64("id"), "id").limit(size)

    @classmethod
    def _sample(cls, rows: DataFrame, n: int, size: int, dim: int) -> np.ndarray:
        return unit(_matrix(cls._some(rows, n, size).select("v").toArrow().column("v"), dim))

    def _calibrated(self, trials: DataFrame, recall: float) -> int:
        """The fewest probes that find ``recall`` of the trials' nearest rows, themselves left out."""
        asked = trials.select(F.col("id").alias("query_id"), F.col("v").alias("q"))
        hits = self._exact_hits(stage_table(asked, "vector-trial-queries"), TRIAL_K + 1, 1).filter("query_id <> chunk_id")
        own = {r["id"]: r["v"] for r in trials.collect()}
        met = [(r["query_id"], r["cell"]) for r in top_k(hits, TRIAL_K).select("query_id", "cell").collect()]  # TRIALS * TRIAL_K rows at most
        if not met:
            return 1
        near = unit(np.array([own[q] for q, _ in met], float)) @ self.centroids.T
        place = (near > near[np.arange(len(met)), [c for _, c in met]][:, None]).sum(1)
        return int(np.sort(place)[min(len(met) - 1, int(np.ceil(recall * len(met))) - 1)]) + 1

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> VectorIndex:
        rows = sorted(spark.read.parquet(f"{path}/cells").collect(), key=lambda r: r["cell"])
        centroids = np.array([r["centroid"] for r in rows])
        return cls(spark, path, centroids.shape[1] if len(rows) else 0, centroids, np.array([r["least"] for r in rows]), rows[0]["probes"] if rows else 1)

    def search(self, queries: DataFrame, k: int = 40, probes: int | None = None, exact: bool = False, query_id: str = "query_id", vec: str = "embedding") -> DataFrame:
        """``query_id, chunk_id, score, rank0`` of the k best cosines, rounded to 6; ties to the smaller id."""
        asked = queries.filter(F.col(query_id).isNotNull() & valid(F.col(vec), self.dim)) if len(self.centroids) else queries.limit(0)
        asked = stage_table(asked.select(F.col(query_id).cast("long").alias("query_id"), F.col(vec).cast("array<float>").alias("q")), "vector-queries")
        hits = self._exact_hits(asked, k, probes or self.probes) if exact else self._first_hits(asked, k, probes or self.probes)
        return top_k(hits, k).select(F.col("query_id").alias(query_id), "chunk_id", "score", "rank0")

    def _first_hits(self, asked: DataFrame, k: int, probes: int) -> DataFrame:
        return self._hits(self._probed(asked.withColumn("floor", F.lit(None).cast("double")), probes), k, "near")

    def _exact_hits(self, asked: DataFrame, k: int, probes: int) -> DataFrame:
        hits = self._first_hits(asked, k, probes)
        kth = top_k(hits, k).groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n"))
        floor = F.when(F.col("n") == k, F.col("floor")).otherwise(F.lit(-2.0))
        rest = asked.join(kth, "query_id", "left").select("query_id", "q", F.coalesce(floor, F.lit(-2.0)).alias("floor"))
        return hits.unionByName(self._hits(self._probed(rest, probes), k, "rest"))

    def _probed(self, asked: DataFrame, probes: int) -> DataFrame:
        """``cell, query_id, q``: the nearest cells of a query, or, where it has a floor, all others whose bound reaches that."""
        centroids, used = self.centroids, np.isfinite(self.least)
        wide = np.arccos(np.clip(np.where(used, self.least, 1.0), -1, 1))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                near = np.where(used, unit(_matrix(batch.column("q"), centroids.shape[1])) @ centroids.T, -np.inf)
                first = np.zeros(near.shape, bool)
                np.put_along_axis(first, np.argsort(-near, axis=1, kind="stable")[:, :probes], True, 1)
                floor = batch.column("floor").to_numpy(zero_copy_only=False).astype(float)
                bound = np.cos(np.maximum(0, np.arccos(np.clip(near, -1, 1)) - wide))
                wanted = np.where(np.isnan(floor)[:, None], first, ~first & (bound + SLACK >= floor[:, None])) & used
                row, cell = np.nonzero(wanted)
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), batch.column("query_id").take(pa.array(row)), batch.column("q").take(pa.array(row))], names=["cell", "query_id", "q"])

        return stage_table(asked.mapInArrow(run, "cell int, query_id long, q array<float>"), "vector-probes")

    def _hits(self, probed: DataFrame, k: int, label: str) -> DataFrame:
        """The k best of each query in each block that it meets."""
        dim = self.dim
        per_cell = {r["cell"]: r["count"] for r in probed.groupBy("cell").count().collect()}  # a row for each cell
        blocks = self.spark.read.parquet(f"{self.path}/blocks").filter(F.col("cell").isin(sorted(per_cell))) if per_cell else None
        if blocks is None:
            return self.spark.createDataFrame([], "query_id long, chunk_id long, score double, cell int")
        most = F.broadcast(self.spark.createDataFrame(sorted(per_cell.items()), "cell int, asks long"))
        dealt = probed.join(most, "cell").withColumn("part", F.pmod(F.xxhash64("query_id"), F.ceil(F.col("asks") / BLOCK_QUERIES)))
        asks = dealt.groupBy("cell", "part").agg(F.collect_list(F.struct("query_id", "q")).alias("asks"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(len(batch)):
                    rows, asks = batch.column("rows").slice(at, 1).flatten(), batch.column("asks").slice(at, 1).flatten()
                    ids, q_ids = rows.field("id").to_numpy(zero_copy_only=False), asks.field("query_id").to_numpy(zero_copy_only=False)
                    score = np.round(unit(_matrix(asks.field("q"), dim)) @ unit(_matrix(rows.field("v"), dim)).T, 6)
                    best = np.lexsort((np.broadcast_to(ids, score.shape), -score))[:, :k]
                    cell = np.full(best.size, batch.column("cell")[at].as_py(), np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q_ids, best.shape[1])), pa.array(ids[best].ravel()), pa.array(np.take_along_axis(score, best, 1).ravel()), pa.array(cell)], names=["query_id", "chunk_id", "score", "cell"])

        met = blocks.join(asks, "cell").select("rows", "asks", "cell")
        with arrow_batches(self.spark, PAIRS):
            return stage_table(met.mapInArrow(run, "query_id long, chunk_id long, score double, cell int"), f"vector-hits-{label}")
