"""MinHash near-duplicates with SetSketch registers.

A document's set holds the 64-bit hashes of its word shingles. Rows of equal
sets become one class first. A class's sketch has ``BANDS * ROWS`` registers:
per register the minimum over the set of an exponential hash, its logarithm to
base ``SKETCH_BASE`` truncated to an integer (SetSketch). Registers merge by the
maximum and equal with about the probability of the Jaccard similarity.

Groups of ``ROWS`` registers make band keys. Every class is paired with the
least class of each bucket it falls into. Of these pairs the joint likelihood of
the registers, the set sizes being known, estimates the similarity; pairs far
below the threshold go, the others are confirmed on the full sets. Confirmed
links are joined to components. Where a bucket still holds several components,
further ids are compared with the whole bucket, and those that are then still
apart seek in it in blocks (``components.link_buckets``), so that no link a
bucket holds is lost. Pairs of a block are never rows.

Only hashes, keys and the sets of candidate classes are shuffled.

Defined results: a null or empty text, or one of white space, has an empty set
and is linked with nothing. Rows without a doc_id are dropped. Repeated rows
each return a row; rows that share a doc_id are one node, with the links of all
their texts. Columns other than
``doc_id`` and ``text`` are ignored. An empty table returns no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.llm.arrays import blocks, mix, shingle_hashes, text_bytes, word_hashes
from corpusloom.llm.bitmap import maybe_in
from corpusloom.llm.components import connected_components, link_buckets, shared_buckets, star_pairs
from corpusloom.session import stage_table

BANDS, ROWS = 24, 5
SKETCH_BASE, RATE, LIMIT = 1.001, 20.0, 65_534
#: Pairs estimated this far below the threshold aren't verified: five standard errors of 120 registers at 0.8.
SLACK = 0.19
_ODD = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_ADD = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) ^ np.uint64(0x5DEECE66D))


def doc_sets(data: np.ndarray, off: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each row."""
    n = len(off) - 1
    words, row = word_hashes(data, off)
    h, of = shingle_hashes(words, row, n, size)
    cut = np.searchsorted(of, np.arange(n + 1))
    for i in range(n):
        yield np.unique(h[cut[i] : cut[i + 1]])


def registers(members: np.ndarray) -> np.ndarray:
    """SetSketch registers of a non-empty set of hashes."""
    least = np.full(len(_ODD), np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(members), 512):
        h = members[i : i + 512, None] * _ODD + _ADD
        np.minimum(least, h.min(0), out=least)
    e = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64 * (1 - 2.0**-53)) / RATE
    k = np.floor(1 - np.log(np.maximum(e, 1e-300)) / np.log(SKETCH_BASE))
    # unlike counting sketches, sizes are known here, so the registers are shifted to fit 16 bits
    return np.clip(k + 3200, 0, LIMIT + 1).astype(np.uint16)


def band_keys(reg: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = mix(key * np.uint64(3) + reg[j::ROWS].astype(np.uint64) + np.uint64(1))
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Likeliest Jaccard similarity of pairs of sketches (rows of registers), set sizes known."""
    above, below = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - above - below
    u = n_a / (n_a + n_b)
    v = 1 - u
    most = np.minimum(u / v, v / u)
    best, best_j = np.full(len(a), -np.inf), np.zeros(len(a))
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (SKETCH_BASE - 1) / SKETCH_BASE) / np.log(SKETCH_BASE)
    with np.errstate(divide="ignore", invalid="ignore"):
        for f in np.linspace(0, 1, 101):
            j = f * most
            # a's register is the larger where the least hash of the union is a's alone
            up, down = p(u - v * j), p(v - u * j)
            ll = sum(np.where(c > 0, c * np.log(np.maximum(q, 1e-12)), 0) for c, q in ((above, up), (below, down), (same, 1 - up - down)))
            better = ll > best
            best, best_j = np.where(better, ll, best), np.where(better, j, best_j)
    return best_j


TEXT_KEY = ["doc_id", "th"]
SKETCH = "doc_id long, th long, n long, fp binary, reg binary, bands array<long>"


def sketch(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, th, n`` (set size), ``fp`` (digest of the set), ``reg``, ``bands`` of ``docs(doc_id, th, text)``; the last three null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column(2))
            n, fp, reg, bands = [], [], [], []
            for i, j in blocks(off):
                for s in doc_sets(data[off[i] : off[j]], off[i : j + 1] - off[i], size):
                    n.append(len(s))
                    if not len(s):
                        fp.append(None), reg.append(None), bands.append(None)
                        continue
                    with np.errstate(over="ignore"):
                        two = (np.bitwise_xor.reduce(mix(s)), (mix(s ^ np.uint64(0x94D049BB133111EB)) * np.uint64(5)).sum(), np.uint64(len(s)))
                    k = registers(s)
                    fp.append(np.array(two[:2], np.uint64).tobytes() + int(two[2]).to_bytes(4, "little")), reg.append(k.tobytes()), bands.append(band_keys(k).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(reg, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "th", "n", "fp", "reg", "bands"],
            )

    return docs.select(*TEXT_KEY, "text").mapInArrow(run, SKETCH)


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """``id, p``: the whole set of each row as sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            out = []
            for i, j in blocks(off):
                out += [s.tobytes() for s in doc_sets(data[off[i] : off[j]], off[i : j + 1] - off[i], size)]
                if sum(map(len, out)) > 1 << 26:
                    done = j - len(out)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(out)), pa.array(out, pa.binary())], names=["id", "p"])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(len(batch) - len(out)), pa.array(out, pa.binary())], names=["id", "p"])

    return docs.select("id", "text").mapInArrow(run, "id long, p binary")


def _likely(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(len(batch), -1) for c in ("reg_a", "reg_b"))
            j = estimate(a, b, batch.column("n_a").to_numpy().astype(float), batch.column("n_b").to_numpy().astype(float))
            yield batch.select(["a", "b"]).filter(pa.array(j >= least))

    return run


def unpacked(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.uint64) for v in column]


def find_links(nodes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links ``a, b`` of ``nodes(id, doc_id, th, n, reg, bands)`` that join the components of all that the buckets hold."""
    shared = shared_buckets(nodes.select("id", F.explode("bands").alias("key")), "near")
    side = lambda s: nodes.select(F.col("id").alias(s), F.col("reg").alias(f"reg_{s}"), F.col("n").alias(f"n_{s}"))
    likely = star_pairs(shared, "near").join(side("a"), "a").join(side("b"), "b").select("a", "b", "reg_a", "reg_b", "n_a", "n_b")
    likely = stage_table(likely.filter(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)").mapInArrow(_likely(percent / 100 - SLACK), "a long, b long"), "near-likely")
    # ids of likely pairs, and of buckets of three or more, where links may be left open
    crowds = shared.groupBy("key").agg(F.count("*").alias("m")).filter("m > 2").select("key")
    wanted = likely.select(F.explode(F.array("a", "b")).alias("id")).unionByName(shared.join(crowds, "key", "left_semi").select("id")).distinct()
    wanted = stage_table(nodes.select("id", *TEXT_KEY).join(wanted, "id", "left_semi"), "near-candidates")
    texts = maybe_in(wanted, TEXT_KEY)(docs).join(wanted, TEXT_KEY).dropDuplicates(["id"])
    sets = stage_table(full_sets(texts, size), "near-sets")
    return link_buckets(shared, likely, sets, nodes.select("id", F.col("reg").alias("q")), np.uint16, unpacked, percent, "near")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row; links where 100 * intersection >= percent * union."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text").filter("doc_id is not null")
    rows = stage_table(sketch(docs, size), "sketches")
    classes = rows.filter("n > 0").groupBy("fp").agg(F.min(F.struct(*TEXT_KEY)).alias("at")).select("fp", "at.*")
    nodes = rows.join(classes, ["fp", *TEXT_KEY]).dropDuplicates(["fp"]).withColumn("id", F.monotonically_increasing_id())
    nodes = stage_table(nodes.select("id", *TEXT_KEY, "n", "reg", "bands"), "classes")
    links = find_links(nodes, docs, size, percent)
    # from classes to their least doc_ids: rows of one doc_id are one node
    end = lambda s: nodes.select(F.col("id").alias(s), F.col("doc_id").alias(f"doc_{s}"))
    links = links.join(end("a"), "a").join(end("b"), "b").select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))
    same = rows.select("fp", F.col("doc_id").alias("b")).join(classes.select("fp", F.col("doc_id").alias("a")), "fp").select("a", "b")
    found = connected_components(links.unionByName(same), "components")
    out = rows.select("doc_id", F.col("n").alias("n_shingles")).join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def drop_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: of each component that of the least doc_id, once. Null ids stay.

    Of several rows of that doc_id the one with the least text stays (ties: by a
    hash of the whole row).
    """
    names = docs.columns
    docs = docs.toDF(*[c if c in ("doc_id", "text") else f"extra {i}" for i, c in enumerate(names)])
    gone = stage_table(near_duplicates(docs, size, percent).filter("not kept").select("doc_id").distinct(), "near-gone")
    twice = stage_table(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "near-twice")
    hit = maybe_in(gone, ["doc_id"])
    rest = hit.drop(docs).unionByName(hit.keep(docs).join(gone, "doc_id", "left_anti").select(docs.columns))
    again = maybe_in(twice, ["doc_id"])
    order = Window.partitionBy("doc_id").orderBy("text", F.xxhash64(F.to_json(F.struct("*"))))
    once = again.keep(rest).withColumn("place", F.row_number().over(order)).filter("place = 1").drop("place")
    return again.drop(rest).unionByName(once).toDF(*names)


def op10_near_dup(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=4, percent=80)
