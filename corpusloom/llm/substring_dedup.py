"""Removal of repeated byte strings by distributed prefix doubling over sampled suffixes.

Every byte covered by a string of ``length`` bytes that also starts somewhere
else goes. Plain prefix doubling ranks every position of the corpus in every
round. Here a position takes part only if it can matter:

1. *Sampling.* Of each ``length``-byte string the least hashed ``half``-byte gram
   inside it (leftmost on ties) is its anchor. The choice depends on the string
   alone, so equal strings have equal anchors at equal offsets. Consecutive
   strings share an anchor; such a run is one row (anchor rank, run rank, place).
   A rank is a 64-bit name of the content, equal for equal bytes.
2. *First length.* Rows are grouped by the rank of their anchor's gram. A rank
   that occurs once ends there, with all strings of its run: none repeats.
3. *Whole runs.* Of the rest, runs of equal rank that occur twice or more are
   past the threshold as a whole: every string in them repeats.
4. *Doubled length.* What is left has a repeated gram but a run of its own (the
   surroundings of an edit or of a shared passage's ends). Each of its strings
   is named by the pair of its anchor's rank and the rank of the bytes around
   it, at each offset, and pairs that occur twice repeat.

Ranks meet by hash partitioning with counts pre-aggregated. A gram with more
than ``HOT_RUNS`` different runs has its pairs counted as rows of their own, so
that no group must fit into a task. Text is shuffled for texts that may hold
repeats alone.

Defined results: a null text counts as empty and loses nothing. Two rows with
one text repeat each other, whatever their ids, null ids included. Rows return
as many as they came. Texts are processed in overlapping segments of ``BLOCK_BYTES``, so
length is no limit. Columns other than ``doc_id`` and ``text`` are ignored. An
empty table returns no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.arrays import BLOCK_BYTES, RangeHash, blocks, mix, text_bytes
from corpusloom.llm.bitmap import maybe_in
from corpusloom.session import arrow_batches, stage_table

LENGTH = 400
#: Distinct runs of one gram beyond which its strings are counted as rows.
HOT_RUNS = 20_000
GRAM_BITMAP_WORDS = 1 << 18
KEY = ["tk", "n"]


def half_of(length: int) -> int:
    return max(1, length * 5 // 8)


def anchors(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of strings with one anchor: row, first string, anchor, last string (positions in the row), gram rank, run rank."""
    half = half_of(length)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none, none
    h = RangeHash(data)
    at = np.arange(len(data) - half + 1)
    low = (1 << 40) - 1
    key = (h(at, at + half) & np.uint64(~low & (1 << 64) - 1)) | at.astype(np.uint64)
    width, span = length - half + 1, 1
    while 2 * span <= width:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    key = np.minimum(key[: len(data) - length + 1], key[width - span :][: len(data) - length + 1])
    fits = np.zeros(len(data) + 1, np.int64)
    size = np.diff(off)
    long_rows = np.flatnonzero(size >= length)
    np.add.at(fits, off[long_rows], 1)
    np.add.at(fits, off[long_rows + 1] - length + 1, -1)
    q = np.flatnonzero(np.cumsum(fits)[: len(key)] > 0)
    if not len(q):
        return none, none, none, none, none, none
    p = (key[q] & np.uint64(low)).astype(np.int64)
    cut = np.flatnonzero((p[1:] != p[:-1]) | (q[1:] != q[:-1] + 1)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(q) - 1]])
    a, b, p = q[first], q[last], p[first]
    row = np.searchsorted(off, a, "right") - 1
    run = mix(h(a, b + length) + (p - a).astype(np.uint64))
    return row, a - off[row], p - off[row], b - off[row], h(p, p + half).view(np.int64), run.view(np.int64)


def segments(data: np.ndarray, off: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``anchors`` of all rows, a bounded piece at a time."""
    for i, j in blocks(off):
        if off[j] - off[i] <= BLOCK_BYTES:
            row, *rest = anchors(data[off[i] : off[j]], off[i : j + 1] - off[i], length)
            yield (row + i, *rest)
            continue
        for s in range(int(off[i]), max(int(off[i]) + 1, int(off[j]) - length + 1), BLOCK_BYTES):
            part = data[s : min(int(off[j]), s + BLOCK_BYTES + length - 1)]
            row, a, p, b, g, r = anchors(part, np.array([0, len(part)]), length)
            d = s - int(off[i])
            yield row + i, a + d, p + d, b + d, g, r


def anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    """``tk, n, a, p, b, g, r`` of ``texts(tk, n, text)``."""
    names = ["tk", "n", "a", "p", "b", "g", "r"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column(2))
            tk, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, *rest in segments(data, off, length):
                if len(row):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (tk[row], n[row], *rest)], names=names)

    return texts.select("tk", "n", "text").mapInArrow(run, ", ".join(f"{x} long" for x in names))


def context_rows(texts: DataFrame, length: int) -> DataFrame:
    """For each of ``runs`` of a text: the bytes around its anchor's gram that its strings cover."""
    half = half_of(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for tk, n, text, runs in zip(*(batch.column(c) for c in ("tk", "n", "text", "runs")), strict=True):
                data = text.as_buffer().to_pybytes()
                for x in runs.as_py():
                    a, p, b = x["a"], x["p"], x["b"]
                    out.append((x["g"], tk.as_py(), n.as_py(), p, p - b, p - a, x["hot"], data[a:p] + data[p + half : b + length]))
            if out:
                cols = list(zip(*out, strict=True))
                kinds = [pa.int64()] * 6 + [pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["g", "tk", "n", "p", "s_lo", "s_hi", "hot", "around"])

    return texts.mapInArrow(run, "g long, tk long, n long, p long, s_lo long, s_hi long, hot boolean, around binary")


def pair_names(batch: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each string's row in the batch, its offset before the anchor, and the name of (gram rank, offset, bytes around)."""
    rest = length - half_of(length)
    col = batch.column("around").combine_chunks()
    data = np.frombuffer(b"".join(col.to_pylist()), np.uint8)
    lens = np.array([len(x.as_buffer()) for x in col], np.int64)
    start = np.cumsum(lens) - lens
    lo, hi = batch.column("s_lo").to_numpy(), batch.column("s_hi").to_numpy()
    count = hi - lo + 1
    row = np.repeat(np.arange(len(col)), count)
    s = hi[row] - (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count))
    at = start[row] + hi[row] - s
    g = batch.column("g").to_numpy().view(np.uint64)[row]
    return row, s, mix(RangeHash(data)(at, at + rest) ^ mix(g + mix(s.astype(np.uint64))))


def _repeats(length: int):
    names = ["tk", "n", "lo", "hi"]

    def settle(batch: pa.Table) -> pa.RecordBatch:
        row, s, name = pair_names(batch, length)
        _, back, count = np.unique(name, return_inverse=True, return_counts=True)
        again = count[back] > 1
        row, q = row[again], batch.column("p").to_numpy()[row[again]] - s[again]
        # strings at neighbouring starts make one interval
        cut = np.flatnonzero((row[1:] != row[:-1]) | (q[1:] != q[:-1] + 1)) + 1
        first, last = (np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(q) - 1]])) if len(q) else (cut, cut)
        tk, n = batch.column("tk").to_numpy()[row[first]], batch.column("n").to_numpy()[row[first]]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (tk, n, q[first], q[last] + length)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not len(batch):
                continue
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            g = held.column("g").to_numpy()
            done = int(np.searchsorted(g, g[-1]))  # the last rank may go on in the next batch
            if done:
                yield settle(held.slice(0, done))
                held = held.slice(done)
        if held is not None and len(held):
            yield settle(held)

    return run


def _named(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 1000):
                part = pa.Table.from_batches([batch.slice(i, 1000)])
                row, s, name = pair_names(part, length)
                q = part.column("p").to_numpy()[row] - s
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (name.view(np.int64), part.column("tk").to_numpy()[row], part.column("n").to_numpy()[row], q)], names=["name", "tk", "n", "q"])

    return run


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text, tk, n``: null texts empty; equal (tk, n) is taken for equal text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tk"), F.octet_length(text).cast("long").alias("n"))


def repeated_intervals(texts: DataFrame, length: int = LENGTH, hot_runs: int = HOT_RUNS) -> DataFrame:
    """``tk, n, spans``: byte intervals (may overlap) of each text that repeat; texts with none are left out."""
    texts = texts.filter(F.col("n") >= length)
    rows = anchor_rows(texts, length)
    grams = rows.groupBy("g").agg(F.count("*").alias("c"), F.min("r").alias("lo"), F.max("r").alias("hi")).filter("c > 1")
    grams = stage_table(grams.select("g", (F.col("lo") == F.col("hi")).alias("uniform")), "repeated-grams")
    again = maybe_in(grams, ["g"], GRAM_BITMAP_WORDS)(rows).join(grams, "g")
    again = stage_table(again, "repeated-anchors")
    mixed = again.filter("not uniform")
    runs = mixed.groupBy("g", "r").agg(F.count("*").alias("c"), F.min(F.struct("tk", "n", "a", "p", "b")).alias("at"))
    runs = stage_table(runs.select("g", "r", "c", "at.*"), "runs")
    heat = runs.groupBy("g").agg((F.count("*") > hot_runs).alias("hot"))
    lists = runs.join(heat, "g").groupBy(*KEY).agg(F.collect_list(F.struct("g", "a", "p", "b", "hot")).alias("runs"))
    lists = stage_table(lists, "runs-by-text")
    some = maybe_in(lists, KEY)(texts.select(*KEY, "text")).join(lists, KEY).dropDuplicates(KEY)
    with arrow_batches(texts.sparkSession, 1000):
        around = stage_table(context_rows(some.select("tk", "n", F.col("text").cast("binary").alias("text"), "runs"), length), "around")
    near = around.filter("not hot").repartition("g").sortWithinPartitions("g").mapInArrow(_repeats(length), "tk long, n long, lo long, hi long")
    named = around.filter("hot").mapInArrow(_named(length), "name long, tk long, n long, q long")
    twice = named.groupBy("name").agg(F.count("*").alias("c")).filter("c > 1").select("name")
    hot = named.join(twice, "name").select("tk", "n", F.col("q").alias("lo"), (F.col("q") + length).alias("hi"))
    whole = again.filter("uniform").select(*KEY, F.col("a").alias("lo"), (F.col("b") + length).alias("hi"))
    equal = mixed.join(runs.filter("c > 1").select("g", "r"), ["g", "r"], "left_semi").select(*KEY, F.col("a").alias("lo"), (F.col("b") + length).alias("hi"))
    spans = whole.unionByName(equal).unionByName(near).unionByName(hot)
    return spans.groupBy(*KEY).agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, removed, spans_n, digest = [], [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
            data = memoryview(text.as_buffer())
            cut = merged([(s["lo"], s["hi"]) for s in spans.as_py() or []])
            sha, at = hashlib.sha256(), 0
            for lo, hi in cut:
                sha.update(data[at:lo])
                at = hi
            sha.update(data[at:])
            n.append(len(data)), removed.append(sum(hi - lo for lo, hi in cut)), spans_n.append(len(cut)), digest.append(sha.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans_n, pa.int64()), pa.array(digest, pa.string())], names=[x.split()[0] for x in RESULT.split(", ")])


def op9_suffix_dedup(spark, sf_dir):
    docs = keyed(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumn("doc_id", F.col("doc_id").cast("long"))
    with arrow_batches(spark, 2000):
        spans = stage_table(repeated_intervals(docs.select("tk", "n", "text")), "spans")
    hit = maybe_in(spans, KEY)
    some = hit.keep(docs).join(spans, KEY, "left").select("doc_id", F.col("text").cast("binary").alias("text"), "spans")
    rest = hit.drop(docs).select("doc_id", F.col("text").cast("binary").alias("text"), F.lit(None).cast("array<struct<lo:bigint,hi:bigint>>").alias("spans"))
    return some.mapInArrow(_apply, RESULT).unionByName(rest.mapInArrow(_apply, RESULT))
