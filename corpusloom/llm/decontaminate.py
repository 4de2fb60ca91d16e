"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

Texts and items become sequences of words (lower case, split at whatever isn't
a letter or digit). A passage is a leak of an item if its word edit distance to
the whole item is at most ``max_edit`` of the item's words. An item of n words
within t edits keeps a run of ``ceil((n - t) / (t + 1))`` words intact, so
windows are laid only where such a run (three words at most) of some item
occurs, and that screen loses nothing.

Each window, as long as the item, goes through a CGK random walk: a pointer
moves over the words, staying or stepping by a random bit of (word, step), and
writes the word it stands on at each of 3n steps. Near sequences by edits come
out near by Hamming distance. Sampled positions of several walks make the keys
of as many LSH tables of the items; a shared key makes a candidate, which the
exact edit distance then confirms within the window widened by the edits
allowed.

The items are sent to every task in blocks of ``block_items``; texts aren't
shuffled. Memory: one block of items, and 256 KB of text at a time or one whole
text where it is longer.

Defined results: null and empty texts, and items without words, match nothing.
Repeated rows each report. Of items with equal words only the smallest item_id
reports. Rows without an item_id are ignored. Columns other than ``doc_id``,
``text`` and ``item_id`` are ignored. Empty tables give no matches.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.arrays import NOT_ALNUM, blocks, mix, text_bytes, word_spans

MAX_EDIT, WALKS, SAMPLES, BITS, BLOCK_ITEMS = 0.2, 6, 8, 2, 20_000
SCHEMA = "doc_id long, item_id long, start_word int, end_word int, distance int, item_words int"
_PAD = np.uint64(0)


def words_of(texts: list[str | None]) -> list[np.ndarray]:
    data, off = text_bytes(pc.utf8_lower(pa.array(texts, pa.large_string())))
    h, row, _ = word_spans(data, off, NOT_ALNUM, False)
    return np.split(h, np.searchsorted(row, np.arange(1, len(texts)))) if texts else []


def cgk(windows: np.ndarray, walk: int) -> np.ndarray:
    """The CGK embedding of each row of word hashes: 3n steps of one random walk."""
    n_rows, n = windows.shape
    padded = np.concatenate([windows, np.zeros((n_rows, 1), np.uint64)], 1)
    at, rows = np.zeros(n_rows, np.int64), np.arange(n_rows)
    out = np.empty((n_rows, 3 * n), np.uint64)
    coins = mix(np.arange(3 * n, dtype=np.uint64) + np.uint64(walk * 1_000_003 + 17)) | np.uint64(1)
    for t in range(3 * n):
        word = padded[rows, at]
        out[:, t] = word
        at = np.minimum(at + ((word * coins[t]) >> np.uint64(63)).astype(np.int64), n)
    return out


def keys_of(windows: np.ndarray) -> np.ndarray:
    """LSH keys: one column per table."""
    n = windows.shape[1]
    found = []
    for walk in range(WALKS):
        code = cgk(windows, walk)
        rng = np.random.default_rng(walk * 7919 + n)
        for s in range(SAMPLES):
            pick = rng.integers(0, 2 * n, BITS)  # later steps mostly stand past the end
            key = np.full(len(windows), walk * SAMPLES + s + 1, np.uint64)
            for b in pick:
                key = mix(key ^ code[:, b])
            found.append(key)
    return np.stack(found, 1)


def align(item: list[int], region: list[int], most: int) -> tuple[int, int, int] | None:
    """Least edit distance of the item to any stretch of the region, with that stretch; None beyond ``most``."""
    n = len(item)
    masks: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item):
        masks[w] |= 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, best, end = full, 0, n, n + 1, 0
    for j, w in enumerate(region):  # Myers' bit vectors, a match may start anywhere
        eq = masks.get(w, 0)
        x = eq | minus
        d0 = ((((x & plus) + plus) & full) ^ plus) | x
        hp, hm = minus | (full & ~(plus | d0)), plus & d0
        score += (hp & top > 0) - (hm & top > 0)
        hp, hm = (hp << 1) & full, (hm << 1) & full
        plus, minus = hm | (full & ~(d0 | hp)), hp & d0
        if score < best:
            best, end = score, j + 1
    if best > most:
        return None
    # the start, by the same distance read backwards from that end
    lo = max(0, end - n - best)
    back, turned = region[lo:end][::-1], item[::-1]
    row = list(range(len(back) + 1))
    for i, a in enumerate(turned, 1):
        prev, row[0] = row[0], i
        for j, b in enumerate(back, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (a != b))
    start = next(j for j in range(len(back) + 1) if row[j] == best)
    return best, end - start, end


class Matcher:
    """One block of items, indexed."""

    def __init__(self, items: list[tuple[int, str]], max_edit: float = MAX_EDIT):
        self.items, self.ids, self.allow = [], [], []
        known = set()
        for (item_id, _), words in zip(items, words_of([t for _, t in items]), strict=True):
            if len(words) and (sig := words.tobytes()) not in known:
                known.add(sig)
                self.items.append(words), self.ids.append(item_id), self.allow.append(int(len(words) * max_edit))
        seeds: dict[int, dict[int, list[tuple[int, int]]]] = {1: defaultdict(list), 2: defaultdict(list), 3: defaultdict(list)}
        for k, words in enumerate(self.items):
            n, t = len(words), self.allow[k]
            run = max(1, min(3, -(-(n - t) // (t + 1))))
            for o, code in enumerate(self.codes(words, run)):
                seeds[run][int(code)].append((k, o))
        self.vocab = [np.unique(w) for w in self.items]
        self.seeds = {run: (np.array(sorted(s), np.uint64), s) for run, s in seeds.items() if s}
        self.tables: dict[int, list[dict[int, list[int]]]] = {}
        by_n = defaultdict(list)
        for k, words in enumerate(self.items):
            by_n[len(words)].append(k)
        for n, ks in by_n.items():
            keys = keys_of(np.stack([self.items[k] for k in ks]))
            tables = [defaultdict(list) for _ in range(keys.shape[1])]
            for r, k in enumerate(ks):
                for c, key in enumerate(keys[r]):
                    tables[c][int(key)].append(k)
            self.tables[n] = tables

    @staticmethod
    def codes(words: np.ndarray, run: int) -> np.ndarray:
        k = len(words) - run + 1
        if k <= 0:
            return np.zeros(0, np.uint64)
        acc = np.zeros(k, np.uint64)
        for i in range(run):
            acc = mix(acc * np.uint64(3) + words[i : i + k])
        return acc

    def lay(self, words: np.ndarray, row: np.ndarray, base: int) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
        """Windows worth embedding: (item length, row, first word, words before it in the region, region).

        The region is the window widened by the edits allowed. An item within
        t edits has n - t of its words there, else the window is left out.
        """
        first = np.searchsorted(row, np.arange(row[-1] + 2)) if len(row) else np.zeros(1, np.int64)
        seen = set()
        for run, (codes, where) in self.seeds.items():
            found = self.codes(words, run)
            at = np.searchsorted(codes, found)
            hit = np.flatnonzero(codes[np.minimum(at, len(codes) - 1)] == found)
            for j in hit[row[hit] == row[np.minimum(hit + run - 1, len(row) - 1)]].tolist():
                r = int(row[j])
                for k, o in where[int(found[j])]:
                    n, t, s = len(self.items[k]), self.allow[k], j - o
                    if (n, s, r) in seen:
                        continue
                    lo, hi = max(s - t, int(first[r])), min(s + n + t, int(first[r + 1]))
                    region = words[lo:hi]
                    vocab = self.vocab[k]
                    at_k = np.searchsorted(vocab, region)
                    if int((vocab[np.minimum(at_k, len(vocab) - 1)] == region).sum()) >= n - t:
                        seen.add((n, s, r))
                        yield n, r + base, s - int(first[r]), s - lo, region.copy()

    def confirm(self, laid: dict[int, list[tuple[int, int, int, np.ndarray]]]) -> dict[tuple[int, int], set[tuple[int, int, int]]]:
        """Embed the windows, look them up, verify: (row, item number) to (distance, start word, end word)."""
        spans: dict[tuple[int, int], set[tuple[int, int, int]]] = defaultdict(set)
        for n, part in laid.items():
            windows = np.zeros((len(part), n), np.uint64)
            for i, (_, _, before, region) in enumerate(part):  # beyond the text's ends the window is blank
                inside = region[max(before, 0) : before + n]
                windows[i, max(-before, 0) : max(-before, 0) + len(inside)] = inside
            keys = keys_of(windows)
            for i, (r, s, before, region) in enumerate(part):
                for k in {k for c, key in enumerate(keys[i].tolist()) for k in self.tables[n][c].get(key, ())}:
                    got = align(self.items[k].tolist(), region.tolist(), self.allow[k])
                    if got:
                        spans[r, k].add((got[0], s - before + got[1], s - before + got[2]))
        return spans

    def scan_texts(self, column: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item number, start word, end word, distance) of each leak."""
        data, off = text_bytes(pc.utf8_lower(column))
        spans: dict[tuple[int, int], set[tuple[int, int, int]]] = defaultdict(set)
        laid, held = defaultdict(list), 0
        for i, j in blocks(off):
            words, row, _ = word_spans(data[off[i] : off[j]], off[i : j + 1] - off[i], NOT_ALNUM, False)
            for n, *window in self.lay(words, row, i):
                laid[n].append(tuple(window))
                held += 1
                if held >= 50_000:
                    for key, found in self.confirm(laid).items():
                        spans[key] |= found
                    laid, held = defaultdict(list), 0
        for key, found in self.confirm(laid).items():
            spans[key] |= found
        for (r, k), found in sorted(spans.items()):
            taken: list[tuple[int, int]] = []
            for d, s, e in sorted(found):
                if all(e <= a or s >= b for a, b in taken):
                    taken.append((s, e))
                    yield r, k, s, e, d


def matchers(benchmark: DataFrame, max_edit: float = MAX_EDIT, block_items: int = BLOCK_ITEMS) -> Iterator[list[tuple[int, str]]]:
    """Blocks of items, each of at most about ``block_items`` rows."""
    items = benchmark.filter("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    n = max(1, -(-items.count() // block_items))
    for b in range(n):
        plain = F.trim(F.regexp_replace(F.lower("text"), r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", " "))  # equal words share a block
        yield [tuple(r) for r in items.filter(F.pmod(F.xxhash64(plain), F.lit(n)) == b).orderBy("item_id", "text").collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Every leak: ``doc_id, item_id, start_word, end_word, distance, item_words``; words counted from 0, end exclusive."""
    parts = []
    for items in matchers(benchmark, max_edit, block_items):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = Matcher(items, max_edit)
            for batch in batches:
                ids = batch.column(0).to_pylist()
                found = [(ids[r], index.ids[k], s, e, d, len(index.items[k])) for r, k, s, e, d in index.scan_texts(batch.column(1))]
                cols = list(zip(*found, strict=True)) or [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

        parts.append(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs`` whose text holds no leak; columns as they are."""
    def marked(docs: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
        @F.pandas_udf("boolean")
        def leaky(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            index = Matcher(items, max_edit)
            for texts in batches:
                bad = np.zeros(len(texts), bool)
                bad[[r for r, *_ in index.scan_texts(pa.array(list(texts), pa.large_string()))]] = True
                yield pd.Series(bad)

        return docs.filter(~leaky("text"))

    for items in matchers(benchmark, max_edit, block_items):
        docs = marked(docs, items)
    return docs


def op7_decontamination(spark, sf_dir):
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
