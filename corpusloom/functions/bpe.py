"""Byte-pair token counts by a table of merge ranks, worked out once for each distinct word of a few texts.

The table is text with a token (base64 of its bytes) and its rank on each line.
A text is cut into words by a pattern in the JVM; a word's bytes are merged pair
by pair, the pair of the least rank first. Texts are counted where they are read,
``TEXTS`` at a time, and a task keeps the counts of ``KNOWN`` words at most, so no
word is shuffled.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpusloom.session import arrow_batches, stage_table

#: Fixed value: how a text is cut before bytes are merged.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of a table that may go to every task.
MAX_RANKS = 1_000_000
#: Texts of an Arrow batch.
TEXTS = 64
#: Words whose counts a task keeps, and characters of the longest of them.
KNOWN, KNOWN_CHARS = 1 << 17, 64

Ranks = dict[bytes, int]


def read_ranks(spark: SparkSession, path: str) -> Ranks:
    lines = spark.read.text(path).filter("trim(value) <> ''").limit(MAX_RANKS + 1).collect()
    if len(lines) > MAX_RANKS:
        raise ValueError(f"over {MAX_RANKS} ranks in {path}")
    return {base64.b64decode(token): int(rank) for token, rank in (r["value"].split() for r in lines)}


def count_pieces(word: bytes, ranks: Ranks) -> int:
    """How many tokens a word's bytes merge to; the leftmost of equal pairs first, in time n log n."""
    n = len(word)
    if n < 2 or word in ranks:
        return min(n, 1)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the piece that starts at i
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (rank := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, j, end[j]))

    for i in range(n):
        offer(i)
    left = n
    while heap:
        _, i, j, stop = heapq.heappop(heap)
        if end[i] != j or end[j] != stop:
            continue  # one of the two has grown or is gone
        end[i], end[j] = stop, -1
        if stop < n:
            before[stop] = i
        left -= 1
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return left


def counter(ranks: Ranks, pattern: str = PATTERN) -> Callable[[str], int]:
    """A text's tokens, for folds that take ``size``."""
    import regex

    words = regex.compile(pattern)
    return lambda text: sum(count_pieces(w.encode(), ranks) for w in words.findall(text))


def token_counts(texts: DataFrame, ranks: Ranks, key: str = "chunk_id", text: str = "text", pattern: str = PATTERN) -> DataFrame:
    """``key, tokens`` of each row of ``texts``, whose keys are unique; null and empty texts have none."""
    shared = texts.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}

        def size(word: str) -> int:
            found = known.get(word)
            if found is None:
                found = count_pieces(word.encode(), shared.value)
                if len(word) <= KNOWN_CHARS:
                    if len(known) >= KNOWN:
                        known.clear()
                    known[word] = found
            return found

        for batch in batches:
            words = batch.column("words").flatten().dictionary_encode()
            sizes = np.array([size(w) for w in words.dictionary.to_pylist()], np.int64)
            before = np.concatenate([[0], np.cumsum(sizes[words.indices.to_numpy()])])
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(batch.column("words")), 0).to_numpy())])
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(np.diff(before[ends]), pa.int64())], names=["key", "tokens"])

    words = F.regexp_extract_all(F.col(text), F.lit(f"(?U){pattern}"), F.lit(0))
    kinds = StructType([StructField("key", texts.schema[key].dataType), StructField("tokens", LongType())])
    with arrow_batches(texts.sparkSession, TEXTS):
        counted = stage_table(texts.select(F.col(key).alias("key"), words.alias("words")).mapInArrow(run, kinds), "bpe-counts")
    return counted.select(F.col("key").alias(key), "tokens")
