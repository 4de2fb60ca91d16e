import random

import pytest

from corpusloom.functions import bpe
from corpusloom.functions.folds import accumulate

tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def ranks(spark):
    return bpe.read_ranks(spark, "file://" + str(tokenizers.path("byte_bpe_50k.tiktoken")))


def loop(word, ranks):
    """The same merges one by one."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not found:
            break
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return len(parts)


def test_merges_against_a_plain_loop(ranks):
    r = random.Random(2)
    small = {b"a": 9, b"b": 8, b"aa": 0, b"ab": 1, b"aaaa": 2, b"ba": 3, b"abab": 4}
    for table, letters in ((small, "ab"), (ranks, "the ing€é")):
        for n in (0, 1, 2, 3, 5, 8, 30, 80):
            for _ in range(20):
                word = "".join(r.choices(letters, k=n)).encode()
                assert bpe.count_pieces(word, table) == (1 if word in table else loop(word, table))
    assert bpe.count_pieces(b"ab" * 50_000, small) == 25_000


def test_counts_against_the_library(spark, ranks):
    library = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows += [(9001, None), (9002, ""), (9003, " \n\t  x  "), (9004, "don't it's 12345 naïve 日本語 🙂!!"), (9005, "x" * 30_000)]
    df = spark.createDataFrame([(i, t, "w") for i, t in rows], "chunk_id long, text string, word string")
    got = {r.chunk_id: r.tokens for r in bpe.token_counts(df, ranks).collect()}
    assert got == {i: len(library.encode_ordinary(t)) if t else 0 for i, t in rows}
    size = bpe.counter(ranks)
    assert all(size(t or "") == got[i] for i, t in rows)
    assert bpe.token_counts(df.limit(0), ranks).count() == 0


def test_folds_take_the_count(ranks):
    size = bpe.counter(ranks)
    units = ["unbelievable words here"] * 40
    assert all(size(p) <= 130 for p in accumulate(units, target=100, most=120, size=size)) and len(accumulate(units, target=100, most=120, size=size)) < len(accumulate(units, target=20, most=120, size=size))
