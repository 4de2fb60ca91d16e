import difflib
import random

import pytest

from corpusloom.operators import near_text as N
from corpusloom.plans import search


def greedy(rows, ratio=0.95, chars=500):
    """(query_id, chunk_id, rank0, text) that a plain loop keeps."""
    out = []
    for q in {r[0] for r in rows}:
        kept = []
        for r in sorted((r for r in rows if r[0] == q), key=lambda r: (r[2], r[1])):
            text = (r[3] or "")[:chars]
            if not any(difflib.SequenceMatcher(None, text, k).ratio() >= ratio for k in kept):
                kept.append(text)
                out.append(r[:3])
    return sorted(out, key=str)


def edited(r, text, edits):
    text = list(text)
    for _ in range(edits):
        at = r.randrange(len(text) + 1)
        kind = r.random()
        text[at : at + (kind < 0.6)] = "" if kind < 0.3 else r.choice("abc xyz")
    return "".join(text)


def lists(seed, n, lengths, letters="abcdefgh "):
    r = random.Random(seed)
    rows = []
    for q in (None, 1, 2):
        bases = ["".join(r.choices(letters, k=r.choice(lengths))) for _ in range(8)]
        for i in range(n):
            base = r.choice(bases)
            text = edited(r, base, r.choice([0, 0, 1, 2, 1 + len(base) // 40, 1 + len(base) // 20]))
            rows.append((q, i, i // 2, r.choice([text, text, text, text, None, "", text[:9], "the same start " * 40 + text])))
    return rows


@pytest.mark.parametrize("lengths,letters", [([5, 9, 10, 11, 20, 21, 40], "ab "), ([52, 54, 57, 60, 63, 66, 70], "abcdefgh "), ([150, 199, 201, 400, 500, 700], "abcdefgh "), ([30, 120], "aé")])
def test_rows_of_the_greedy_loop(spark, lengths, letters):
    rows = lists(len(lengths), 90, lengths, letters)
    df = spark.createDataFrame([(*r, "x") for r in rows], "query_id long, chunk_id long, rank0 int, text string, node string")
    got = N.drop_near(df).collect()
    assert sorted(((r.query_id, r.chunk_id, r.rank0) for r in got), key=str) == greedy(rows)
    assert {r.node for r in got} == {"x"}


def test_a_chain_is_decided_in_order(spark):
    """Each text is near the next one only: every second goes."""
    texts = ["".join(chr(97 + (i * 7 + j * j) % 26) for j in range(300)) for i in range(1)]
    for i in range(11):
        texts.append(texts[-1][9:] + "".join(chr(65 + (i * 5 + j) % 26) for j in range(9)))
    rows = [(1, i, i, t) for i, t in enumerate(texts)]
    kept = greedy(rows)
    assert 1 < len(kept) < len(rows)
    df = spark.createDataFrame(rows, "query_id long, chunk_id long, rank0 int, text string")
    assert sorted(((r.query_id, r.chunk_id, r.rank0) for r in N.drop_near(df).collect()), key=str) == kept


def test_texts_with_a_shared_start_do_not_meet(spark):
    r = random.Random(1)
    rows = [(1, i, i, "All rights reserved. " * 5 + "".join(r.choices("abcdefghijklmnop ", k=395))) for i in range(60)]
    df = spark.createDataFrame([((1,), (i,), 500, t[:500]) for _, i, _, t in rows], "list struct<q:long>, node struct<rank0:long>, size int, start string")
    assert N.candidates(df, 0.95).count() < 60


def test_empty(spark):
    assert N.drop_near(spark.createDataFrame([], "query_id long, chunk_id long, rank0 int, text string")).count() == 0


def test_query_against_the_loop(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in search._candidates(spark, sf).select("query_id", "chunk_id", "rank0", "text").collect()]
    got = sorted(((r.query_id, r.chunk_id, r.rank0) for r in search.near_dup(spark, sf).collect()), key=str)
    assert got == greedy(rows) and 0 < len(got) < len(rows)
