import random
from collections import Counter

import numpy as np

from corpusloom.llm import substring_dedup as S


def brute(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        spans = [(i, i + length) for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1]
        out.append(S.merged(spans))
    return out


def corpus():
    rng = random.Random(11)
    say = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    passages = [say(rng.randint(30, 300)) for _ in range(6)]
    texts = []
    for _ in range(60):
        t = say(rng.randint(0, 200))
        for _ in range(rng.randint(0, 3)):
            x = list(rng.choice(passages))
            for _ in range(rng.randint(0, 2)):
                x[rng.randrange(len(x))] = "X"
            t += "".join(x) + say(rng.randint(0, 60))
        texts.append(t)
    return texts + ["a" * 300, "ab" * 200, texts[3], None, "", "q" * 39, say(500) * 2]


def run(spark, texts, length, hot_runs):
    docs = S.keyed(spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n int"))
    spans = {(r.tk, r.n): S.merged([tuple(x) for x in r.spans]) for r in S.repeated_intervals(docs.select("tk", "n", "text"), length, hot_runs).collect()}
    return [spans.get((r.tk, r.n), []) for r in docs.orderBy("doc_id").collect()]


def test_against_brute_force(spark):
    texts = corpus()
    want = brute([(t or "").encode() for t in texts], 40)
    assert run(spark, texts, 40, 20_000) == want
    assert run(spark, texts, 40, 3) == want  # most grams take the path of hot ones


def test_segments_agree(monkeypatch):
    data = np.frombuffer(("".join(random.Random(1).choice("abc") for _ in range(5000))).encode(), np.uint8)
    off = np.array([0, len(data)])
    covered = lambda: sorted(q for _, a, p, b, g, r in S.segments(data, off, 40) for x, y in zip(a, b, strict=True) for q in range(x, y + 1))
    whole = covered()
    monkeypatch.setattr(S, "BLOCK_BYTES", 700)
    assert covered() == whole == list(range(5000 - 39))


def test_query(spark):
    import hashlib

    from __spark_entry__ import queries

    sf = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    want = {}
    for (i, t), spans in zip(docs, brute([t for _, t in docs], 400), strict=True):
        at, kept = 0, b""
        for lo, hi in spans:
            kept, at = kept + t[at:lo], hi
        want[i] = (len(t), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept + t[at:]).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in queries()["op9_suffix_dedup"](spark, sf).collect()}
    assert got == want


def test_empty(spark):
    docs = S.keyed(spark.createDataFrame([], "doc_id long, text string"))
    assert S.repeated_intervals(docs.select("tk", "n", "text")).count() == 0
