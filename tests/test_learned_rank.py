"""The learned reranker: features and weights against plain Python, and the order of held-out queries."""

import math
import re

import numpy as np
from pyspark.sql import functions as F

from corpusloom.operators import learned_rank as L, relational as R, retrieval as V


def plain(query, text):
    q, t = ([w for w in re.split(r"[^\w]+|_", (x or "").lower()) if w] for x in (query, text))
    out = []
    for n in (1, 2, 3):
        a, b = ({" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} for w in (q, t))
        out.append(len(a & b) / len(a) if a else 0.0)
    return [*out, math.log1p(len(t))]


PAIRS = [("the Right to counsel", "a right to COUNSEL, at trial"), ("one", ""), (None, "x y"), ("", None), ("é ü — ü é", "ü é ü"), ("a b c d", "d c b a b c"), ("word", "word " * 5000)]


def test_features(spark):
    df = spark.createDataFrame(PAIRS, "query string, text string")
    got = [r.x for r in df.select(L.features(F.col("query"), F.col("text")).alias("x")).collect()]
    assert np.allclose(got, [plain(*p) for p in PAIRS])


def newton(gaps):
    """Least mean logistic loss of gaps against 0 with the ridge of the library."""
    x, w = np.array(gaps), np.zeros(len(gaps[0]))
    for _ in range(100):
        p = 1 / (1 + np.exp(x @ w))
        grad = -(x * p[:, None]).mean(0) + L.RIDGE * w
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(x) + L.RIDGE * np.eye(len(w))
        w = w - np.linalg.solve(hess, grad)
    return w


def test_weights_against_newton(spark):
    rng = np.random.default_rng(4)
    say = lambda n: " ".join(rng.choice(list("abcdefgh"), n))
    rows = [(say(5), say(int(rng.integers(0, 30))), say(int(rng.integers(0, 30)))) for _ in range(300)]
    rows += rows[:5] + [(None, "a", "b"), ("a", None, "")]
    weights = L.fit(spark.createDataFrame(rows, "query string, positive string, negative string"))
    want = newton([np.subtract(plain(q, p), plain(q, n)) for q, p, n in rows])
    assert np.allclose(weights, want, atol=1e-4)


def test_without_triplets_the_order_stays(spark):
    weights = L.fit(spark.createDataFrame([], "query string, positive string, negative string"))
    assert weights == [0.0] * 4
    ranked = spark.createDataFrame([(1, i, i, "q", f"text {i}") for i in range(9)], "query_id long, chunk_id long, rank0 int, query string, text string")
    got = L.learned_rerank(ranked, weights).collect()
    assert all(r.post_rank == r.rank0 and r.survived == (r.rank0 < 6) for r in got)


def test_held_out_queries(spark):
    """Fitted on half of the queries, the score sets relevant over other candidates of the other half more often than the stand-in does."""
    from corpusloom.plans.search import _candidates

    ranked = _candidates(spark, "/root/testdata/sf0.01").withColumn("relevant", F.contains(F.lower("text"), F.lower("query"))).persist()
    half = ranked.filter("query_id % 2 = 0").withColumn("label", F.when(F.col("relevant"), "RELEVANT").otherwise("IRRELEVANT"))
    weights = L.fit(R.training_triplets(half.select("query", "text", "chunk_id", "label", F.col("score").alias("ce_score"))))
    rest = ranked.filter("query_id % 2 = 1")

    def pairs_in_order(scored):
        a, b = scored.filter("relevant").select("query_id", F.col("ce_score").alias("a")), scored.filter("not relevant").select("query_id", F.col("ce_score").alias("b"))
        return a.join(b, "query_id").agg(F.avg((F.col("a") > F.col("b")).cast("int")), F.count("*")).first()

    learned, n = pairs_in_order(L.learned_rerank(rest, weights))
    stand_in, _ = pairs_in_order(V.rerank(rest))
    ranked.unpersist()
    assert n > 20 and learned > 0.9 and learned >= stand_in
