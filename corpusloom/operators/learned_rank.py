"""A reranker's score learned from feedback triplets (M11): pairwise logistic regression over columns.

A query and a text are compared by how much of the query's words, pairs and
triples of words the text holds, and by the text's length. For each triplet the
positive text's features less the negative's are one example, and the reverse
another; the weights are fitted by Spark over all triplets, and only as many
numbers as there are features come to the driver. Scores are built-in
expressions, so candidates never leave the JVM.

A null query or text counts as empty; a query without words has no part of it
in any text. Without triplets every weight is 0 and candidates keep their order.
Repeated triplets count as often as they come.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.operators.retrieval import rerank
from corpusloom.session import stage_table

FEATURES = ("words", "pairs", "triples", "log_length")
RIDGE = 0.01


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def runs_of(words: Column, n: int) -> Column:
    """Distinct runs of ``n`` words; none where there are fewer."""
    if n == 1:
        return F.array_distinct(words)
    places = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.array_join(F.slice(words, i + 1, n), " ")))


def features(query: Column, text: Column) -> Column:
    """``array<double>`` in the order of ``FEATURES``."""
    once = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)  # binds a value, so that it isn't worked out for each place

    def held(q: Column, t: Column, n: int) -> Column:
        share = lambda runs: F.try_divide(F.size(F.array_intersect(runs, runs_of(t, n))).cast("double"), F.size(runs))
        return F.coalesce(once(runs_of(q, n), share), F.lit(0.0))

    def of(q: Column, t: Column) -> Column:
        return F.array(*[held(q, t, n) for n in (1, 2, 3)], F.log1p(F.size(t).cast("double")))

    return once(words_of(query), lambda q: once(words_of(text), lambda t: of(q, t)))


def fit(triplets: DataFrame) -> list[float]:
    """Weights of ``FEATURES`` from ``triplets(query, positive, negative)``."""
    query = F.col("query")
    gap = F.zip_with(features(query, F.col("positive")), features(query, F.col("negative")), lambda p, n: p - n)
    gaps = triplets.select(gap.alias("gap"))
    both = gaps.select("gap", F.explode(F.array(F.lit(1.0), F.lit(0.0))).alias("label"))
    signed = F.transform("gap", lambda x: F.when(F.col("label") == 1, x).otherwise(-x))
    examples = stage_table(both.select(signed.alias("x"), "label"), "rank-examples")
    if examples.isEmpty():
        return [0.0] * len(FEATURES)
    model = LogisticRegression(featuresCol="v", fitIntercept=False, regParam=RIDGE, standardization=False, maxIter=200, tol=1e-10)
    return model.fit(examples.select(array_to_vector("x").alias("v"), "label")).coefficients.toArray().tolist()


def score(query: Column, text: Column, weights: Sequence[float]) -> Column:
    products = F.zip_with(features(query, text), F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x * w)
    return F.aggregate(products, F.lit(0.0), lambda a, x: a + x)


def learned_rerank(ranked: DataFrame, weights: Sequence[float], top_n: int = 6, threshold: float = float("-inf")) -> DataFrame:
    """``rerank`` by the learned score. It orders a query's candidates; it has no zero of its own, so nothing falls below a threshold unless one is given."""
    return rerank(ranked, score(F.col("query"), F.col("text"), weights), top_n, threshold)
