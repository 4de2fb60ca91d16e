import pandas as pd
from pyspark.sql import functions as F

from corpusloom.functions import folds


def test_a_worker_holds_few_texts(spark):
    """The tuples of a batch are made and handed over in parts, all of them and in order."""
    made = []
    fold = lambda t: made.append(t) or [(t, t[::-1])] * (len(t) % 3)
    texts = [None if i % 50 == 7 else f"t{i}" for i in range(1000)]
    parts = folds.sections_over_column(fold, ("a", "b")).func(iter([pd.Series(texts)]))
    first = next(parts)
    assert len(first) <= folds.HELD_TEXTS and len(made) <= folds.HELD_TEXTS
    rest = [x for p in parts for x in p]
    assert [len(x) for x in [*first, *rest]] == [len(t) % 3 if t else 0 for t in texts]
    cut = folds.sections_over_column(lambda t: [(t, t[::-1])], ("a", "b"))
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").coalesce(1)
    got = {r["id"]: [tuple(x) for x in r["p"]] for r in df.select("id", cut(F.col("t")).alias("p")).collect()}
    assert got == {i: [(t, t[::-1])] if t else [] for i, t in enumerate(texts)}
