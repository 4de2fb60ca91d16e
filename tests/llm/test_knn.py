import numpy as np

from corpusloom.llm import knn


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(400, 8)).round(1)
    v[50:150] = v[50]  # one very common vector: ties
    rows = [(i, [float(x) for x in v[i]], "e") for i in range(400)]
    bad = [(1000, None, "e"), (1050, [1.0, None] * 4, "e"), (1100, [float("nan")] * 8, "e"), (1150, [float("inf")] * 8, "e"), (1200, [], "e"), (1250, [1.0], "e")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, score string")
    clean = knn.clean_vectors(df, "vec_id", "embedding", 256)
    got = knn.top_k(clean, clean.filter("id % 50 = 0"), 5, shard_rows=90, block_queries=3).collect()
    q = np.floor(v * 256)
    want = set()
    for i in range(0, 400, 50):
        s = q @ q[i]
        best = sorted((j for j in range(400) if j != i), key=lambda j: (-s[j], j))[:5]
        want |= {(i, r + 1, j, int(s[j])) for r, j in enumerate(best)}
    assert {tuple(r) for r in got} == want


def test_empty_and_few(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    clean = knn.clean_vectors(df, "vec_id", "embedding", 256)
    assert knn.top_k(clean, clean, 5).count() == 0
    two = knn.clean_vectors(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>"), "vec_id", "embedding", 256)
    assert sorted(tuple(r) for r in knn.top_k(two, two, 5).collect()) == [(0, 1, 1, 131072), (1, 1, 0, 131072)]
