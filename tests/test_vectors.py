import numpy as np

from corpusloom.operators import retrieval as V


def test_more_queries_than_a_block_holds(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 5))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "chunk_id long, embedding array<double>")
    q = v.filter("chunk_id % 3 = 0").withColumnRenamed("chunk_id", "query_id")
    got = sorted((r.query_id, r.rank0, r.chunk_id, r.score) for r in V.vector_top_k(v, q, 4, max_queries=6).collect())
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = []
    for i in range(0, 60, 3):
        score = np.round(unit @ unit[i], 6)
        want += [(i, r, int(j), float(score[j])) for r, j in enumerate(np.lexsort((np.arange(60), -score))[:4])]
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=2e-6)


def test_cells_of_many_steps_with_ties_and_odd_vectors(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.integers(-2, 3, size=(500, 3)).astype(float)  # many equal cosines, some of length zero
    rows = [(i, r.tolist()) for i, r in enumerate(x)] + [(500, None), (501, [1.0]), (502, [1.0, None, 2.0]), (None, [1.0, 1.0, 1.0])]
    v = spark.createDataFrame(rows, "chunk_id long, embedding array<double>")
    q = v.filter("chunk_id % 7 = 0 or chunk_id > 499").withColumnRenamed("chunk_id", "query_id")
    monkeypatch.setattr(V, "STEP_QUERIES", 5)
    monkeypatch.setattr(V, "STEP_ROWS", 16)
    got = sorted((r.query_id, r.rank0, r.chunk_id, r.score) for r in V.vector_top_k(v, q, 9, max_queries=20, max_rows=100).collect())

    def cosine(a, b):
        if a is None or b is None or len(a) != len(b) or None in a + b or not any(a) or not any(b):
            return None
        return round(float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b))), 6)

    want = []
    for i, a in rows:
        if i is not None and (i % 7 == 0 or i > 499):
            found = [(cosine(a, b), j) for j, b in rows]
            found.sort(key=lambda f: (f[0] is None, -(f[0] or 0), -1 if f[1] is None else f[1]))
            want += [(i, r, j, s) for r, (s, j) in enumerate(found[:9])]
    assert got == sorted(want)


def test_no_row_meets_a_query_in_a_plan_product(spark):
    v = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(40)], "chunk_id long, embedding array<float>")
    plan = V.vector_top_k(v, v.withColumnRenamed("chunk_id", "query_id"), 3)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert V.vector_top_k(v, v.withColumnRenamed("chunk_id", "query_id").limit(0), 3).count() == 0
    assert V.vector_top_k(v.limit(0), v.withColumnRenamed("chunk_id", "query_id"), 3).count() == 0
