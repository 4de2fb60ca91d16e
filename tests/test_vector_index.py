import numpy as np
import pytest

from corpusloom.operators import vector_index as I

SF = "/root/testdata/sf0.01"


def brute(ids, x, q_ids, q, k):
    ok = np.isfinite(x).all(1) & (np.linalg.norm(x, axis=1) > 0)
    ids, x = np.asarray(ids)[ok], I.unit(x[ok].astype(np.float32).astype(float))
    score = np.round(I.unit(q.astype(np.float32).astype(float)) @ x.T, 6)
    out = []
    for i, s in zip(q_ids, score, strict=True):
        out += [(i, int(ids[j]), float(s[j]), r) for r, j in enumerate(np.lexsort((ids, -s))[:k])]
    return sorted(out)


def frames(spark, ids, x, q_ids, q):
    v = spark.createDataFrame([(int(i), r.tolist(), 7) for i, r in zip(ids, x, strict=True)], "chunk_id long, embedding array<double>, cell int")
    return v, spark.createDataFrame([(int(i), r.tolist(), "x") for i, r in zip(q_ids, q, strict=True)], "query_id long, embedding array<double>, q string")


def rows(df):
    return sorted((r.query_id, r.chunk_id, r.score, r.rank0) for r in df.collect())


@pytest.mark.parametrize("hot", [False, True])
def test_exact_search_is_brute_force(spark, tmp_path, monkeypatch, hot):
    """Blocks and query blocks of a few rows; a vector that a third of all rows share makes one cell many blocks."""
    monkeypatch.setattr(I, "BLOCK_ROWS", 16)
    monkeypatch.setattr(I, "BLOCK_QUERIES", 5)
    r = np.random.default_rng(3)
    x = r.normal(size=(600, 6))
    if hot:
        x[::3] = x[0] * r.uniform(0.5, 2, (200, 1)).round(1)
    x[7], x[8, 2], x[9, 1] = 0, np.nan, np.inf
    ids, q = np.arange(600) * 3, np.concatenate([r.normal(size=(12, 6)), x[:1]])
    v, asked = frames(spark, ids, x, range(13), q)
    made = I.VectorIndex.build(v, f"file://{tmp_path}/index", 6, cells=20)
    assert len(made.centroids) == 20 and spark.read.parquet(f"file://{tmp_path}/index/blocks").selectExpr("sum(size(rows))").first()[0] == 597
    want = brute(ids, x, range(13), q, 9)
    assert rows(made.search(asked, 9, probes=2, exact=True)) == want
    again = I.VectorIndex.open(spark, f"file://{tmp_path}/index")
    assert rows(again.search(asked, 9, probes=20)) == want
    assert rows(again.search(asked, 1000, probes=1, exact=True)) == brute(ids, x, range(13), q, 1000)


def test_recall_of_every_twentieth_row(spark, tmp_path):
    v = spark.read.parquet(f"{SF}/embeddings.parquet").selectExpr("vec_id chunk_id", "embedding")
    asked = v.filter("chunk_id % 20 = 0").withColumnRenamed("chunk_id", "query_id")
    made = I.VectorIndex.build(v, f"file://{tmp_path}/index", 64)
    got = {r[:2] for r in rows(made.search(asked, 10))}
    want = {r[:2] for r in rows(made.search(asked, 10, exact=True))}
    data = v.orderBy("chunk_id").collect()
    x = np.array([r.embedding for r in data])
    some = [r.chunk_id for r in data if r.chunk_id % 20 == 0]
    assert want == {r[:2] for r in brute([r.chunk_id for r in data], x, some, np.array([r.embedding for r in data if r.chunk_id % 20 == 0]), 10)}
    assert len(got & want) / len(want) >= 0.9
    assert I.VectorIndex.open(spark, f"file://{tmp_path}/index").probes == made.probes < len(made.centroids)


def test_nothing_to_find(spark, tmp_path):
    v, asked = frames(spark, [], np.zeros((0, 3)), [1], np.ones((1, 3)))
    made = I.VectorIndex.build(v, f"file://{tmp_path}/index", 3)
    assert made.search(asked, 5, exact=True).count() == 0
    v, _ = frames(spark, [1, 2], np.ones((2, 3)), [], np.zeros((0, 3)))
    made = I.VectorIndex.build(v, f"file://{tmp_path}/two", 3)
    assert made.search(asked.limit(0), 5, exact=True).count() == 0
    wrong = spark.createDataFrame([(1, [1.0]), (2, None), (None, [1.0, 2.0, 3.0]), (4, [0.0, 0.0, 0.0]), (5, [2.0, 2.0, 2.0])], "query_id long, embedding array<double>")
    assert rows(made.search(wrong, 5)) == [(5, 1, 1.0, 0), (5, 2, 1.0, 1)]
