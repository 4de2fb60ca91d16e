import numpy as np

from corpusloom.llm import quality as Q
from tests.llm.test_quality import corpus


def test_surest_rows_of_all_unlabelled_ones(spark):
    docs, labels = corpus(9_000)
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, score double").repartition(5)
    pool = Q.Pool(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = pool.rows.toPandas()
    assert pool.n == len(rows) == 4_502 and set(rows["doc_id"]) == {*range(1, 9_000, 2), 9_001, 9_002}
    x = np.stack([np.frombuffer(b) for b in rows["x"]])
    rng = np.random.default_rng(1)
    models = [Q.Logistic(x[:, :Q.N_TEXT].mean(0), x[:, :Q.N_TEXT].std(0) + 1, rng.normal(size=Q.N_TEXT + 1) * 4), Q.Logistic(x[:, Q.N_TEXT :].mean(0), x[:, Q.N_TEXT :].std(0) + 1, rng.normal(size=Q.N_META + 1) * 9)]
    wishes = [Q.Wish(v, models[v], np.arange(1, 99), 40, 30) for v in (0, 1)]
    for w, (ids, features, y) in zip(wishes, pool.pick(wishes), strict=True):
        odds = models[w.view].log_odds(Q._view(x, w.view)).round(9)
        free = ~np.isin(rows["doc_id"], w.given)
        for label, towards, k in ((1, odds, 40), (0, -odds, 30)):
            good = np.sort(towards[free & (towards >= np.log(9))])[::-1][:k]
            at = y == label
            assert np.allclose(np.sort(models[w.view].log_odds(Q._view(features[at], w.view)) * (1 if label else -1))[::-1], good, atol=1e-8)
            assert len(set(ids[at])) == at.sum() and not set(ids[at]) & set(w.given)
    assert sum(len(p[0]) for p in pool.pick(wishes)) > 40


def test_few_labels_are_fitted(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, score double")
    for some in (labels[:12], [(0, 0, 0), (2, 1, 0)]):
        rows = Q.score_documents(d, Q.train(d, spark.createDataFrame(some, "doc_id long, quality int, toxic int"))).collect()
        assert len({r.score for r in rows}) > 1
    assert np.mean([r.keep == (r.doc_id % 3 > 0) for r in Q.score_documents(d, Q.train(d, spark.createDataFrame(labels[:12], "doc_id long, quality int, toxic int"))).collect() if r.doc_id < 300]) > 0.9
