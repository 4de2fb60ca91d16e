import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from corpusloom.llm import quality as Q


def corpus(n=300):
    rng = np.random.default_rng(4)
    words = ["ban", "ka", "lore", "mi", "sate", "trun", "ve"]
    docs = []
    for i in range(n):
        w = [words[j] for j in rng.integers(0, 7, 40)]
        good = i % 3 > 0
        text = " ".join(w) + "." if good else " ".join(x + "%%%" for x in w)
        docs.append((i, text, "en", f"src{i % 5}", len(text), 0.0))
    docs += [(n, None, None, None, None, 0.0), (n + 1, "", "en", "a", 0, 0.0), (n + 2, "word " * 100_000, "en", "a", 5, 0.0), (0, docs[0][1], "en", "src0", docs[0][4], 0.0)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(0, n, 2)] + [(None, 1, 0), (n, None, 0), (10**9, 1, 0)]
    return docs, labels


def test_train_and_score(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, score double")
    b = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = Q.train(d, b)
    assert model.exchanged > 0
    rows = Q.score_documents(d, model).collect()
    assert len(rows) == 304
    held = [r for r in rows if r.doc_id < 300 and r.doc_id % 2]
    assert np.mean([r.keep == (r.doc_id % 3 > 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    none = Q.train(d, b.limit(0))
    assert {(r.score, r.keep) for r in Q.score_documents(d, none).collect()} == {(0.5, True)}
    assert Q.score_documents(d.limit(0), model).count() == 0
    bare = d.select("doc_id", "text")
    assert Q.score_documents(bare, Q.train(bare, b)).count() == 304


def test_features_are_of_the_whole_text():
    long = "a b c " * 400_000
    x = Q.text_features(pa.array([long, long + "%%%%" * 100_000, None]))
    assert x.shape == (3, Q.N_TEXT) and not np.allclose(x[0], x[1]) and np.isfinite(x).all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = Q.train(docs, labels, "doc_id % 3 <> 1")
    got = Q.score_documents(docs, model).join(labels, "doc_id").filter("doc_id % 3 = 1").collect()
    assert np.mean([r.keep == bool(r.quality) for r in got]) > 0.93


def test_contradicting_labels_and_repeated_ids_in_any_order(spark):
    """The fit doesn't depend on which of the contradicting rows comes first."""
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    more = docs.filter("doc_id % 3 = 0").withColumn("text", F.concat(F.lit("other "), "text"))
    both = labels.unionByName(labels.filter("doc_id % 4 = 0").withColumn("quality", 1 - F.col("quality")))
    scores = []
    for d, k in ((docs.unionByName(more), both), (more.unionByName(docs).repartition(7), both.orderBy(F.desc("doc_id")).repartition(3))):
        model = Q.train(d, k, rounds=0)  # the labelled rows alone; rows of the pool with equal ids are told apart by their place
        scores.append(sorted((r.doc_id, round(r.score, 9)) for r in Q.score_documents(docs, model).collect()))
    assert scores[0] == scores[1]
