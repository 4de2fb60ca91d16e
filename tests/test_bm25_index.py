import random

import pytest

from corpusloom.operators import bm25_index as I, retrieval as V
from corpusloom.sources import sinks

SCHEMA = "chunk_id long, text string, collection_id string"


def corpus(n, seed=1, sources=("a", "b", None, "=", "")):
    r = random.Random(seed)
    words = ["the"] * 60 + ["court"] * 20 + [f"w{i}" for i in range(200)]
    text = lambda: " ".join(r.choices(words, k=r.choice([1, 3, 10, 40, 300])))
    return [(i, r.choice([None, "", "...", "5/3-1 the"]) if r.random() < 0.05 else text(), r.choice(sources)) for i in range(n)]


def questions(spark):
    return spark.createDataFrame([(1, "the court w1 w2"), (2, "w3 w3 w77 nothing"), (3, "5/3-1"), (4, "absent"), (5, None), (6, "the"), (7, "")], "query_id long, query string")


def rows(df):
    return sorted((r.query_id, r.rank0, r.chunk_id, round(r.score, 5)) for r in df.collect())


@pytest.mark.parametrize("shard,pilots,k", [(8, 1, 5), (50, 2, 20), (16_384, 4, 1000)])
def test_search_is_that_of_scoring_everything(spark, tmp_path, monkeypatch, shard, pilots, k):
    monkeypatch.setattr(I, "SHARD_DOCS", shard)
    monkeypatch.setattr(I, "PILOTS", pilots)
    docs = spark.createDataFrame(corpus(700), SCHEMA)
    index = I.Bm25Index(spark, f"file://{tmp_path}/index")
    assert index.refresh(docs) == 5
    assert rows(index.search(questions(spark), k)) == rows(V.bm25_top_k(docs, questions(spark), k))


def test_blocks_are_skipped(spark, tmp_path, monkeypatch):
    """Long texts can't reach what short ones score: their postings aren't read again."""
    monkeypatch.setattr(I, "PILOTS", 2)
    docs = spark.createDataFrame([(i, "rare " + "the " * (1 if i < 50 else 2000), "a") for i in range(200)], SCHEMA)
    index = I.Bm25Index(spark, f"file://{tmp_path}/index")
    index.refresh(docs)
    read = {}
    scored = I.Bm25Index._scored

    def counted(self, asks, blocks, avgdl, label):
        read[label] = asks.count()
        return scored(self, asks, blocks, avgdl, label)

    monkeypatch.setattr(I, "PILOTS", 1)
    monkeypatch.setattr(I.Bm25Index, "_scored", counted)
    q = spark.createDataFrame([(1, "rare")], "query_id long, query string")
    assert [r.chunk_id for r in index.search(q, 10).orderBy("rank0").collect()] == list(range(10)) and read == {"first": 1, "later": 0}


def test_refresh_rebuilds_what_changed(spark, tmp_path):
    data = corpus(200)
    index = I.Bm25Index(spark, f"file://{tmp_path}/index")
    docs = lambda: spark.createDataFrame(data, SCHEMA)
    same = lambda: rows(index.search(questions(spark), 30)) == rows(V.bm25_top_k(docs(), questions(spark), 30))
    assert index.refresh(docs()) == 5 and same()
    files = lambda: {f for f in index.blocks().inputFiles()}
    before = files()
    assert index.refresh(docs()) == 0 and files() == before
    data = [(i, t if c != "a" else f"{t} w1", c) for i, t, c in data if c != "b"] + [(9000, "w1 new", "new")]
    assert index.refresh(docs()) == 3 and same()
    assert {f for f in before if f in files()} == {f for f in before if f"part={part(spark, 'a')}" not in f and f"part={part(spark, 'b')}" not in f}
    data = [(i, None if c == "a" else t, c) for i, t, c in data]  # a collection without texts has no blocks
    assert index.refresh(docs()) == 1 and same() and not any(part(spark, "a") in f for f in files())
    assert index.refresh(docs(), force=True) == 5 and same() and not files() & before
    data = []
    assert index.refresh(docs()) == 5 and index.blocks().count() == 0 and index.search(questions(spark), 3).count() == 0


def part(spark, name):
    return spark.createDataFrame([(name,)], "c string").select(I.part_of(I.F.col("c"))).first()[0]


@pytest.mark.parametrize("step", range(4))
def test_a_lost_refresh_is_made_good(spark, tmp_path, monkeypatch, step):
    """The run is lost at a step; the next refresh leaves the right index."""
    data = corpus(150)
    index = I.Bm25Index(spark, f"file://{tmp_path}/index")
    index.refresh(spark.createDataFrame(data, SCHEMA))
    data = [(i, f"{t} w5", c) if c == "a" else (i, t, c) for i, t, c in data]
    docs = spark.createDataFrame(data, SCHEMA)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        if step == 0:
            m.setattr(I.Bm25Index, "_put_counts", lost)
        elif step == 1:
            m.setattr(I, "delete", lost)
        elif step == 2:
            m.setattr(I.Bm25Index, "_blocks", staticmethod(lost))
        else:
            put = I.Bm25Index._put_counts
            calls = []
            m.setattr(I.Bm25Index, "_put_counts", lambda self, counts: lost() if calls else (calls.append(1), put(self, counts)))
        with pytest.raises(OSError):
            index.refresh(docs)
    assert index.refresh(docs) == 1
    assert rows(index.search(questions(spark), 30)) == rows(V.bm25_top_k(docs, questions(spark), 30))
    sinks.delete(spark, f"{tmp_path}/nothing there")


@pytest.mark.parametrize("repeated", [False, True])
def test_a_shard_tells_the_best_alone(spark, tmp_path, monkeypatch, repeated):
    """Unless rows of one id stand in several shards: then all hits are told and added."""
    monkeypatch.setattr(I, "SHARD_BYTES", 2000)
    data = corpus(400, 3) + ([(7, "the court w1 w2 w3", "b"), (7, "w3 " * 50, "a"), (9, "the", None)] if repeated else [])
    docs = spark.createDataFrame(data, SCHEMA)
    index = I.Bm25Index(spark, f"file://{tmp_path}/index")
    index.refresh(docs)
    assert index.spread() is repeated
    assert index.blocks().select("part", "shard").distinct().count() > 20
    told = {}
    scored = I.Bm25Index._scored

    def counted(self, asks, blocks, avgdl, label):
        out = scored(self, asks, blocks, avgdl, label)
        told[label] = out.count(), asks.select("query_id", "part", "shard").distinct().count()
        return out

    monkeypatch.setattr(I.Bm25Index, "_scored", counted)
    assert rows(index.search(questions(spark), 3)) == rows(V.bm25_top_k(docs, questions(spark), 3))
    assert repeated or all(n <= 3 * cells for n, cells in told.values())
