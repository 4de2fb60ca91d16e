import shutil

import pytest

from corpusloom.llm import decontaminate, toxicity
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_near_dup import brute as brute_near


@pytest.fixture(scope="module")
def small(tmp_path_factory):
    """The tables at sf0.001 with nulls, empty texts, repeated rows and an extra column added."""
    out = tmp_path_factory.mktemp("sf")
    for name in ("labels", "benchmark"):
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", out)
    return out


def test_stages_against_brute_force(spark, small):
    import corpus_pipeline as P

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", "x", None), (9002, "", "en", "x", 0), (9003, "one two", "en", "x", 7), (9003, "one two", "en", "x", 7), (None, "no id", "en", "x", 5)], docs.schema)
    docs = docs.unionByName(extra)
    docs.write.parquet(f"{small}/documents.parquet")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {}
    for name, stage in P.STAGES:
        docs = stage(spark, docs, str(small))
        docs.write.parquet(f"{small}/{name}")
        docs = spark.read.parquet(f"{small}/{name}")
        rows[name] = docs.collect()
        if name != "sentencepiece":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    left = {r.doc_id for r in rows["toxicity"]}
    gone = [d for d, _ in before if d not in left]
    assert all(labels.get(d, 1) for d in gone if toxicity.crc_mod(d) != 1)
    pairs = [(r.doc_id, r.text) for r in rows["toxicity"]]
    removed = brute_lines(pairs)
    want = [(d, t if t is None or d not in removed else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in removed[d])) for d, t in pairs]
    got = [(r.doc_id, r.text) for r in rows["line_dedup"]]
    assert sorted(got, key=str) == sorted(want, key=str)
    comp = brute_near([x for x in got if x[0] is not None], 5, 80)
    assert sorted((r.doc_id for r in rows["near_dup"]), key=str) == sorted([d for d, c in comp.items() if c[2]] + [None], key=str)
    items = [" ".join(map(str, w.tolist())) for w in decontaminate.words_of([r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()])]
    kept = {r.doc_id for r in rows["decontamination"]}
    for r in rows["near_dup"]:
        words = " ".join(map(str, decontaminate.words_of([r.text])[0].tolist()))
        assert not (any(i in words for i in items) and r.doc_id in kept)
    assert [r.doc_id for r in rows["sentencepiece"]].count(None) == 1
    assert len(rows["sentencepiece"]) == len(rows["decontamination"]) and all(r.parity for r in rows["sentencepiece"])


def test_run_is_the_stages(spark):
    import corpus_pipeline as P

    assert P.run(spark, "/root/testdata/sf0.001").count() > 0
