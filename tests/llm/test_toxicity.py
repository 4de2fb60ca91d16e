import numpy as np
from hypothesis import given, settings, strategies as st

from corpusloom.llm import toxicity as T

TERMS = {"idiot": 5.0, "moron": 5.0, "disgusting": 5.0, "scum": 5.0, "réeux*": 4.0}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def brute(word):
    found = []
    for t in TERMS:
        if t.endswith("*"):
            if word.startswith(t[:-1]):
                found.append((0, -len(t), t))
        else:
            d, most = distance(word, t), 2 if len(t) >= 10 else 1 if len(t) >= 5 else 0
            if d <= most:
                found.append((d, -len(t), t))
    return min(found, default=(None,))[0]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text("idotmrnsguc", max_size=12), st.builds(lambda t, i, c: t[: i % len(t)] + c + t[i % len(t) :], st.sampled_from(["idiot", "moron", "disgusting", "scum", "réeuxa"]), st.integers(0, 20), st.text("abdi", max_size=2))))
def test_automaton_against_edit_distance(word):
    hit = T.Automaton(TERMS).match(word)
    assert (hit[1] if hit else None) == brute(word)


def test_quotation_and_leet():
    auto = T.Automaton(TERMS)
    assert [h[2:] for h in T.hits("you id1ot, such a m0ron", auto)] == [("idiot", 0, False), ("moron", 0, False)]
    assert [h[4] for h in T.hits('he wrote "idiot" there', auto)] == [True]
    assert T.hits(None, auto) == [] and T.hits("", auto) == []
    assert len(T.hits("clean words " * 20_000 + "idiot", auto)) == 1


def corpus(spark, n=240):
    docs = [(i, f"common words here {i} " + ("you idiot and moron" if i % 4 == 0 else "a fine day"), "x") for i in range(n)]
    docs += [(n, None, "x"), (n + 1, "", "x"), (n, None, "x")]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(n)] + [(None, 1, 1), (n, 1, None)]
    return spark.createDataFrame(docs, "doc_id long, text string, toxicity string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_train_and_score(spark):
    docs, labels = corpus(spark)
    model = T.train(docs, labels, ~T.held_out())
    rows = T.score_documents(docs, model).collect()
    assert len(rows) == 243
    assert all((r.toxicity >= T.THRESHOLD) == (r.doc_id < 240 and r.doc_id % 4 == 0) for r in rows)
    none = T.train(docs, labels.limit(0), ~T.held_out())
    assert {r.toxicity for r in T.score_documents(docs, none).collect()} == {0.0}
    assert T.score_documents(docs.limit(0), model).count() == 0


def test_contradicting_labels_and_texts(spark):
    docs, labels = corpus(spark)
    more = spark.createDataFrame([(i, 0, 0) for i in range(0, 240, 4)], labels.schema)
    twice = docs.unionByName(spark.createDataFrame([(1, "zzz you idiot", "x")], docs.schema))
    want = {r.doc_id: r.toxicity for r in T.score_documents(docs, T.train(docs, labels, ~T.held_out())).collect()}
    for d, y in ((twice, labels.unionByName(more)), (twice.repartition(7, "text"), more.unionByName(labels))):
        got = {r.doc_id: r.toxicity for r in T.score_documents(docs, T.train(d, y, ~T.held_out())).collect()}
        assert got == want  # the toxic label of an id counts, and its least text


def test_no_term_is_dropped():
    n = 700
    texts = [f"w{''.join(chr(97 + i // 26**k % 26) for k in range(3))}" for i in range(n)]
    found = T.learn_terms([f"xx {' '.join(texts)}"] * 8 + ["xx fine"] * 40, np.array([1] * 8 + [0] * 40))
    assert set(texts) <= set(found) or all(any(t.startswith(f[:-1]) for f in found if f.endswith("*")) for t in texts if t not in found)


def test_held_out_recall(spark):
    """Precision alone is easy where few are toxic: recall and the rank of toxic over clean texts are what is asserted."""
    from __spark_entry__ import queries

    sf = "/root/testdata/sf0.1"
    got = queries()["op6_toxicity"](spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    y = np.array([(r.toxic, r.predicted, r.score) for r in got.collect()])
    toxic, clean = y[y[:, 0] == 1], y[y[:, 0] == 0]
    assert toxic[:, 1].mean() > 0.88 and clean[:, 1].mean() < 0.01
    above = (toxic[:, 2][:, None] > clean[:, 2]).mean() + (toxic[:, 2][:, None] == clean[:, 2]).mean() / 2
    assert above > 0.95
