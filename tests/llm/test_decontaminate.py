import random

import numpy as np

from corpusloom.llm import decontaminate as D


def distance_in(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        prev, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (a != b))
    return min(row)


def test_recall_and_precision_against_brute_force():
    rng = random.Random(3)
    vocab = ["of", "the", "and", "to"] * 8 + [f"w{i}" for i in range(300)]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [say(rng.randint(8, 60)) for _ in range(25)]
    texts = []
    for _ in range(300):
        t = list(rng.choice(items))
        for _ in range(rng.randint(0, int(0.25 * len(t)))):
            at = rng.randrange(len(t))
            t[at : at + rng.choice([0, 1, 1])] = say(rng.choice([0, 1, 1]))
        texts.append(say(rng.randint(0, 40)) + t + say(rng.randint(0, 40)))
    m = D.Matcher([(i, " ".join(x)) for i, x in enumerate(items)])
    got = {(r, m.ids[k]): d for r, k, s, e, d in m.scan_texts(D.pa.array([" ".join(t) for t in texts], D.pa.large_string()))}
    want = {}
    for r, t in enumerate(texts):
        for i, x in enumerate(items):
            d = distance_in(x, t)
            if d <= int(len(x) * D.MAX_EDIT):
                want[r, i] = d
    assert set(got) <= set(want) and len(want) > 150
    assert len(got) >= 0.99 * len(want)
    assert all(got[k] >= want[k] for k in got) and np.mean([got[k] == want[k] for k in got]) > 0.99


def test_cgk_keeps_equal_equal_and_near_near():
    rng = np.random.default_rng(0)
    a = rng.integers(1, 2**63, (50, 40)).astype(np.uint64)
    b = a.copy()
    b[:, 10] = 7
    assert (D.cgk(a, 0) == D.cgk(a, 0)).all()
    assert (D.cgk(a, 0) == D.cgk(b, 0)).mean() > 0.7
    assert (D.cgk(a, 0)[:, :50] == D.cgk(a[::-1], 0)[:, :50]).mean() < 0.1


def test_odd_rows(spark):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, None), (2, ""), (3, "!!! ..."), (4, "ONE, two; three-four five six x eight nine ten"), (5, item), (5, item), (6, "word " * 200_000 + item + " end"), (7, "one two three"), (8, item + " and " + item)]
    d = spark.createDataFrame([(i, t, 9) for i, t in docs], "doc_id long, text string, item_id long")
    b = spark.createDataFrame([(11, item, 0), (10, item.upper(), 0), (12, None, 0), (13, "...", 0), (None, item, 0)], "item_id long, text string, doc_id long")
    got = sorted(tuple(r) for r in D.leaks(d, b).collect())
    assert got == [(4, 10, 0, 10, 1, 10), (5, 10, 0, 10, 0, 10), (5, 10, 0, 10, 0, 10), (6, 10, 200000, 200010, 0, 10), (8, 10, 0, 10, 0, 10), (8, 10, 11, 21, 0, 10)]
    assert sorted(r.doc_id for r in D.clean(d, b).collect()) == [1, 2, 3, 7]
    assert D.clean(d, b).columns == d.columns
    assert D.leaks(d.limit(0), b).count() == 0 and D.leaks(d, b.limit(0)).count() == 0 and D.clean(d, b.limit(0)).count() == 9
    assert sorted(tuple(r) for r in D.leaks(d, b, block_items=1).collect()) == got
