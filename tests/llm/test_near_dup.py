import random
import re

import numpy as np

from corpusloom.llm import near_dup as N
from corpusloom.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent):
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            s, t = sets[a], sets[b]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus():
    rng = random.Random(5)
    say = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    rows, hot = [], say(60)
    for _ in range(60):
        base = say(rng.randint(3, 200))
        for _ in range(rng.randint(1, 6)):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = f"x{rng.randrange(9999)}"
            rows.append(" ".join(t))
    for i in range(60):  # a chain: neighbours are near, ends are not
        rows.append(" ".join(hot[i // 2 :] + [f"c{j}" for j in range(i // 2)] + hot))
    rows += [None, "", " \n\t", "one", "ONE", "one two", "One  two", "É a b c", "é a b c", "word " * 3000, "a b c d " * 50, "long text " + " ".join(say(60_000))]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1) for i, t in rows] + [(rows[0][0], rows[0][1], 1), (None, "x y", 1)], "doc_id long, text string, n int")
    for size, percent in ((4, 80), (5, 80)):
        got = N.near_duplicates(df, size, percent).collect()
        assert len(got) == len(rows) + 1
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows, size, percent)
    assert N.near_duplicates(df.limit(0)).count() == 0


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(2)
    for j in (0.2, 0.5, 0.8, 0.95):
        errors = []
        for _ in range(40):
            n = 600
            both = int(2 * n * j / (1 + j))
            pool = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
            a, b = pool[:n], np.concatenate([pool[:both], pool[n : 2 * n - both]])
            errors.append(N.estimate(N.registers(a)[None], N.registers(b)[None], np.array([float(n)]), np.array([float(n)]))[0] - j)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


def test_registers_merge():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 2**63, (2, 700)).astype(np.uint64)
    assert (np.maximum(N.registers(a), N.registers(b)) == N.registers(np.concatenate([a, b]))).all()


def test_components(spark):
    path = [(i, i + 1) for i in range(100, 160)] + [(5, 3), (3, 5), (7, 7), (None, 1), (3, 9), (9, 4)]
    got = {tuple(r) for r in connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {(i, 100) for i in range(101, 161)} | {(5, 3), (9, 3), (4, 3)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_of_one_doc_id_are_one_node(spark):
    """Both texts of doc 2 count, in any order of the rows."""
    a, b = [f"w{i}" for i in range(60)], [f"v{i}" for i in range(60)]
    rows = [(1, " ".join(a)), (2, " ".join([*a, "x"])), (2, " ".join([*b, "y"])), (3, " ".join(b))]
    for part in (rows, rows[::-1]):
        got = {(r.doc_id, r.component_id, r.n_shingles) for r in N.near_duplicates(spark.createDataFrame(part, "doc_id long, text string"), 4).collect()}
        assert got == {(1, 1, 57), (2, 1, 58), (3, 1, 57)}
    kept = N.drop_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert [r.doc_id for r in kept] == [1]


def test_structured_words_stay_apart(spark):
    """Thue-Morse words and their complements, which collide under any polynomial hash modulo 2**64."""
    t = "a"
    while len(t) < 2048:
        t += t.translate(str.maketrans("ab", "ba"))
    rows = [(i, x) for i, x in enumerate(v for n in (512, 1024, 2048) for v in (t[:n], t[:n].translate(str.maketrans("ab", "ba"))))]
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert all(r.kept for r in got) and len(got) == 6


def test_estimate_keeps_pairs_at_the_threshold():
    """Of pairs at a similarity of 0.8 the likelihood drops none."""
    rng = np.random.default_rng(4)
    lost = 0
    for n in (8, 40, 400):
        regs = []
        for _ in range(1000):
            every = rng.integers(0, 2**63, n + n // 4, dtype=np.uint64)
            regs.append((N.registers(np.sort(every[:n])), N.registers(np.sort(every))))
        a, b = np.stack([r[0] for r in regs]), np.stack([r[1] for r in regs])
        est = N.estimate(a, b, np.full(len(a), float(n)), np.full(len(a), float(n + n // 4)))
        lost += int((est < 0.8 - N.SLACK).sum())
    assert lost == 0
