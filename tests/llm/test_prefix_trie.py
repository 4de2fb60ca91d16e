import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from corpusloom.llm import prefix_trie
from tests.llm.sql import same_rows


def brute(rows):
    """(conv_id, turn, role, text) to the nodes, one tuple each."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest(), role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + v[h:])
    members = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    ends = lambda p: hashlib.sha256(",".join(str(c) for c in sorted(members[p]) if built[c] == p).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p], ends(p)) for p, m in members.items())


def nodes(spark, rows, label="test"):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 as c", "'x' as i", "2L as depth", "turn as n")  # names of its own columns
    got = prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.turns(df, label), label), label).collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got)


def talks(n, longest, seed):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(n * 3), n):
        for t in range(r.randrange(1, longest)):
            rows.append((c, t if r.random() < 0.95 else None, r.choice(["user", None, ""]), r.choice(["hi", "é́", "", None, "yes " * 9]) if r.random() < 0.7 or t < longest // 2 else f"{r.randrange(20)}"))
    return rows + rows[:5] + [(None, 1, "user", "nobody")]


def test_against_brute_force(spark):
    rows = talks(150, 9, 1)
    assert nodes(spark, rows) == brute(rows)


@pytest.mark.parametrize("block", [2, 3])
def test_deep_conversations_in_blocks_of_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rows = talks(40, 30, 2)
    assert nodes(spark, rows) == brute(rows)


def test_long_shared_prefixes(spark):
    base = [(t, "user", f"turn {t}") for t in range(200)]
    rows = [(c, *x) for c, n in ((100, 200), (200, 64), (300, 128), (400, 65), (500, 130)) for x in base[:n]]
    rows += [(c, t + 1000, "user", f"{c} {t}") for c in (200, 300) for t in range(70)]
    assert nodes(spark, rows) == brute(rows)


def test_many_ends_and_turnless(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS", 4)
    rows = [(c, 0, "user", "same") for c in range(101, 200)] + [(c, t, "user", "same") for c in range(200, 230) for t in range(6)]
    assert nodes(spark, rows) == brute(rows)
    alone = [(c, 0, "user", "x") for c in (101, 102, 103, 104)]
    assert nodes(spark, alone) == brute(alone)


def test_empty_and_long_text(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.turns(df, "none"), "none"), "none").count() == 0
    rows = [(1, 0, "user", "long " * 100_000), (100, 0, None, None)]
    assert nodes(spark, rows) == brute(rows)


def test_query_against_sql(spark):
    same_rows(spark, "op12_prefix_trie")
