import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import merkle
from tests.llm.sql import same_rows


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def fold_up(leaves, run):
    """The root of a list of hex digests and each one's siblings, level by level."""
    level, at, proofs = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for i, p in enumerate(proofs):
            a = at[i] - at[i] % run
            p.append((at[i] % run, [x for j, x in enumerate(level[a : a + run], a) if j != at[i]]))
            at[i] //= run
        level = [H(*level[j : j + run]) for j in range(0, len(level), run)]
    return level[0], proofs


def brute(rows, run):
    """(group, key, leaf) to {(group, key, leaf): [(subroot, proof, root)]}."""
    groups = defaultdict(list)
    for g, k, leaf in rows:
        groups[g].append((k is not None, k if k is not None else 0, leaf, k))
    names = sorted(groups, key=lambda g: b"" if g is None else b"=" + g.encode())
    subs = {g: fold_up([x[2] for x in sorted(groups[g])], run) for g in names}
    root, tops = fold_up([subs[g][0] for g in names], run)
    out = defaultdict(list)
    for g, top in zip(names, tops, strict=True):
        for x, p in zip(sorted(groups[g]), subs[g][1], strict=True):
            out[g, x[3], x[2]].append((subs[g][0], p + top, root))
    return out


def check(spark, rows, run=2):
    df = spark.createDataFrame([(g, k, bytearray.fromhex(leaf), "x") for g, k, leaf in rows], "lang string, key long, leaf binary, i string")
    got, root = merkle.manifest(df, "lang", "key", "leaf", "test")
    got = got.select("lang", "key", merkle.as_hex(F.col("leaf")).alias("leaf"), merkle.as_hex(F.col("subroot")).alias("subroot"), merkle.proof_digest(F.col("steps")).alias("proof"), merkle.fold(F.col("leaf"), F.col("steps")).alias("folded"), merkle.fold(F.unhex(F.lit("00" * 32)), F.col("steps")).alias("other"))
    have = defaultdict(list)
    for r in got.collect():
        have[r.lang, r.key, r.leaf].append((r.subroot, r.proof, r.folded))
        assert r.folded == root != r.other
    want = {k: sorted((s, H(*(x for _, others in p for x in others)), r) for s, p, r in v) for k, v in brute(rows, run).items()}
    assert {k: sorted(v) for k, v in have.items()} == want


def some(n, langs, seed=0):
    return [(langs[i * i % len(langs)], i // 2 * 7919 % 1000 if i % 11 else None, H(str(i), str(seed))) for i in range(n)]


@pytest.mark.parametrize("n,langs", [(1, ["en"]), (2, ["en"]), (3, [None, "en", "é"]), (9, ["b", "", None, "a", "A", "é", "z"]), (700, ["en"]), (601, ["de", None])])
def test_against_brute_force(spark, n, langs):
    check(spark, some(n, langs))


def test_many_tiers_runs_of_three_and_many_groups(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RUN", 3)
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "WIDTH", 9)
    rows = some(400, ["en"]) + some(100, [None, "a", "b", "c", "d", "e", "f", "g", "h", "i", "j", "k"], 1)
    check(spark, rows + rows[5:25], 3)  # repeated rows are leaves of their own


def test_empty(spark):
    got, root = merkle.manifest(spark.createDataFrame([], "lang string, key long, leaf binary"), "lang", "key", "leaf")
    assert root is None and got.count() == 0


def test_leaves(spark):
    rows = [(1, None, "", None, "é\n" * 40_000), (None, "s", "en", 3, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = [r[0] for r in df.select(merkle.as_hex(merkle.leaf_digest([F.col(c) for c in merkle.FIELDS]))).collect()]
    assert got == [H(*map(field, r)) for r in rows]


def test_query_on_odd_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, leaf int, steps string, g long, root string"
    for name, rows in {"none": [], "odd": [(1, None, None, "s", None, 1, "", 2, ""), (2, "", "", None, 0, 1, "", 2, ""), (2, "", "", None, 0, 1, "", 2, ""), (None, "x", "en", "s", 1, 1, "", 2, "")]}.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = merkle.op13_merkle_manifest(spark, f"{tmp_path}/{name}").collect()
        assert len(got) == len(rows) and len({r.root for r in got}) <= 1


def test_query_against_sql(spark):
    same_rows(spark, "op13_merkle_manifest")
