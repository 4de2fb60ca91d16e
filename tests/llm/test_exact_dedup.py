import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import exact_dedup, fuse_filter
from corpusloom.llm.exact_dedup import Dedup, sha256


def brute(rows):
    """(doc_id, text) of all batches to a sorted list of doc_id, keep_id, group_size; ids don't repeat."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups["".join(c for c in text or "" if c not in exact_dedup.BLANKS)].append((-len(text or ""), float("inf") if doc_id is None else doc_id, doc_id))
    out = []
    for members in groups.values():
        keep = min(members)[2]
        out += [(m[2], keep, len(members)) for m in members]
    return sorted(out, key=str)


def ingested(spark, batches, **how):
    dedup = Dedup(spark, "test", **how)
    for rows in batches:
        dedup.ingest(spark.createDataFrame(rows, "doc_id long, text string"))
    return dedup, dedup.result().collect()


def variants(n, seed):
    r = random.Random(seed)
    words = ["a", "b c", "B c", "", None, " ", "\t\n\x0b\x0c\r", "é", "é", " ", " x", "long " * 5000]
    return [(i, r.choice(words) if r.random() < 0.5 else f"{r.choice('xyz')}{' ' * r.randrange(4)}{r.randrange(n // 3)}") for i in range(n)]


@pytest.mark.parametrize("digest", [sha256, lambda c: F.unhex(F.substring(F.sha2(c, 256), 1, 2))], ids=["sha256", "one byte"])
def test_batches_against_brute_force(spark, digest):
    """With digests of one byte most texts share theirs with others, within batches and across."""
    rows = variants(900, 5)
    rows[7] = (None, rows[8][1])
    dedup, got = ingested(spark, [rows[:300], rows[300:310], rows[310:700], rows[700:]], digest=digest)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=str) == brute(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    keys = [k.class_key for s in dedup.snapshots for k in spark.table(s.table).select("class_key").collect()]
    assert len(keys) == len(set(keys)) == len({r[1] for r in brute(rows)})


def test_hot_text_and_repeated_rows(spark):
    rows = [(i, "same text") for i in range(2000)] + [(5000, "same  text")] + [(9, "twice"), (9, "twice")] + [(i, f"own {i}") for i in range(3000, 3500)]
    _, got = ingested(spark, [rows[:1000], rows[1000:]])
    same = [r for r in got if r.group_size == 2001]
    assert len(same) == 2001 and {r.keep_id for r in same} == {5000} and sum(r.kept for r in same) == 1
    assert [(r.keep_id, r.group_size) for r in got if r.doc_id == 9 and r.group_size == 2] == [(9, 2)] * 2
    assert sum(r.kept for r in got if r.doc_id == 9 and r.group_size == 2) == 1


def test_empty_batches_and_other_columns(spark):
    dedup = Dedup(spark, "test")
    none = spark.createDataFrame([], "doc_id long, text string, norm string, class_key int, at string")
    dedup.ingest(none)
    assert dedup.result().count() == 0
    dedup.ingest(spark.createDataFrame([(1, "x", "n", 3, "a")], none.schema))
    dedup.ingest(none)
    assert [tuple(r)[:4] for r in dedup.result().collect()] == [(1, 1, 1, True)]


def test_known_texts_meet_buckets_without_a_shuffle_of_the_snapshot(spark):
    dedup, _ = ingested(spark, [variants(400, 1)])
    table = spark.table(dedup.snapshots[0].table)
    some = spark.createDataFrame([(bytearray(32),)], "class_key binary")
    plan = some.hint("merge").join(table, "class_key")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


@pytest.mark.parametrize("n", [0, 1, 2, 7, 60, 1000, 70_000])
def test_filter_holds_its_keys(n):
    r = np.random.default_rng(n)
    keys, others = r.integers(-(2**63), 2**63 - 1, n), r.integers(-(2**63), 2**63 - 1, 100_000)
    made = fuse_filter.build(np.concatenate([keys, keys[: n // 2]]))
    assert made.has(keys).all() and len(made.has(others[:0])) == 0
    assert made.has(others).mean() < 0.006 and (n < 1000 or len(made.cells) < 1.5 * n)


def test_screen_lets_all_known_and_few_others_pass(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FILTER_KEYS", 500)
    monkeypatch.setattr(exact_dedup, "BLOCK_KEYS", 300)
    ids = lambda a, b: spark.range(a, b).select("id", F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("class_key"), F.col("id").cast("string").alias("norm"))
    old = ids(0, 0).select("class_key")
    made = exact_dedup.commit(ids(0, 4000), old, 4000, 40_000, "screen")
    assert made.shards == 8 and made.filters.count() == 8
    asked = ids(2000, 12_000).withColumn("h", F.xxhash64("class_key"))
    passed = {r.id for r in exact_dedup.screen(asked, 10_000, made).join(asked, "class_key").collect()}
    assert set(range(2000, 4000)) <= passed and len(passed) < 2000 + 120


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_against_sql(spark, sf):
    from tests.llm.sql import same_rows

    same_rows(spark, "op11_exact_dedup", sf)
