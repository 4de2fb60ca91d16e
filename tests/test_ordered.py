import json
import random

import pytest

from corpusloom.operators.relational import first_by, last_wins
from corpusloom.session import setting
from corpusloom.sources.ordered import read_ordered


@pytest.fixture
def files(tmp_path):
    r = random.Random(8)
    want = []
    for name in ("b.jsonl", "a.jsonl", "c.jsonl"):
        rows = [{"k": r.randrange(40), "v": f"{name} {i} " + "x" * r.randrange(60)} for i in range(r.choice([0, 90, 400]) if name != "b.jsonl" else 300)]
        (tmp_path / name).write_text("".join(json.dumps(x) + "\n" for x in rows))
        want += [(name, i, x["k"], x["v"]) for i, x in enumerate(rows)]
    want.sort(key=lambda w: w[:2])
    return tmp_path, [(n, i, seq, k, v) for seq, (n, i, k, v) in enumerate(want)]


@pytest.mark.parametrize("split", ["300", "4000", "128m"])
def test_places_in_files(spark, files, split):
    """Files of one split and of many, several small ones in a task."""
    path, want = files
    with setting(spark, "spark.sql.files.maxPartitionBytes", split), setting(spark, "spark.sql.files.openCostInBytes", "0"):
        df = read_ordered(spark, f"file://{path}", schema="k long, v string")
        got = sorted((r.file.split("/")[-1], r.row, r.seq, r.k, r.v) for r in df.collect())
        assert got == want
        first = {r.k: r.v for r in first_by(df, ["k"], df.seq.asc()).collect()}
        last = {r.k: r.v for r in last_wins(df, ["k"]).collect()}
    assert last == {k: v for *_, k, v in want}
    assert first == {k: v for *_, k, v in reversed(want)}


def test_parquet_and_clashing_names(spark, tmp_path):
    spark.range(5000).selectExpr("id", "id as file_", "cast(id as string) as at_").repartitionByRange(3, "id").sortWithinPartitions("id").write.parquet(f"{tmp_path}/p")
    with setting(spark, "spark.sql.files.maxPartitionBytes", "5000"):
        got = read_ordered(spark, f"{tmp_path}/p", "parquet").collect()
    assert len(got) == 5000 and all(r.seq == r.id == r.file_ and r.at_ == str(r.id) for r in got)


def test_nothing(spark, tmp_path):
    (tmp_path / "none.jsonl").write_text("")
    assert read_ordered(spark, f"{tmp_path}", schema="k long").count() == 0
