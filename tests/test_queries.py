"""Every core query against its SQL equivalent on the smallest tables."""

import math
import os

import duckdb
import pytest

from corpusloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19]
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, db, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(norm(r[c]) for c in cols)) for r in df.collect())
    if name not in registry.ORACLE_SQL:
        assert got
        return
    cur = db.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert got == sorted(repr(tuple(norm(r[names.index(c)]) for c in cols)) for r in cur.fetchall())
