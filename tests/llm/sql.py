"""A query of the subpackage against its SQL on given tables."""

import math

import duckdb

from corpusloom.llm import registry

TABLES = "documents embeddings pages benchmark labels conversations".split()


def same_rows(spark, name, sf="sf0.001"):
    folder = f"/root/testdata/{sf}"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    df = registry.QUERIES[name](spark, folder)
    got = sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())
    cur = con.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr(tuple(None if isinstance(v := r[names.index(c)], float) and math.isnan(v) else v for c in sorted(names))) for r in cur.fetchall())
    assert got == want and got
