import bz2

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import filters, relational as R, retrieval as V, validate
from corpusloom.functions import text as X
from corpusloom.sources import readers as S, sinks as K
from corpusloom.streaming.incremental import process_new, windowed_counts


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "1", "text": "é"}\n\n{broken\n{"id": "2"}\n', encoding="utf-8")
    schema = S.strings("id", "text")
    assert [(r.id, r.text) for r in S.read_jsonl(spark, str(tmp_path / "a.jsonl"), schema).collect()] == [("1", "é"), ("2", None)]
    with pytest.raises(Exception):
        S.read_jsonl(spark, str(tmp_path / "a.jsonl"), schema, strict=True).collect()
    assert S.read_jsonl(spark, str(tmp_path / "a.jsonl"), schema, keep_bad=True).filter("_bad is not null").count() == 1


def test_csv_keeps_na_and_reads_bz2(spark, tmp_path):
    (tmp_path / "d.csv.bz2").write_bytes(bz2.compress(b'id,text\n1,NA\n2,"a ""q""\nb"\n3,\n'))
    rows = S.read_csv(spark, str(tmp_path / "d.csv.bz2"), S.strings("id", "text")).collect()
    assert [(r.id, r.text or "") for r in rows] == [("1", "NA"), ("2", 'a "q"\nb'), ("3", "")]


def test_pages_manifest_exists(spark, tmp_path):
    df = spark.createDataFrame([("k", 2, "two"), ("k", 1, " one "), ("k", 3, " ")], "key string, page int, text string")
    assert S.join_pages(df, "key", True).first().text == "[PAGE 1]\none\n\n[PAGE 2]\ntwo"
    raw = spark.createDataFrame([('[[["T", "p", "1"], "C", "S"], [["U", "q", "0"], "C", "R"]]',)], "raw string")
    assert [tuple(r) for r in S.manifest(raw).collect()] == [("T", "p", "1", "C", "S"), ("U", "q", "0", "C", "R")]
    assert S.exists(spark, str(tmp_path)) and not S.exists(spark, str(tmp_path / "no"))


def test_sinks(spark, tmp_path):
    a = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z")], "chunk_id string, seq int, text string")
    path = str(tmp_path / "t")
    K.write_upsert(a, path, ["chunk_id"])
    K.write_upsert(spark.createDataFrame([("b", 9, "new"), ("c", 1, "c")], a.schema), path, ["chunk_id"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", 3, "z"), ("b", 9, "new"), ("c", 1, "c")]
    with pytest.raises(ValueError):
        K.write_checked(a, path, {"none": lambda d: d.count() == 0})
    assert spark.read.parquet(path).count() == 3
    K.write_csv(a, str(tmp_path / "c"), ["chunk_id", "text"])
    assert S.read_csv(spark, str(tmp_path / "c"), S.strings("chunk_id", "text")).count() == 3
    K.write_jsonl(a, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 3


def test_incremental(spark, tmp_path):
    rows = lambda n: spark.createDataFrame([(f"k{i}", i) for i in range(n)], "id string, seq int")
    args = (spark, str(tmp_path / "in"), rows(1).schema, lambda d: d, str(tmp_path / "out"), "id", str(tmp_path / "ck"))
    rows(3).write.parquet(str(tmp_path / "in"))
    process_new(*args)
    rows(5).write.mode("append").parquet(str(tmp_path / "in"))
    process_new(*args)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [f"k{i}" for i in range(5)]
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert windowed_counts(events).agg(F.sum("n")).first()[0] == events.count()


def test_small_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(X.safe_int(F.lit("12.9"))) == 12 and one(X.safe_int(F.lit("x"))) == 0 and one(X.safe_float(F.lit("1.5e3"))) == 1500.0
    assert one(X.collapse_wraps(F.lit("Section 1 Title\nstarts here\ngoes on\n\n(a) item\nmore"))) == "Section 1 Title starts here goes on\n\n(a) item more"
    assert one(X.trim_boilerplate(F.lit("junk\nAGENCY: X\nrest"))) == "AGENCY: X\nrest"
    assert one(X.cut_at_first(F.lit("body FOOT x END"), ["END", "FOOT"])) == "body"
    act = lambda *v: one(X.act_name(*[F.lit(x).cast("string") for x in v]))
    cited = "Text. This may be cited as the Best\u00a0 Code. More"
    assert act("720 ILCS 5/ Criminal\u00a0Code  of 2012.", cited, "x") == "Criminal Code of 2012"
    assert act("Act.", cited, "x") == act(None, cited, None) == "Best Code"
    assert act("", "none", "5 ILCS 70/ Fall back.") == "Fall back" and act(None, None, None) == ""
    assert one(X.bm25_tokens(F.lit("Été 5/3-1, x"))) == ["été", "5", "3", "1", "x", "5/3-1"]
    assert one(X.render_citations(F.lit("see Rule 401."))) == 'see <span class="cite">Rule 401</span>.'
    assert one(X.infer_source(F.lit(None).cast("string"), F.lit("4"), F.lit(None))) == "rules"
    assert one(filters.keep_rule_text(F.lit("Rule 5. Reserved."))) is False and one(filters.keep_rule_text(F.lit("means x"))) is True
    files = {"Meeting-Agenda-May.pdf": False, "SPAC_meeting minutes.pdf": False, "AGENDA_FINAL.pdf": False, "minutes-final2.pdf": False, "Minutes-2020.pdf": True, "transcript.pdf": True, "agenda.pdf": True}
    assert {n: one(filters.wanted_file(F.lit(n))) for n in files} == files
    urls = {"/": False, "": False, "//": False, "/locations/x": False, "/our-careers": True, "/x/careers/": False, "/newsroom": False, "/about-us": False, "/contact": False, "/search?q=1": False, "/login": True, "/a/b.pdf": False, "/a/b.PDF": True, "/a.pdf?x": False, "/resources/": True, "?q=/about": False, "/resources?next=/about": True}
    assert {p: one(filters.wanted_url(F.lit(f"https://www.defender.org{p}"), "defender.org")) for p in urls} == urls
    assert not one(filters.wanted_url(F.lit("https://other.org/defender.org"), "defender.org"))
    assert one(filters.not_repealed(F.lit("X (Repealed)"))) is False
    assert one(filters.numeric_id(F.lit("12"))) is True
    assert one(V.target_status(F.lit(0.6), 0.58, 0.73)) == "demo"
    with pytest.raises(Exception):
        one(V.checked_vector(F.array(F.lit(1.0)), 2))


def test_bm25_empty_and_order(spark):
    q = spark.createDataFrame([(1, "murder weapon")], "query_id long, query string")
    docs = spark.createDataFrame([("a", "the murder weapon was found"), ("b", "a day in the park"), ("c", None)], "chunk_id string, text string")
    assert [r.chunk_id for r in V.bm25_top_k(docs, q).collect()] == ["a"]
    assert V.bm25_top_k(docs.limit(0), q).count() == 0


def test_leaks_and_lookup(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "id int, v string")
    assert validate.leaks(df, F.col("v") == "a").count() == 2
    facts = spark.createDataFrame([(2,), (3,)], "id int")
    dim = spark.createDataFrame([(2, "old", 1), (2, "new", 2)], "id int, name string, seq int")
    assert sorted(tuple(r) for r in R.left_lookup(facts, dim, "id", ["name"], "seq").collect()) == [(2, "new"), (3, "")]
    levels = [(spark.createDataFrame([(10, 2), (11, 9)], "d int, id int"), "id", "d"), (spark.createDataFrame([(100, 10), (101, 11)], "e int, d int"), "d", "e")]
    assert [r.e for r in R.semi_cascade(levels, facts).collect()] == [100]
