"""Chunk specs, rule and case-law chunks and near-duplicate removal against plain versions and hand-written results."""

import difflib

from corpusloom.functions import folds
from corpusloom.operators import caselaw, chunkers, near_text
from corpusloom.sources import readers, sinks

WORDS = " ".join(f"w{i}" for i in range(60))


def chunks(spark, spec, text, **more):
    df = spark.createDataFrame([{"id": "d", "text": text, **more}])
    return [r.asDict() for r in chunkers.chunk(df, chunkers.SPECS[spec]).orderBy("chunk_index").collect()]


def test_policy_report(spark):
    text = f"A REPORT ON SENTENCES\n{WORDS}\ntiny dots ........ 4\nTHE NEXT LONG PART\nshort\nTHE LAST LONG PART\n{WORDS} end"
    got = chunks(spark, "policy_reports", text, title="T", url="u", category="c", year="1999")
    assert [(r["chunk_id"], r["chunk_total"], r["token_count"], r["display_citation"]) for r in got] == [("spac_d_0000", 2, 60, "T"), ("spac_d_0001", 2, 62, "T")]
    assert [r["text"] for r in got] == [WORDS, f"short\n\n{WORDS} end"]
    assert got[0]["enriched_text"] == f"T\nA REPORT ON SENTENCES\n\n{WORDS}"


def test_statutes(spark):
    text = f"Sec. 1. (a) in line.\n(a) {WORDS};\n(b) {'long ' * 400}end."
    got = chunks(spark, "statutes", text, section_citation="720 ILCS 5/1")
    assert got[0]["text"] == f"Sec. 1. (a) in line.\n(a) {WORDS};" and all(len(r["text"]) <= 1500 for r in got)
    assert "".join(r["text"] for r in got).count("long") >= 400 and {r["token_count"] for r in got} == {folds.count_tokens(r["text"]) for r in got}


def test_opinions(spark):
    got = chunks(spark, "bulk_opinions", f"[Majority]\nBACKGROUND\n{WORDS}\nANALYSIS\nshort\n[Dissent]\n{WORDS} no", case_name_abbr="P v. Q", date_decided="1999", court="ill")
    assert [(r["text"], r["metadata"]["section_heading_text"]) for r in got] == [(WORDS, "BACKGROUND"), (f"{WORDS} no", "dissent")]
    assert got[0]["enriched_text"].startswith("P v. Q | 1999 | ill\nBACKGROUND\n\nw0 ")
    assert chunks(spark, "bulk_opinions", "") == []


def test_drop_near_against_plain(spark):
    texts = ["alpha " * 100, "alpha " * 99 + "omega ", "beta " * 80, None, "", "alpha " * 100 + "tail that is beyond the cut", "beta " * 79 + "gamma"]
    rows = [(q, i, (i * (q + 2)) % 7, t) for q in (0, 1) for i, t in enumerate(texts)]
    want = set()
    for q in (0, 1):
        kept = []
        for _, i, _, t in sorted((r for r in rows if r[0] == q), key=lambda r: r[2]):
            head = (t or "")[:500]
            if all(difflib.SequenceMatcher(None, head, k).ratio() < 0.95 for k in kept):
                kept.append(head)
                want.add((q, i))
    df = spark.createDataFrame(rows, "query_id long, chunk_id long, rank0 int, text string")
    assert {(r.query_id, r.chunk_id) for r in near_text.drop_near(df).collect()} == want


def test_rule_chunks(spark):
    text = "Article IV. Discovery\nstray\nRule 401. Depositions\nbody one\nComment\nsaid so\nRule 402. Reserved.\nRule 403. Last\nshall"
    got = caselaw.rule_chunks(spark.createDataFrame([(1, text), (2, None), (3, "")], "id long, text string")).orderBy("chunk_id").collect()
    assert [(r.metadata.content_type, r.text, r.display_citation) for r in got] == [
        ("article_header", "Article IV. Discovery", "Article IV"), ("rule_text", "Rule 401. Depositions\nbody one", "Rule 401 — Depositions"),
        ("committee_comment", "Comment\nsaid so", "Rule 401 — Depositions"), ("rule_text", "Rule 403. Last\nshall", "Rule 403 — Last"),
    ]


def case_tables(spark):
    blank = {c: "" for c in (*caselaw.CLUSTER, *caselaw.DOCKET)}
    clusters = [{k: v for k, v in (blank | {"cluster_id": "9", "docket_id": "5", "case_name": "A v. B", "case_name_short": "A", "date_filed": "2001-02-03", "precedential_status": "Unpublished", "citation_count": "x"}).items() if k in (*caselaw.CLUSTER, "cluster_id")}]
    dockets = [{k: v for k, v in (blank | {"docket_id": "5", "court_id": "ill"}).items() if k in (*caselaw.DOCKET, "docket_id")}]
    return spark.createDataFrame(clusters), spark.createDataFrame(dockets)


def test_parentheticals(spark):
    rows = [("1", "holding so", "7", "8", "0.5"), ("2", " ", "7", "8", "1"), ("3", None, "7", "8", "1"), ("4", "lone", None, None, "bad")]
    p = spark.createDataFrame(rows, "id string, text string, describing_opinion_id string, described_opinion_id string, score string")
    opinions = spark.createDataFrame([("7", "9")], "id string, cluster_id string")
    got = {r.chunk_id: r for r in caselaw.parenthetical_chunks(p, opinions, *case_tables(spark)).collect()}
    assert set(got) == {"par_1", "par_4"}
    a, b = got["par_1"], got["par_4"]
    assert a.enriched_text == "A v. B | 2001-02-03 | Illinois Supreme Court [parenthetical]\n\nholding so" and a.display_citation == "A v. B (2001) — parenthetical"
    assert (a.metadata.score, a.metadata.precedential_weight, a.parent_id) == (0.5, 0.5, "7")
    assert (b.display_citation, b.metadata.score, b.metadata.precedential_weight, b.enriched_text) == ("parenthetical", 0.0, 0.3, "[parenthetical]\n\nlone")


def test_caselaw_opinions(spark):
    rows = [("7", "9", "020lead", f"BACKGROUND\n{WORDS}\nCONCLUSION\nshort", None, "J", "true"), ("8", "0", "zzz", None, f"<p>{WORDS}</p>", "", ""), ("6", "9", "x", None, None, "", "")]
    o = spark.createDataFrame(rows, "id string, cluster_id string, type string, plain_text string, html_with_citations string, author_str string, per_curiam string")
    got = {r.chunk_id: r for r in caselaw.opinion_chunks(o, *case_tables(spark)).collect()}
    assert set(got) == {"7_c0", "8_c0"}
    a, b = got["7_c0"], got["8_c0"]
    assert (a.text, a.chunk_total, a.token_count, a.display_citation, a.metadata.is_majority, a.metadata.section_index, a.metadata.citation_count) == (WORDS, 1, 60, "A (2001)", True, 0, 0)
    assert a.enriched_text == f"A | 2001-02-03 | Illinois Supreme Court\nBACKGROUND\n\n{WORDS}"
    assert (b.text, b.display_citation, b.metadata.opinion_type, b.metadata.chunk_type) == (WORDS, "", "zzz", "opinion_paragraph")


def test_crawl(spark):
    graph = {"a": ["/b", "/c"], "b": ["/a", "/d"], "c": ["/skip"], "d": ["/e"], "e": [], "skip": ["/f"], "f": []}
    site = spark.createDataFrame([(f"https://s/{k}", "".join(f'<a href="{x}">' for x in v)) for k, v in graph.items()], "link string, html string")
    seeds = spark.createDataFrame([("https://s/a",), (None,)], "link string")
    run = lambda **kw: {r.link[-1]: r.depth for r in readers.crawl(lambda level: level.join(site, "link"), seeds, "https://s/", ~readers.F.col("link").endswith("skip"), **kw).collect()}
    assert run() == {"a": 0, "b": 1, "c": 1, "d": 2, "e": 3}
    assert run(max_rounds=2) == {"a": 0, "b": 1, "c": 1} and run(max_pages=2) == {"a": 0, "b": 1}


def test_put_in_place_and_recover(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *v: spark.createDataFrame([(k, s, 0) for k, s in v], "k int, seq int, x int")
    sinks.write_upsert(rows((1, 1), (2, 1)), path, ["k"])
    sinks.write_upsert(rows((2, 5), (3, 5)), path, ["k"])
    seen = lambda: sorted((r.k, r.seq) for r in spark.read.parquet(path).collect())
    assert seen() == [(1, 1), (2, 5), (3, 5)] and sorted(p.name for p in tmp_path.iterdir()) == ["t"]
    (tmp_path / "t").rename(tmp_path / "t.old")  # a run lost between the two renames
    sinks.recover(spark, path)
    assert seen() == [(1, 1), (2, 5), (3, 5)]
