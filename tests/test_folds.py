from corpusloom.functions import folds as F
from corpusloom.operators.chunkers import caps_sections, opinion_segments


def size(t):
    return len(t.split())


def test_slide():
    u = [str(i) for i in range(10)]
    assert F.slide(u, 4, 1) == [u[0:4], u[3:7], u[6:10]]
    assert F.slide(u, 10, 3) == [u] and F.slide([], 4, 1) == []


def test_accumulate_carries_last_unit_and_windows_giants():
    units = ["a " * 3, "b " * 3, "c " * 3]
    out = F.accumulate([u.strip() for u in units], " | ", target=6, most=8, overlap=2, size=size)
    assert out == ["a a a | b b b", "b b b | c c c"]
    out = F.accumulate(["x " * 20], " | ", target=6, most=8, overlap=2, size=size)
    assert [len(o.split()) for o in out] == [8, 8, 8]


def test_split_body():
    assert F.split_body("short") == ["short"]
    long = "One two. " * 500
    assert all(F.count_tokens(p) <= 801 for p in F.split_body(long)) and len(F.split_body(long)) > 1


def test_subsections_need_a_clause_end():
    assert F.subsections("Intro:\n(a) one;\n(b) two\n(c) not a new one") == ["Intro:", "(a) one;", "(b) two\n(c) not a new one"]
    assert F.subsections("plain") == ["plain"]


def test_hard_split_makes_progress():
    parts = F.hard_split("x" * 50, 20, 5)
    assert "".join(parts).count("x") >= 50 and all(len(p) <= 20 for p in parts)
    assert F.hard_split("aa bb cc dd", 5) == ["aa", "bb", "cc", "dd"]


def test_pack_sentences_limit_and_overlap():
    text = " ".join(f"Sentence number {i} is here." for i in range(200))
    out = F.pack_sentences(text, 300, 60)
    assert all(len(c) <= 300 for c in out) and out[0].split(". ")[-1].rstrip(".") in out[1]


def test_merges():
    assert F.merge_small(["a", "b", "w " * 40]) == ["a\nb\n" + "w " * 40]
    assert F.merge_micro([("H1", "tiny"), ("H2", "long " * 50), ("H3", "end")], size=size) == [("H2", "tiny\n\n" + ("long " * 50).strip() + "\n\nend")]


def test_opinions():
    text = "[Majority]\nFirst.\n[Dissent]\nI dissent.\n[Concurrence-In-Part]\nPartly."
    assert opinion_segments(text) == [("majority", "First."), ("dissent", "I dissent."), ("concurrence", "Partly.")]
    assert opinion_segments("plain") == [("majority", "plain")]
    assert F.opinion_sections("before\n   ANALYSIS\nbody of some length\nCONCLUSION\nend") == [("PREAMBLE", "before"), ("ANALYSIS", "body of some length"), ("CONCLUSION", "end")]


def test_caps_sections():
    assert caps_sections("intro\nTHE BIG HEADING\nbody") == [("", "intro"), ("THE BIG HEADING", "body")]


def test_statutes_and_code():
    text = "(720 ILCS 5/1-1) (from Ch. 38) Sec. 1-1. Short title. This Act. (720 ILCS 5/1-2) Sec. 1-2. Purposes. More."
    assert [(c, h) for c, h, _ in F.statute_sections(text)] == [("720 ILCS 5/1-1", "Short title"), ("720 ILCS 5/1-2", "Purposes")]
    assert F.code_sections("Section 1.10 Scope\nbody\nSection 1.20 Terms\nmore") == [("1.10", "Scope", "body"), ("1.20", "Terms", "more")]


def test_rule_document_labels_and_comments():
    text = "Article IV. Discovery\nPart A. Scope\nRule 401. Depositions\n[PAGE 3]\nbody one\nCommittee Comments\nsaid so\nRule 402. Pleas\nbody two\nPart B. Other\nRule 403. Last\nbody three"
    got = F.rule_document(text)
    assert [(r["rule_number"], r["part_letter"], r["body"], r["comments"]) for r in got] == [("401", "A", "body one", "Committee Comments\nsaid so"), ("402", "A", "body two", ""), ("403", "B", "body three", "")]
    long = "Intro.\n" + "".join(f"({c}) {'word ' * 100}\n" for c in "abc")
    assert [(x, t.startswith("Intro.")) for x, t in F.rule_split(long)] == [("a", True), ("b", False), ("c", False)]  # the introduction stands once
    assert [r["content_type"] for r in F.rule_records(text)] == ["article_header", "part_header", "rule_text", "committee_comment", "rule_text", "part_header", "rule_text"]
    assert F.rule_split("short") == [("", "short")]
