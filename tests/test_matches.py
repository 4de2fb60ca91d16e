"""Expressions over matches against plain loops over ``re``."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import matches as M


def many(spark, texts, *columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def noise(seed, n, parts):
    r = random.Random(seed)
    return [None, "", "\n", *("".join(r.choice(parts) for _ in range(r.randrange(1, 25))) for _ in range(n))]


WORDS = ["\n", " ", "\n\n", "word ", "Ünï ", "A. Purpose of it\n", "\nIV. SCOPE / USE\n", "end.\n", "x or\n", " and\n", "or\n", "3.  TITLE [x]\n", "\t", "I.\n", "B. x\n"]


@pytest.mark.parametrize("pattern", [r"[a-z]+", r"\n", r"(?i)x|word", r"Ü.", r"zzz"])
def test_spans(spark, pattern):
    texts = noise(1, 60, WORDS) + ["word " * 1000]
    got = many(spark, texts, M.spans(F.col("text"), pattern).alias("x"))
    assert [g[0] and [tuple(x) for x in g[0]] for g in got] == [t if t is None else [(m.start(), m.end(), m.group()) for m in re.finditer(pattern, t)] for t in texts] or got[1][0] == []
    for t, (g,) in zip(texts, got, strict=True):
        assert g is None if t is None else [tuple(x) for x in g] == [(m.start(), m.end(), m.group()) for m in re.finditer(pattern, t)]


def cut(text, pattern):
    found = list(re.finditer(pattern, text, re.M))
    if not found:
        return [("", text)]
    stops = [m.start() for m in found[1:]] + [len(text)]
    out = [("", text[: found[0].start()].strip())] + [(m.group().strip(), text[m.end() : e].strip()) for m, e in zip(found, stops, strict=True)]
    return [x for x in out if x[1]] or [("", text)]


@pytest.mark.parametrize("pattern", [M.ROMAN, M.LETTER, M.NUMBER])
def test_sections(spark, pattern):
    texts = noise(2, 150, WORDS)
    for t, (g,) in zip(texts, many(spark, texts, M.sections(F.col("text"), pattern).alias("x")), strict=True):
        assert g is None if t is None else [tuple(x) for x in g] == cut(t, pattern.replace("(?md)", ""))


def test_opinion_segments(spark):
    texts = noise(3, 120, ["[Majority]", "\n[Dissent]", "\n[concurrence-in-part]\n", "\n[PER CURIAM] ", "text ", "\n", "[Other]", " [Majority]"])
    marker = re.compile(r"(?mi)^\[(majority|dissent|concurrence-in-part|per curiam)\]")
    for t, (g,) in zip(texts, many(spark, texts, M.opinion_segments(F.col("text")).alias("x")), strict=True):
        if t is None:
            continue
        found = list(marker.finditer(t))
        want = [("preamble", t[: found[0].start()].strip())] if found else []
        for m, stop in zip(found, [m.start() for m in found[1:]] + [len(t)], strict=False):
            want.append(({"concurrence-in-part": "concurrence", "per curiam": "majority"}.get(m[1].lower(), m[1].lower()), t[m.end() : stop].strip()))
        want = [w for w in want if w[1]]
        if want or not found:
            assert [tuple(x) for x in g] == (want or [("majority", t.strip())])


def test_directory_entries(spark):
    texts = noise(4, 80, ["Type of Legal Assistance\n", "Type of Legal Assistance: x\n", "\nType of Legal Assistance \n", "name ", "\n", " "])
    for t, (g,) in zip(texts, many(spark, texts, M.directory_entries(F.col("text")).alias("x")), strict=True):
        if t is not None:
            want = [p.strip() for p in re.split(r"(?m)(?:^|\n)(?=Type of Legal Assistance\s*\n)", t) if p.strip()]
            assert g == (want or [t])


def test_statute_sections(spark):
    far = "x" * 290
    texts = noise(5, 150, ["(720 ILCS 5/1-1)", "( 5  ilcs 70/2 )", "(5 ilcs 70/2a)", " Sec. 1-1. ", "\nSec.  2a. Short\ntitle. ", "Sec. x", far, " text. ", "(Repealed)", "\n"])
    for t, (g,) in zip(texts, many(spark, texts, M.statute_sections(F.col("text")).alias("x")), strict=True):
        if t is None:
            assert g is None
            continue
        found = [m for m in re.finditer(r"(?i)\(\s*(\d+)\s+ILCS\s+([\w/.\-]+)\)", t) if re.search(r"(?i)\bSec\.\s+[\w./\-]+\.", t[m.end() : m.end() + 300])]
        want = []
        for m, stop in zip(found, [m.start() for m in found[1:]] + [len(t)], strict=False):
            block = t[m.start() : stop].strip()
            h = re.search(r"(?is)Sec\.\s+[\w./\-]+\.\s*(.*?)\.", block)
            want.append((f"{m[1]} ILCS {m[2]}", m[2], re.sub(r"\s+", " ", h[1]).strip().rstrip(".") if h else "", block, bool(re.search(r"(?i)\(repealed\)", block))))
        assert [tuple(x) for x in g] == want


def test_code_sections(spark):
    texts = noise(6, 150, ["Section 12.34 ", "x\n  section 120.5.1\n", "\nSection 7 ", "\nSection 15.2", "Title here.\n", "body line ", "\n\n", " "])
    rx = re.compile(r"(?m)^[ \t]*Section\s+(\d{2,4}\.\d+(?:\.\d+)?)(?=\s)(.*?)(?=^[ \t]*Section\s+\d|\Z)", re.S | re.I)
    for t, (g,) in zip(texts, many(spark, texts, M.code_sections(F.col("text")).alias("x")), strict=True):
        if t is None:
            continue
        want = []
        for m in rx.finditer(t):
            lines = [x for x in m[2].strip().splitlines() if x.strip()]
            heading = lines[0].strip().rstrip(".") if lines else ""
            want.append((m[1], heading, f"Section {m[1]}  {heading}\n" + "\n".join(lines[1:]).strip()))
        assert [tuple(x) for x in g] == [(n, h, b.strip()) for n, h, b in want]


def test_subsections(spark):
    texts = noise(7, 200, ["(a) one", "\n(b) two", "\n(c)", ".", ";", " or", " and", " OR", "or", "\n", "\n\n", " ", "x", ":", "\n(1) no", " (d) no"])
    for t, (g,) in zip(texts, many(spark, texts, M.subsections(F.col("text")).alias("x")), strict=True):
        if t is None:
            continue
        cuts = []
        for m in re.finditer(r"\n(?=\([a-z]\))", t):
            last = t[: m.end()].rstrip().split("\n")[-1].strip()
            if not last or last[-1] in ".!?:;" or last.lower().endswith((" or", " and")):
                cuts.append(m.end())
        want = [p for a, b in zip([0, *cuts], [*cuts, len(t)], strict=True) if (p := t[a:b].strip())] if cuts else [t]
        assert g == (want or [t])
