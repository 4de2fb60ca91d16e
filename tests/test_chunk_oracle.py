"""The chunk queries against a plain version that shares no code with them, over the whole of the smallest tables.

The plain version goes through a text by lines and characters; only the fixed
patterns of section headings are read from the library.
"""

import hashlib
import os
import re

import pytest

from corpusloom.functions.folds import SECTION_PATTERNS
from corpusloom.operators.filters import NOISE
from corpusloom.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def tokens(text):
    n, inside = 0, False
    for c in text:
        word = c.isalnum() or c == "_" or bool(re.match(r"\w", c))
        n += (word and not inside) or not (word or c.isspace())
        inside = word
    return n


def sentences(text, openings=None):
    """Cut at white space after ``.!?``, before one of ``openings`` where given."""
    out, start, i = [], 0, 1
    while i < len(text):
        if text[i].isspace() and text[i - 1] in ".!?":
            j = i
            while j < len(text) and text[j].isspace():
                j += 1
            if openings is None or j < len(text) and text[j] in openings:
                out.append(text[start:i])
                start = i = j
        i += 1
    return out + [text[start:]]


CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fill(units, target=600, most=800, overlap=75):
    """Chunks as lists of places in ``units``; a unit over ``most`` stands as its windows of words."""
    sizes = [tokens(u) for u in units]
    chunks, now = [], []
    for i, n in enumerate(sizes):
        if n > most:
            chunks += [now] if now else []
            now, words, at = [], units[i].split(), 0
            while True:
                chunks.append(" ".join(words[at : at + most]))
                at += most - overlap
                if at + overlap >= len(words):
                    break
        elif now and sum(sizes[k] for k in now) + n > target:
            chunks.append(now)
            now = [now[-1], i] if sizes[now[-1]] + n <= most else [i]
        else:
            now = now + [i]
    chunks += [now] if now else []
    return [c if isinstance(c, str) else "\n\n".join(units[k] for k in c) for c in chunks]


def body_parts(body, opinion):
    if tokens(body) <= 800:
        return [body]
    source, openings = body, CAPITALS
    if opinion:
        openings += "¶"
        lines, joined = body.split("\n"), ""  # a line that ends a sentence before one that opens one ends a paragraph
        for k, line in enumerate(lines):
            last = k == len(lines) - 1
            ends = line.rstrip(" ")[-1:] in (".", "!", "?") if line.rstrip(" ") else False
            opens = not last and lines[k + 1][:1] in list(openings)
            joined += line if last else (line.rstrip(" ") + "\n\n" if ends and opens else line + "\n")
        source = joined
    units = [p.strip() for p in source.split("\n\n") if p.strip()]
    least = 3 if opinion else 2
    if len(units) < least:
        cut = [s.strip() for s in sentences(body, openings) if s.strip()]
        units = cut if len(cut) >= least else units or [body]
    return fill(units)


def rows_of(source, doc, pieces, least, header, cited=None):
    kept = [(h, p, n) for h, p in pieces if (n := tokens(p)) >= least]
    out = {}
    for i, (heading, body, n) in enumerate(kept):
        top = "\n".join(x for x in (header, heading) if x)
        digest = hashlib.sha256(((top + "\n\n" if top else "") + body).encode()).hexdigest()
        out[f"{source}_{doc}_{i:04d}"] = (str(doc), i, len(kept), n, *([] if cited is None else [cited]), digest)
    return out


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def check(spark, name, want, cited=True):
    got = {r.chunk_id: (r.parent_id, r.chunk_index, r.chunk_total, r.token_count, *([r.display_citation] if cited else []), r.digest) for r in registry.QUERIES[name](spark, SF).collect()}
    assert len(want) > 100 and set(got) == set(want)
    assert [k for k in want if got[k] != want[k]] == []


def report_lines(text):
    """Neither page numbers nor lines of a table of contents."""
    kept = [x for x in text.split("\n") if not re.search(r"\bpage [0-9]+ of [0-9]+\b", x, re.I | re.A)]
    for line in "\n".join(kept).strip().split("\n"):
        dots = line.count(".") > 0.2 * len(line) or line.rstrip()[-1:].isdigit() or line.rstrip().endswith("....")
        if not ("...." in line and dots):
            yield line


def report_pieces(text):
    sections = [["", []]]
    for line in report_lines(text):
        t = line.strip()
        if 4 <= len(t) <= 60 and t[0] in CAPITALS and set(t) <= set(CAPITALS + "0123456789()-/, \t") and len(t.split()) >= 3:
            sections.append([t, []])
        else:
            sections[-1][1].append(line)
    parts = [(h, p) for h, lines in sections if h or "\n".join(lines).strip() for p in body_parts("\n".join(lines).strip(), False)] or [("", text)]
    out, i = [], 0
    while i < len(parts):
        h, p = parts[i]
        i += 1
        if tokens(p) < 40 and i < len(parts) and tokens(joined := (p + "\n\n" + parts[i][1]).strip()) <= 800:
            parts[i] = (parts[i][0], joined)
        elif tokens(p) < 40 and i == len(parts) and out and tokens(joined := (out[-1][1] + "\n\n" + p).strip()) <= 800:
            out[-1] = (out[-1][0], joined)
        else:
            out.append((h, p))
    return out


def test_policy_reports(spark):
    want = {}
    for d in documents(spark):
        want |= rows_of("spac", d.doc_id, report_pieces(d.text or ""), 40, d.source or "", d.source or "")
    check(spark, "chunk_policy_reports", want)


def clause_cuts(text):
    """Pieces that open with ``(a)`` at a line's start, after a line that ends a clause."""
    lines, groups = text.split("\n"), [[]]
    for k, line in enumerate(lines):
        if k and re.match(r"\([a-z]\)", line):
            before = [x for x in "\n".join(lines[:k]).rstrip().split("\n")][-1].strip()
            if not before or before[-1] in ".!?:;" or before.lower().removesuffix(":").endswith((" or", " and")):
                groups.append([])
        groups[-1].append(line)
    return [p for g in groups if (p := "\n".join(g).strip())] or [text]


def by_blanks(text, limit=1500, overlap=200):
    out, at = [], 0
    while at + limit < len(text):
        cut = max((k for k in range(at + 1, at + limit) if text[k] == " "), default=at + limit)
        out.append(text[at:cut].strip())
        at = max(at + 1, cut - overlap)
    return [p for p in [*out, text[at:].strip()] if p]


def by_sentences(text, limit=1500, overlap=200):
    out, now = [], []
    for s in sentences(text):
        if len(s) > limit:
            out += [" ".join(now)] if now else []
            cut = by_blanks(s)
            out, now = out + cut[:-1], cut[-1:]
        elif now and len(" ".join(now)) + 1 + len(s) > limit:
            out.append(" ".join(now))
            carry = now[-1:]
            while len(carry) < len(now) and len(" ".join(now[-len(carry) - 1 :])) <= overlap:
                carry = now[-len(carry) - 1 :]
            room = limit - len(s) - 1
            if len(" ".join(carry)) > room:
                carry = [" ".join(carry)[-room:]] if room > 0 else []
            now = carry + [s]
        else:
            now = now + [s]
    return out + ([" ".join(now)] if now else [])


def statute_pieces(text):
    text = re.sub(r"\n\n\n+", "\n\n", re.sub(r"[ \t]+", " ", text.replace("\r\n", "\n").replace("\r", "\n"))).strip()
    packed = []
    for p in clause_cuts(text):
        if packed and len(packed[-1] + "\n" + p) <= 1500:
            packed[-1] += "\n" + p
        else:
            packed.append(p)
    parts = [x for p in packed for x in (by_sentences(p) if len(p) > 1500 else [p])]
    for _ in range(2):
        merged = parts[:1]
        for p in parts[1:]:
            few = len(merged[-1].split()) <= 30 or len(p.split()) <= 30
            if few and len(merged[-1] + "\n" + p) <= 1500:
                merged[-1] += "\n" + p
            else:
                merged.append(p)
        parts = merged
    return [("", p) for p in parts]


def test_statutes(spark):
    want = {}
    for d in documents(spark):
        header = " | ".join(x for x in (d.lang, d.source, "Heading") if x)
        want |= rows_of("ilcs", d.doc_id, statute_pieces(d.text or ""), 20, header, f"720 ILCS 5/{d.doc_id}")
    check(spark, "chunk_statutes", want)


def headed(text):
    """Sections at headings more than 20 characters apart; what stands before the first is the preamble."""
    hits = sorted({(m.start(), m.end()) for p in SECTION_PATTERNS for m in re.finditer(p, text)})
    kept = []
    for a, b in hits:
        if not kept or a > kept[-1][0] + 20:
            kept.append((a, b))
    if not kept:
        return [("", text)]
    ends = [a for a, _ in kept[1:]] + [len(text)]
    found = [("PREAMBLE", text[: kept[0][0]])] + [(text[a:b].strip(), text[b:e]) for (a, b), e in zip(kept, ends, strict=True)]
    return [(h, b.strip()) for h, b in found if b.strip()] or [("", text)]


def test_opinions(spark):
    want = {}
    for d in documents(spark):
        pieces = []
        if d.text is not None:
            for kind, segment in (("majority", f"BACKGROUND\n{d.text}"), ("dissent", f"ANALYSIS\n{d.text}")):
                pieces += [(h or kind, p) for h, b in headed(segment.strip()) for p in body_parts(b, True)]
        header = " | ".join(x for x in ("People v. " + d.source if d.source is not None else "", "1999-01-02", "ill") if x)
        want |= rows_of("cap_bulk", d.doc_id, pieces, 50, header)
    check(spark, "chunk_opinions", want, cited=False)


def page_text(text):
    """Of ``<p>text</p>``, for texts that hold neither tags nor entities: blanks collapse, several line ends become two."""
    assert not re.search(r"<[A-Za-z/!?]|&#?\w+;", text)
    out = ""
    for run in re.split(r"(\s+)", text.replace("\u00a0", " ")):
        out += run if not run.isspace() else "\n\n" if run.count("\n") > 1 else re.sub(r"[ \t]+", " ", run)
    return out.strip()


def test_caselaw_opinions(spark):
    customers = {r.c_custkey: r for r in spark.read.parquet(f"{SF}/customer.parquet").collect()}
    want = {}
    for d in documents(spark):
        plain = f"BACKGROUND\n{d.text}\nANALYSIS\n{d.text}" if d.doc_id % 3 and d.text is not None else ""
        text = plain if plain.strip() else page_text(d.text) if d.text is not None else ""
        if not text.strip(" "):
            continue
        pieces = [(i, h, p, tokens(p)) for i, (h, body) in enumerate(headed(text)) for p in body_parts(body, True)]
        pieces = [x for x in pieces if x[3] >= 50 and not (x[3] <= 150 and sum(bool(re.search(m, x[2], re.A)) for m in NOISE) >= (1 if x[3] < 60 else 2))]
        case = customers.get(d.doc_id * 2)
        name, court, date = "", "", ""
        if case:
            name = f"s {case.c_name}"
            date = "" if case.c_custkey % 4 == 0 else f"19{case.c_custkey % 100:02d}-01-02"
            court = ["Illinois Supreme Court", "Illinois Appellate Court", "ca7"][case.c_nationkey % 3]
        header = " | ".join(x for x in (name, date, court) if x)
        shown = f"{name} ({date[:4]})" if name and date else name
        kind = ["combined", "dissent", "other"][d.doc_id % 3]
        for k, (i, h, p, n) in enumerate(pieces):
            top = "\n".join(x for x in (header, h) if x)
            digest = hashlib.sha256(((top + "\n\n" if top else "") + p).encode()).hexdigest()
            want[f"{d.doc_id}_c{k}"] = (str(d.doc_id), k, len(pieces), n, shown, kind, kind == "combined", i, court, digest)
    got = {r.chunk_id: (r.parent_id, r.chunk_index, r.chunk_total, r.token_count, r.display_citation, r.opinion_type, r.is_majority, r.section_index, r.court_label, r.digest) for r in registry.QUERIES["caselaw_opinions"](spark, SF).collect()}
    assert len(want) > 100 and set(got) == set(want)
    assert [(got[k], want[k]) for k in want if got[k] != want[k]] == []
