"""Sequential segmentation: folds whose next step depends on all before, as plain functions over one row's units.

``size`` counts a text's tokens and is a parameter everywhere. The Arrow
wrappers at the end apply a fold to a column.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import functions as F

Size = Callable[[str], int]
_TOKEN = re.compile(r"\w+|[^\w\s]")


def count_tokens(text: str) -> int:
    return len(_TOKEN.findall(text))


def slide(units: list[str], width: int, overlap: int) -> list[list[str]]:
    """Windows of ``width`` units; the last may be short and none follows it."""
    starts = range(0, max(1, len(units) - overlap), width - overlap) if units else ()
    return [units[s : s + width] for s in starts]


def accumulate(units: list[str], joiner: str = "\n\n", target: int = 600, most: int = 800, overlap: int = 75, size: Size = count_tokens) -> list[str]:
    """Fill up to ``target``; the last unit of a full chunk opens the next where both fit; giants are windowed."""
    out: list[str] = []
    held: list[tuple[str, int]] = []

    def flush() -> None:
        if held:
            out.append(joiner.join(u for u, _ in held))

    for unit in units:
        n = size(unit)
        if n > most:
            flush()
            held = []
            out += [" ".join(w) for w in slide(unit.split(), most, overlap)]
        elif held and sum(k for _, k in held) + n > target:
            flush()
            last = held[-1]
            held = [last, (unit, n)] if last[1] + n <= most else [(unit, n)]
        else:
            held.append((unit, n))
    flush()
    return out


def split_sentences(text: str, opening: str = "A-Z") -> list[str]:
    look = f"(?=[{opening}])" if opening else ""
    return [s for p in re.split(rf"(?<=[.!?])\s+{look}", text) if (s := p.strip())]


def split_body(body: str, most: int = 800, soften: bool = False, size: Size = count_tokens) -> list[str]:
    """T18 (``soften``), T19: whole if it fits, else by paragraphs, else by sentences."""
    if size(body) <= most:
        return [body]
    source = re.sub(r"(?<=[.!?]) *\n(?=[A-Z¶])", "\n\n", body) if soften else body
    units = [p for x in source.split("\n\n") if (p := x.strip())]
    few = 2 if soften else 1
    if len(units) <= few:
        by_sentence = split_sentences(body, "A-Z¶" if soften else "A-Z")
        units = by_sentence if len(by_sentence) > few else units or [body]
    return accumulate(units, most=most, size=size)


#: Headings of an opinion's sections; fixed values.
SECTION_PATTERNS = [
    r"(?im)^\s*(X{0,3}(?:IX|IV|VI{0,3}|V|I{1,3})|X{1,3})\s*[.\-—]\s*(.{0,80})$",
    r"(?im)^\s*(BACKGROUND|FACTS|PROCEDURAL\s+HISTORY|PROCEDURAL\s+BACKGROUND|ANALYSIS|DISCUSSION|HOLDING|DISPOSITION|CONCLUSION|JURISDICTION|STANDARD\s+OF\s+REVIEW|APPLICABLE\s+LAW|RELEVANT\s+STATUTES?|PRELIMINARY\s+MATTERS?|PRIOR\s+PROCEEDINGS?|OPINION)\s*$",
    r"(?m)^\s*([A-Z][A-Z\s]{4,60})\s*$",
    r"(?m)^\s*([A-Z]|\d+)\s*[.\-—]\s*([A-Z][^.\n]{5,60})\s*$",
]


def opinion_sections(text: str) -> list[tuple[str, str]]:
    """(heading, body) pairs; headings within 20 characters of the last are dropped; text before is PREAMBLE."""
    found = sorted((m.start(), m.end(), m.group().strip()) for p in SECTION_PATTERNS for m in re.finditer(p, text))
    heads: list[tuple[int, int, str]] = []
    for hit in found:
        if not heads or hit[0] - heads[-1][0] > 20:
            heads.append(hit)
    if not heads:
        return [("", text)]
    stops = [h[0] for h in heads[1:]] + [len(text)]
    out = [("PREAMBLE", text[: heads[0][0]].strip())]
    out += [(h, text[end:stop].strip()) for (_, end, h), stop in zip(heads, stops, strict=False)]
    return [x for x in out if x[1]] or [("", text)]


def subsections(text: str, marker: str = r"\([a-z]\)") -> list[str]:
    """Cut before markers at line starts, where the line before ends a clause."""
    cuts = []
    for m in re.finditer(rf"(?m)^{marker}", text):
        before = text[: m.start()].rstrip().rsplit("\n", 1)[-1].strip()
        if m.start() and (not before or before[-1] in ".!?:;" or re.search(r" (or|and):?$", before.lower())):
            cuts.append(m.start())
    edges = [0, *cuts, len(text)]
    return [p for a, b in zip(edges, edges[1:], strict=False) if (p := text[a:b].strip())] or [text]


def pack(parts: list[str], limit: int = 1500, joiner: str = "\n") -> list[str]:
    """Join neighbours while they fit."""
    out: list[str] = []
    for p in parts:
        if out and len(out[-1]) + len(joiner) + len(p) <= limit:
            out[-1] += joiner + p
        else:
            out.append(p)
    return out


def hard_split(text: str, limit: int, overlap: int = 0) -> list[str]:
    """Cut at the last blank that fits, else at the limit; always a character on."""
    out, at = [], 0
    while len(text) - at > limit:
        cut = text.rfind(" ", at, at + limit)
        cut = cut if cut > at else at + limit
        out.append(text[at:cut].strip())
        at = max(cut - overlap, at + 1)
    out.append(text[at:].strip())
    return [p for p in out if p]


def pack_sentences(text: str, limit: int = 1500, overlap: int = 200) -> list[str]:
    """Sentences up to ``limit`` characters, whole sentences of at most ``overlap`` carried over (one at least)."""
    out: list[str] = []
    held: list[str] = []
    used = 0
    for s in re.split(r"(?<=[.!?])\s+", text):
        if len(s) > limit:
            if held:
                out.append(" ".join(held))
            pieces = hard_split(s, limit, overlap)
            out += pieces[:-1]
            held, used = pieces[-1:], len(pieces[-1]) if pieces else 0
            continue
        if held and used + len(s) > limit:
            out.append(" ".join(held))
            carry: list[str] = []
            total = 0
            for old in reversed(held):
                if carry and total + len(old) > overlap:
                    break
                carry.insert(0, old)
                total += len(old) + 1
            room = max(0, limit - len(s) - 1)
            if total > room:
                carry, total = ([" ".join(carry)[-room:]] if room else []), room
            held, used = carry, total
        held.append(s)
        used += len(s) + 1
    if held:
        out.append(" ".join(held))
    return out


def merge_small(parts: list[str], words: int = 30, limit: int = 1500, passes: int = 2) -> list[str]:
    """Neighbours of which one is short become one, where they fit."""
    for _ in range(passes):
        out: list[str] = []
        for p in parts:
            if out and min(len(out[-1].split()), len(p.split())) <= words and len(out[-1]) + 1 + len(p) <= limit:
                out[-1] += "\n" + p
            else:
                out.append(p)
        parts = out
    return parts


def merge_micro(sections: list[tuple[str, str]], least: int = 40, most: int = 800, size: Size = count_tokens) -> list[tuple[str, str]]:
    """A tiny body goes into the next section, the last one into the section before, where they fit."""
    todo, out = list(sections), []
    while todo:
        head, body = todo.pop(0)
        if size(body) < least:
            if todo and size(both := f"{body}\n\n{todo[0][1]}".strip()) <= most:
                todo[0] = (todo[0][0], both)
                continue
            if not todo and out and size(both := f"{out[-1][1]}\n\n{body}".strip()) <= most:
                out[-1] = (out[-1][0], both)
                continue
        out.append((head, body))
    return out


def statute_sections(text: str) -> list[tuple[str, str, str]]:
    """(citation, heading, block) for each ``(n ILCS n/...)`` followed within 300 characters by ``Sec. ``."""
    starts = [m for m in re.finditer(r"\((\d+ ILCS \d+/[\w\-.]+)[^)]*\)", text) if re.search(r"\bSec\. ", text[m.end() : m.end() + 300])]
    stops = [m.start() for m in starts[1:]] + [len(text)]
    out = []
    for m, stop in zip(starts, stops, strict=False):
        block = text[m.end() : stop].strip()
        head = re.search(r"(?s)Sec\. [\w\-.]+?\.\s+(.*?)\.", block)
        out.append((m.group(1), " ".join(head.group(1).split()) if head else "", block))
    return out


def code_sections(text: str) -> list[tuple[str, str, str]]:
    """(number, heading, body) for each ``Section n.nn`` line."""
    starts = list(re.finditer(r"(?m)^Section\s+(\d+\.\d+[\w.]*)\s*(.*)$", text))
    stops = [m.start() for m in starts[1:]] + [len(text)]
    return [(m.group(1), m.group(2).strip(), text[m.end() : stop].strip()) for m, stop in zip(starts, stops, strict=False)]


_ARTICLE = re.compile(r"^(?:ARTICLE|Article)\s+([IVX]+)\.\s+(.+)$")
_PART = re.compile(r"^(?:PART|Part)\s+([A-Z])\.\s+(.+)$")
_RULE = re.compile(r"^(?:RULE|Rule)\s+(\d{1,4}[A-Z]?(?:\.[A-Z])?)\b\.?\s+(.+?)(?:\s+\([a-z]\))?$")
_COMMENT = re.compile(r"Committee Comments?\b|Comment\b", re.I)


def rule_records(text: str) -> list[dict]:
    """Headers of articles and parts, rules and committee comments in order, each with the place it stands in.

    Lines are stripped, empty ones and page marks dropped. A rule's text starts
    with its header; lines after an article or part header and before a rule are none's.
    """
    place = {"article_number": None, "article_title": None, "part_letter": None, "part_title": None}
    none = {"rule_number": None, "rule_title": None}
    rule = none
    out: list[dict] = []
    held: list[str] | None = None

    def add(kind: str, rule: dict, line: str) -> list[str]:
        out.append(place | rule | {"content_type": kind, "lines": [line]})
        return out[-1]["lines"]

    for line in map(str.strip, text.split("\n")):
        if not line or re.match(r"^\[\s*PAGE\s+\d+\s*\]$", line):
            continue
        if m := _ARTICLE.match(line):
            place = dict(zip(place, (m[1], m[2].strip(), None, None), strict=True))
            add("article_header", none, line)
            held = None
        elif m := _PART.match(line):
            place = place | {"part_letter": m[1], "part_title": m[2].strip()}
            add("part_header", none, line)
            held = None
        elif m := _RULE.match(line):
            rule = {"rule_number": m[1], "rule_title": m[2].strip()}
            held = add("rule_text", rule, line)
        elif held is not None:
            if _COMMENT.match(line):
                held = add("committee_comment", rule, line)
            else:
                held.append(line)
    for r in out:
        r["text"] = "\n".join(r.pop("lines"))
    return out


def rule_document(text: str) -> list[dict]:
    """One record per rule with the article and part it stands in, its body and its committee comments."""
    out: list[dict] = []
    for r in rule_records(text):
        kind, lines = r.pop("content_type"), r.pop("text")
        if kind == "rule_text":
            out.append(r | {"body": "\n".join(lines.split("\n")[1:]), "comments": ""})
        elif kind == "committee_comment":
            out[-1]["comments"] = "\n".join(x for x in (out[-1]["comments"], lines) if x)
    return out


def rule_split(body: str, least_parts: int = 3, least_chars: int = 1000) -> list[tuple[str, str]]:
    """(letter, text) per lettered subsection of a long rule, its introduction before the first; else the whole.

    Numbered items count towards ``least_parts`` but stay with their letter.
    """
    marks = list(re.finditer(r"(?m)^\(([a-z])\)\s+", body))
    items = re.findall(r"(?m)^\((?:[a-z]|[0-9]+)\)\s+", body)
    if not marks or len(items) < least_parts or len(body) <= least_chars:
        return [("", body)]
    stops = [m.start() for m in marks[1:]] + [len(body)]
    starts = [0] + [m.start() for m in marks[1:]]
    return [(m[1], body[start:stop].strip()) for m, start, stop in zip(marks, starts, stops, strict=False)]


def over_column(fold: Callable[[str], list[str]]):
    """A fold from text to chunks as an Arrow expression ``string -> array<string>``; null gives an empty array."""

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fold(t) if t is not None else [] for t in texts], dtype=object)

    return run


#: Texts whose tuples a worker holds at once.
HELD_TEXTS = 64


def sections_over_column(fold: Callable[[str], list[tuple[str, ...]]], names: tuple[str, ...]):
    """A fold to named tuples as ``string -> array<struct<...>>``."""

    @F.pandas_udf("array<struct<" + ",".join(f"{n}:string" for n in names) + ">>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            for at in range(0, len(texts), HELD_TEXTS):
                some = texts.iloc[at : at + HELD_TEXTS]
                yield pd.Series([[dict(zip(names, x, strict=True)) for x in fold(t)] if t is not None else [] for t in some], dtype=object)

    return run
