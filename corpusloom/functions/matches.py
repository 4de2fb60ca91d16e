"""Regex matches with their places, and texts cut at them, as column expressions that stay in the JVM.

The pieces a text is split into and the matches alternate, so lengths that add
up give every place. Patterns must not match an empty string, but for those of
``cut_before``, which match nothing else. Places count characters from 0.
Null texts give null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from corpusloom.functions.text import clean_heading, strip_all

#: Lengths summed in one run: arrays that grow by one element stay short.
RUN = 128
SECTION = "struct<heading:string,body:string>"


def made_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is worked out once for a row: a column within a lambda is worked out anew for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sums_before(lengths: Column) -> Column:
    """For each element of an array of ints the sum of those before it."""
    none = F.array().cast("array<int>")

    def step(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out"))

    def moved(within: Column) -> Column:
        starts = F.aggregate(within, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda acc, r: step(acc, r["at"]))["out"]
        return F.flatten(F.zip_with(within, starts, lambda r, start: F.transform(r["out"], lambda x: x + start)))

    def summed(n: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(n) - 1) / RUN).cast("int")), lambda k: F.slice(n, k * RUN + 1, RUN))
        within = F.transform(runs, lambda run: F.aggregate(run, F.struct(F.lit(0).alias("at"), none.alias("out")), step))
        return F.when(F.size(n) > 0, made_once(within, moved)).otherwise(none)

    return made_once(lengths, summed)


def spans(text: Column, pattern: str) -> Column:
    """``array<struct<start, end, hit>>`` of every match, left to right."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))

    def placed(hits: Column) -> Column:
        both = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda gap, hit: gap + F.length(hit))
        ends = made_once(both, lambda n: F.zip_with(sums_before(n), n, lambda before, own: before + own))
        return F.zip_with(ends, hits, lambda end, hit: F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit")))

    return made_once(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def blocks(text: Column, openers: Column) -> Column:
    """The text from the start of each of the spans ``openers`` to the next one's, the last to the end."""

    def cut(found: Column) -> Column:
        stop = lambda i: F.coalesce(F.get(found, i + 1)["start"], F.length(text))
        return F.transform(found, lambda x, i: F.substr(text, x["start"] + 1, stop(i) - x["start"]))

    return made_once(openers, cut)


def sections(text: Column, pattern: str) -> Column:
    """``array<struct<heading, body>>`` at each match, the text before under no heading; parts without a body are left out."""
    hits, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    part = lambda heading, body: F.struct(strip_all(heading).alias("heading"), strip_all(body).alias("body"))
    heads = F.concat(F.array(F.lit("")), hits)
    found = F.filter(F.zip_with(heads, pieces, part), lambda x: x["body"] != "")
    whole = F.array(F.struct(F.lit("").alias("heading"), text.alias("body")))
    return F.when(F.size(hits) == 0, whole).when(F.size(found) == 0, whole).otherwise(found)


#: Headings by Roman number, by letter and by number.
ROMAN = r"(?md)^((?:X{0,3})(?:IX|IV|V?I{0,3}))\.\s+([A-Z][A-Z\s/\-]{1,60})\s*$"
LETTER = r"(?md)^([A-Z])\.\s+([A-Z][A-Za-z\s/\-]{2,60})\s*$"
NUMBER = r"(?md)^(\d+)\.\s{2,}([A-Z][A-Z0-9\s/\-\[\]§\.]{1,80}?)\s*$"

#: Opinion markers and the types they stand for.
OPINION_TYPES = {
    "majority": "majority", "dissent": "dissent", "concurrence": "concurrence", "concur": "concurrence", "concurrence-in-part": "concurrence",
    "rehearing": "rehearing", "per curiam": "majority", "opinion": "majority", "unanimous": "majority", "plurality": "majority",
    "combined": "majority", "addendum": "addendum", "remittitur": "remittitur",
}
MARKER = r"(?mid)^\[(" + "|".join(sorted(OPINION_TYPES, key=len, reverse=True)) + r")\]"


def opinion_segments(text: Column) -> Column:
    """(type, body) at each ``[Marker]`` line, the text before as a preamble; without markers all of it is the majority's."""
    types = F.create_map(*[F.lit(x) for pair in OPINION_TYPES.items() for x in pair])
    named = lambda head: F.when(head == "", "preamble").otherwise(types[F.lower(F.translate(head, "[]", ""))])
    found = F.transform(sections(text, MARKER), lambda x: F.struct(named(x["heading"]).alias("heading"), x["body"].alias("body")))
    whole = F.array(F.struct(F.lit("majority").alias("heading"), strip_all(text).alias("body")))
    marked = F.exists(found, lambda x: x["heading"] != "preamble") | text.rlike(MARKER)
    return F.when(marked, found).otherwise(whole)


def cut_before(text: Column, pattern: str) -> Column:
    """The text cut before each place where ``pattern`` begins, parts trimmed, empty ones left out."""
    return F.filter(F.transform(F.split(text, f"(?={pattern})", -1), strip_all), lambda x: x != "")


def directory_entries(text: Column) -> Column:
    """Entries that begin with a ``Type of Legal Assistance`` line; a text without any text is one."""
    found = cut_before(text, r"(?md:^Type of Legal Assistance\s*\n)")
    return F.when(F.size(found) == 0, F.array(text)).otherwise(found)


#: A citation that may open a section, the section mark that must follow, and the heading after it.
CITATION = r"(?i)\(\s*(\d+)\s+ILCS\s+([\w/.\-]+)\)"
SECTION_MARK = r"(?i)\bSec\.\s+[\w./\-]+\."
HEADING = r"(?is)Sec\.\s+[\w./\-]+\.\s*(.*?)\."
#: Characters after a citation in which the mark must stand.
NEAR = 300


def statute_sections(text: Column) -> Column:
    """``array<struct<citation, section_num, heading, body, repealed>>``: from each citation that a section mark follows to the next such."""
    openers = F.filter(spans(text, CITATION), lambda x: F.substr(text, x["end"] + 1, F.lit(NEAR)).rlike(SECTION_MARK))

    def record(opener: Column, block: Column) -> Column:
        group = lambda k: F.regexp_extract(opener["hit"], CITATION, k)
        heading = F.rtrim(clean_heading(F.regexp_extract(block, HEADING, 1)), F.lit("."))
        return F.struct(F.concat(group(1), F.lit(" ILCS "), group(2)).alias("citation"), group(2).alias("section_num"), heading.alias("heading"), strip_all(block).alias("body"), block.rlike(r"(?i)\(Repealed\)").alias("repealed"))

    return made_once(openers, lambda found: F.zip_with(found, blocks(text, found), record))


#: A section's head, and what ends the section before it.
CODE_HEAD = r"(?i)^[ \t]*Section\s+(\d{2,4}\.\d+(?:\.\d+)?)\s+"
CODE_BREAK = r"(?mid:^[ \t]*Section\s+\d)"


def code_sections(text: Column) -> Column:
    """``array<struct<section_num, heading, body>>`` of the ``Section n.nn`` parts: the first line with text is the heading; a part without text ends at the next section's line, indented or not."""
    parts = F.filter(F.split(text, f"(?={CODE_BREAK})", -1), lambda x: x.rlike(CODE_HEAD))

    def record(part: Column) -> Column:
        lines = F.filter(F.split(strip_all(F.regexp_replace(part, CODE_HEAD, "")), "\n"), lambda x: strip_all(x) != "")
        heading = F.rtrim(strip_all(F.coalesce(F.get(lines, F.lit(0)), F.lit(""))), F.lit("."))
        rest = strip_all(F.array_join(F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1))), "\n"))
        number = F.regexp_extract(part, CODE_HEAD, 1)
        return F.struct(number.alias("section_num"), heading.alias("heading"), strip_all(F.concat(F.lit("Section "), number, F.lit("  "), heading, F.lit("\n"), rest)).alias("body"))

    return F.transform(parts, record)


def subsections(text: Column) -> Column:
    """Cut at ``(a)`` marks at line starts whose line before ends a clause; the text as it is where there is none."""

    def ends(before: Column) -> Column:
        last = strip_all(F.element_at(F.split(F.regexp_replace(before, r"\s+\z", ""), "\n"), -1))
        return made_once(last, lambda x: (x == "") | x.rlike(r"[.!?:;]\z") | x.rlike(r"(?i) (or|and)\z"))

    def joined(pieces: Column, starts: Column) -> Column:
        cut = F.transform(starts, lambda s, j: F.array_join(F.slice(pieces, s + 1, F.coalesce(F.get(starts, j + 1), F.size(pieces)) - s), "\n"))
        found = F.filter(F.transform(cut, strip_all), lambda x: x != "")
        return made_once(found, lambda x: F.when((F.size(starts) == 1) | (F.size(x) == 0), F.array(text)).otherwise(x))

    def cut_at_ends(pieces: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(pieces) - 1), lambda i: (i == 0) | ends(F.get(pieces, i - 1)))
        return made_once(starts, lambda found: joined(pieces, found))

    return made_once(F.split(text, r"\n(?=\([a-z]\))", -1), cut_at_ends)
