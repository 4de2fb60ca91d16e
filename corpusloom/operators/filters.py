"""Row predicates (F-rows) as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusloom.functions.text import strip_all

#: Chapters in scope, and acts of chapter 20 out of scope.
CHAPTERS = ["20", "50", "225", "325", "410", "430", "625", "705", "720", "725", "730", "735", "750", "775"]
CHAPTER_20_OUT = ["20 ILCS 605", "20 ILCS 1205", "20 ILCS 1370", "20 ILCS 1605", "20 ILCS 2505", "20 ILCS 3205"]
#: Marks of page furniture in court documents.
NOISE = [
    r"(?m)^\s*-\s*\d+\s*-\s*$", r"\x0c", r"(?mi)^\s*(?:FIRST|SECOND|THIRD|FOURTH|FIFTH|SIXTH)\s+DISTRICT\s*$",
    r"(?mi)^\s*(?:ILLINOIS\s+)?SUPREME\s+COURT\s*$", r"v\.\s{2,}[\)|\|]", r"\bNos?\.\s+\d+[-\w]+", r"(?mi)^\s*NOTICE\s*$",
    r"(?i)Order filed|Decision filed", r"(?i)This order was filed under|Rule 23", r"(?m)^\s*_{5,}\s*$", r"(?m)^\s*Nos?\.\s+\d",
]
#: Rule texts that hold nothing, and marks of those that do.
RULE_SKIP = [r"^Rule\s+\d+\.?\s+Reserved\.?$", r"^\[\s*PAGE\s+\d+\s*\]$", r"^Amended\s+.*$", r"^Effective\s+.*$", r"^Adopted\s+.*$", r"^Committee Comments?$"]
RULE_KEEP = [r"\([a-z0-9]\)", r"Rule\s+\d+", r"§\s+\d+", r"(?:shall|must|may)\s+", r"defined\s+as", r"means\s+", r"includes?\s+"]


def statute_scope(chapter: Column, citation: Column) -> Column:
    """F1; prefixes are not delimited."""
    out = F.lit(False)
    for p in CHAPTER_20_OUT:
        out = out | F.coalesce(citation, F.lit("")).startswith(p)
    return F.coalesce(chapter.isin(CHAPTERS), F.lit(False)) & ~((chapter == "20") & out)


def criminal(case_name: Column, text: Column) -> Column:
    """F4."""
    return F.coalesce(case_name, F.lit("")).rlike(r"(?i)\bPeople\b|^In re\b") | F.coalesce(text, F.lit("")).rlike(r"\b(705|720|725|730)\s+ILCS\b")


def opinion_scope(date: Column, case_name: Column, text: Column, cutoff: str = "1973-01-01") -> Column:
    """F2; a missing date passes."""
    return ((F.coalesce(date, F.lit("")) == "") | (date >= cutoff)) & criminal(case_name, text)


def dated_from(date: Column, cutoff: str = "1973") -> Column:
    """F3; a missing date fails."""
    return (F.coalesce(date, F.lit("")) != "") & (date >= cutoff)


def in_dates(date: Column, after: str | None = None, before: str | None = None) -> Column:
    """F5; a missing date passes."""
    ok = F.lit(True)
    if after:
        ok = ok & (date >= after)
    if before:
        ok = ok & (date <= before)
    return (F.coalesce(date, F.lit("")) == "") | ok


def noise(text: Column, tokens: Column) -> Column:
    """short and marked: one mark below 60 tokens, two up to 150."""
    marks = sum((text.rlike(p).cast("int") for p in NOISE[1:]), text.rlike(NOISE[0]).cast("int"))
    return (tokens <= 150) & (marks >= F.when(tokens < 60, 1).otherwise(2))


def keep_rule_text(text: Column) -> Column:
    """F8."""
    t = strip_all(text)
    skip = F.lit(False)
    for p in RULE_SKIP:
        skip = skip | t.rlike("(?i)" + p)
    keep = t.rlike(r"[\p{L}\p{N}_]")
    for p in RULE_KEEP:
        keep = keep | t.rlike("(?i)" + p)
    return ~skip & keep


def not_repealed(heading: Column) -> Column:
    """F9."""
    return ~F.coalesce(heading, F.lit("")).rlike(r"(?i)\(Repealed\)")


#: File names of meeting logistics.
SKIP_FILES = (r"meeting.agenda", r"meeting.minutes", r"agenda.final", r"minutes.final")
#: Paths that hold no reference text; the last is the home page.
SKIP_PATHS = (r"/locations", r"/careers", r"/news", r"/about", r"/contact", r"/search", r"^/$")


def wanted_file(name: Column, skip: tuple[str, ...] = SKIP_FILES) -> Column:
    """F10."""
    return ~name.rlike("(?i)" + "|".join(skip))


def wanted_url(url: Column, domain: str, skip: tuple[str, ...] = SKIP_PATHS) -> Column:
    """on the domain, not a PDF, not on a skipped path; closing slashes don't count, no path is the home page."""
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/]*(/.*)?$", 1)
    at = F.regexp_replace(path, r"/+$", "")
    at = F.when(at == "", "/").otherwise(at)
    return F.contains(F.regexp_extract(rest, r"^[^/]*", 0), F.lit(domain)) & ~F.endswith(path, F.lit(".pdf")) & ~at.rlike("|".join(skip))


def numeric_id(c: Column) -> Column:
    """F17."""
    return c.rlike(r"^\d+$")


def statute_lookup(question: Column) -> Column:
    """the statute citation a question names, else null."""
    return F.nullif(F.regexp_extract(question, r"(\d+ ILCS \d+/[\d\-.]+\w*)", 1), F.lit(""))


def rule_lookup(question: Column) -> Column:
    return F.nullif(F.regexp_extract(question, r"^Rule (\d+)", 1), F.lit(""))
