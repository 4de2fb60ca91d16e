"""Records and chunks in their common forms: case records, citations, text fallback, payloads, prefixes (P, T31, F12, F18)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.text import clip, strip_html

#: Patterns of reporters in the order they are tried, with the names given.
REPORTERS = [
    (r"\bIll\.\s+App\.\s+3d\s", "ill-app-3d"),
    (r"\bIll\.\s+App\.\s+2d\s", "ill-app-2d"),
    (r"\bIll\.\s+App\.", "ill-app"),
    (r"\bIll\.\s+2d\s", "ill-2d"),
    (r"\bIll\.", "ill"),
]
#: Sub-categories of directives that are kept.
SUB_CATEGORIES = (
    "EDUCATION AND VOCATIONAL SERVICES", "PROGRAMS AND SERVICES", "MEDICAL AND HEALTH CARE", "MENTAL HEALTH", "SUBSTANCE ABUSE", "CLASSIFICATION",
    "RECEPTION AND ORIENTATION", "INDIVIDUAL IN CUSTODY RECORDS", "OFFENDER MANAGEMENT AND MOVEMENT", "ADULT TRANSITION CENTERS", "FIELD OPERATIONS",
    "LIBRARY SERVICES AND LEGAL MATERIAL", "RELIGIOUS ISSUES", "LEISURE TIME ACTIVITIES/RECREATION", "INTERNAL INVESTIGATIONS", "RESEARCH AND EVALUATION",
    "PLACEMENT RESOURCE UNIT", "STAFF DEVELOPMENT AND TRAINING",
)


def citations_of(cites: Column) -> Column:
    """The cites of an array of structs that aren't blank."""
    return F.filter(F.transform(cites, lambda c: F.coalesce(c["cite"], F.lit(""))), lambda c: c != "")


def reporter_of(citations: Column) -> Column:
    """By the first citation that any pattern fits; null if none does."""
    named = F.transform(citations, lambda c: F.coalesce(*[F.when(c.rlike(p), F.lit(name)) for p, name in REPORTERS]))
    return F.get(F.filter(named, lambda n: n.isNotNull()), F.lit(0))


def first_given(*values: Column) -> Column:
    """The first value that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def case_records(cases: DataFrame, source: str = "cap_bulk", jurisdiction: str = "Illinois") -> DataFrame:
    """Rows ``id, name, name_abbreviation, court(slug, id, name, name_abbreviation), decision_date, citations, docket_number, frontend_url, url, text`` as records; those without text go."""
    found = cases.filter(F.trim(F.coalesce("text", F.lit(""))) != "")
    cites = citations_of(F.col("citations"))
    blank = lambda c: F.coalesce(c, F.lit(""))
    return found.select(
        F.concat(F.lit("cap-"), F.col("id").cast("string")).alias("id"), F.lit(source).alias("source"), F.col("id").cast("string").alias("case_id"),
        blank("name").alias("case_name"), blank("name_abbreviation").alias("case_name_abbr"),
        first_given(F.col("court.name_abbreviation"), F.col("court.name")).alias("court"), first_given(F.col("court.slug"), F.col("court.id").cast("string")).alias("court_id"),
        F.lit(jurisdiction).alias("jurisdiction"), blank("decision_date").alias("date_decided"), cites.alias("citations"), reporter_of(cites).alias("reporter"),
        blank("docket_number").alias("docket_number"), first_given(F.col("frontend_url"), F.col("url")).alias("url"), "text",
    )


def text_or_html(plain: Column, html: Column) -> Column:
    """The plain text, else the text of the HTML; empty where neither has any."""
    return first_given(plain, strip_html(html))


def normalised(flat: DataFrame, metadata: list[str]) -> DataFrame:
    """Flat opinion rows as chunks; the columns named in ``metadata`` become its map."""
    label, name = F.coalesce("court_label", F.lit("ca7")), F.coalesce("case_name", F.lit(""))
    year = F.when(F.length("date_filed") >= 4, F.substring("date_filed", 1, 4)).otherwise("")
    heading, text = F.coalesce("section_heading", F.lit("")), F.coalesce("text", F.lit(""))
    header = F.when(name != "", F.concat(F.lit("["), label, F.lit(" | "), name, F.lit(" ("), year, F.lit(")]"))).otherwise(F.concat(F.lit("["), label, F.lit("]")))
    body = F.when(heading != "", F.concat(F.lit("\n["), heading, F.lit("]"))).otherwise("")
    return flat.select(
        "chunk_id", F.col("opinion_id").alias("parent_id"), "chunk_index", F.lit(None).cast("int").alias("chunk_total"), F.lit("courtlistener").alias("source"), "token_count",
        F.when(name != "", F.concat(name, F.lit(" ("), year, F.lit(")"))).otherwise("").alias("display_citation"), text.alias("text"),
        F.concat(header, body, F.lit("\n\n"), text).alias("enriched_text"), F.create_map(*[x for c in metadata for x in (F.lit(c), F.col(c).cast("string"))]).alias("metadata"),
    )


def payload(chunks: DataFrame, columns: list[str], lifted: list[str], longest: int = 2000) -> DataFrame:
    """The columns a table takes: ``columns`` of the chunk, ``lifted`` of its metadata, source also from there; texts clipped and without NUL."""
    clean = {c: clip(F.col(c), longest) for c in ("text", "enriched_text")}
    source = F.coalesce(F.nullif("source", F.lit("")), F.col("metadata")["source"])
    return chunks.select(*[(clean.get(c, source if c == "source" else F.col(c))).alias(c) for c in columns], *[F.col("metadata")[c].alias(c) for c in lifted])


def flat_metadata(rows: DataFrame, outside: tuple[str, ...] = ("text", "enriched_text", "similarity", "chunk_id")) -> DataFrame:
    """``chunk_id, metadata``: all columns but those outside, the row's own metadata put over them; nulls stay out."""
    names = [c for c in rows.columns if c not in outside and c != "metadata"]
    own = F.map_filter(F.create_map(*[x for c in names for x in (F.lit(c), F.col(c).cast("string"))]), lambda k, v: v.isNotNull())
    inner = F.coalesce(F.col("metadata"), F.create_map().cast("map<string,string>"))
    below = F.map_filter(own, lambda k, v: ~F.map_contains_key(inner, k))
    return rows.select("chunk_id", F.map_concat(below, inner).alias("metadata"))


def with_context(segments: Column, header: Column, citation: Column, size: int = 1500, orphan: str = r"^\s*\([a-z0-9]\)") -> Column:
    """A later segment that starts with a bare subsection mark gets the header, or where that is too long the citation and what then fits."""
    short = F.when(citation != "", F.concat(F.lit("["), citation, F.lit("]\n"))).otherwise("")

    def one(segment: Column, i: Column) -> Column:
        full = F.when(header != "", F.concat(header, F.lit("\n"), segment)).otherwise(segment)
        cut = F.when(short != "", F.concat(short, F.substring(segment, F.lit(1), F.lit(size) - F.length(short)))).otherwise(segment)
        return F.when((i > 0) & segment.rlike(orphan), F.when(F.length(full) <= size, full).otherwise(cut)).otherwise(segment)

    return F.transform(segments, one)


def wanted_category(sub_category: Column) -> Column:
    """F12."""
    return F.upper(F.trim(sub_category)).isin(*SUB_CATEGORIES)


def in_courts(court_id: Column, courts: tuple[str, ...] = ("ca7",)) -> Column:
    """F18."""
    return F.coalesce(F.trim(court_id), F.lit("")).isin(*courts)
