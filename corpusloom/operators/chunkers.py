"""One chunk transform, parameterised by what a source needs (clean, split, pack, merge, enrich)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions import folds, text as X
from corpusloom.operators.relational import keep_longest
from corpusloom.session import arrow_batches, stage_table

#: Texts of an Arrow batch that is cut.
CUT_ROWS = 512


@dataclass(frozen=True)
class ChunkSpec:
    source: str
    clean: Callable[[Column], Column] = X.collapse_blank_lines
    sections: Callable[[str], list[tuple[str, str]]] = lambda t: [("", t)]
    split: Callable[[str], list[str]] = folds.split_body
    merge: bool = True
    min_tokens: int = 40
    header: tuple[str, ...] = ("title",)
    metadata: tuple[str, ...] = ("title", "url")
    citation: str = "title"
    prefix: str = field(default="")

    def pieces(self, text: str) -> list[tuple[str, str, str]]:
        """(heading, body, tokens) of the chunks that are long enough."""
        parts = [(h, p) for h, body in self.sections(text) for p in self.split(body)]
        sized = [(h, p, folds.count_tokens(p)) for h, p in (folds.merge_micro(parts) if self.merge else parts)]
        return [(h, p, str(n)) for h, p, n in sized if n >= self.min_tokens]


def caps_sections(text: str, longest: int = 59) -> list[tuple[str, str]]:
    """T21 as a fold, for use inside a spec."""
    import re

    head, lines, out = "", [], []
    for line in text.split("\n"):
        t = line.strip()
        if re.match(rf"^[A-Z][A-Z0-9\s()\-/,]{{3,{longest}}}$", t) and len(t.split()) >= 3:
            out.append((head, "\n".join(lines).strip()))
            head, lines = t, []
        else:
            lines.append(line)
    out.append((head, "\n".join(lines).strip()))
    return [x for x in out if any(x)] or [("", text)]


def regex_sections(pattern: str) -> Callable[[str], list[tuple[str, str]]]:
    """(heading, body) at each match; the text before is a preamble without heading."""
    import re

    def run(text: str) -> list[tuple[str, str]]:
        marks = list(re.finditer(pattern, text, re.M))
        stops = [m.start() for m in marks[1:]] + [len(text)]
        out = [("", text[: marks[0].start()].strip() if marks else text)]
        out += [(m.group().strip(), text[m.end() : stop].strip()) for m, stop in zip(marks, stops, strict=False)]
        return [x for x in out if any(x)] or [("", text)]

    return run


#: Opinion markers and the types they stand for.
OPINION_TYPES = {
    "majority": "majority", "dissent": "dissent", "concurrence": "concurrence", "concur": "concurrence", "concurrence-in-part": "concurrence",
    "rehearing": "rehearing", "per curiam": "majority", "opinion": "majority", "unanimous": "majority", "plurality": "majority",
    "combined": "majority", "addendum": "addendum", "remittitur": "remittitur",
}


def opinion_segments(text: str) -> list[tuple[str, str]]:
    """(type, body) at ``[Marker]`` lines."""
    parts = regex_sections(r"^\[(?i:" + "|".join(sorted(OPINION_TYPES, key=len, reverse=True)) + r")\]")(text)
    return [(OPINION_TYPES.get(h.strip("[]").lower(), "preamble") if h else ("preamble" if len(parts) > 1 else "majority"), b) for h, b in parts if b] or [("majority", text.strip())]


def statute_split(text: str) -> list[str]:
    """Subsections, packed; what is still too long by sentences; short neighbours merged."""
    packed = folds.pack(folds.subsections(text))
    return folds.merge_small([p for s in packed for p in (folds.pack_sentences(s) if len(s) > 1500 else [s])])


SPECS = {
    "statutes": ChunkSpec("ilcs", X.clean_statute, split=statute_split, merge=False, min_tokens=20, header=("chapter_name", "act_name", "section_heading"), metadata=("section_citation", "section_heading", "act_name", "chapter_num", "url"), citation="section_citation"),
    "admin_code": ChunkSpec("illinois_admin_code", X.collapse_wraps, split=statute_split, merge=False, min_tokens=20, header=("title_name", "part_name", "section_heading"), metadata=("section_citation", "section_heading", "part_num", "url"), citation="section_citation"),
    "directives": ChunkSpec("idoc_directive", X.strip_page_headers, regex_sections(r"^(?:[IVX]+\.|[A-Z]\.)\s+[^\n]{3,80}$"), metadata=("title", "category", "sub_category", "url")),
    "policy_reports": ChunkSpec("spac", lambda c: X.strip_toc(X.strip_page_headers(c)), caps_sections, metadata=("title", "category", "year", "url")),
    "annual_reports": ChunkSpec("iccb", lambda c: X.strip_toc(X.strip_page_headers(c)), lambda t: caps_sections(t, 79), metadata=("title", "fiscal_year", "doc_type", "url")),
    "federal": ChunkSpec("federal", X.trim_boilerplate, regex_sections(r"^(?:[IVX]+\.|[A-Z]\.|\d+\.)\s+[^\n]{3,80}$"), metadata=("title", "doc_type", "citation", "url"), citation="citation"),
    "advocacy": ChunkSpec("restorejustice", header=("page_title",), metadata=("page_title", "section", "url"), citation="page_title"),
    "defender": ChunkSpec("cookcounty_pd", sections=regex_sections(r"(?=^Type of Legal Assistance)"), header=("page_title",), metadata=("page_title", "category", "url"), citation="page_title"),
    "bulk_opinions": ChunkSpec("cap_bulk", sections=lambda t: [(h or kind, b) for kind, seg in opinion_segments(t) for h, b in folds.opinion_sections(seg)], split=lambda b: folds.split_body(b, soften=True), merge=False, min_tokens=50, header=("case_name_abbr", "date_decided", "court"), metadata=("case_id", "case_name", "date_decided", "court"), citation="case_name_abbr"),
}


def chunk(entries: DataFrame, spec: ChunkSpec, seq: str | None = None) -> DataFrame:
    """Entries to chunks: longest text per id, cleaned, cut into (heading, text), numbered after the size filter."""
    def has(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("")) if c in entries.columns else F.lit("")

    rows = keep_longest(entries, ["id"], "text", seq) if seq else entries
    cut = folds.sections_over_column(spec.pieces, ("heading", "body", "tokens"))
    with arrow_batches(entries.sparkSession, CUT_ROWS):
        parts = stage_table(rows.withColumn("_p", cut(spec.clean(F.coalesce("text", F.lit(""))))).drop("text"), "chunk-parts")
    out = parts.select("*", F.size("_p").alias("chunk_total"), F.posexplode("_p").alias("chunk_index", "_c"))
    header = X.join_header(*[has(c) for c in spec.header])
    return out.select(
        F.concat_ws("_", F.lit(spec.source), F.col("id"), F.lpad(F.col("chunk_index").cast("string"), 4, "0")).alias("chunk_id"), F.col("id").alias("parent_id"), "chunk_index", "chunk_total",
        F.col("_c.body").alias("text"), X.enriched(header, F.col("_c.heading"), F.col("_c.body")).alias("enriched_text"), F.lit(spec.source).alias("source"),
        F.col("_c.tokens").cast("int").alias("token_count"), has(spec.citation).alias("display_citation"),
        F.map_from_arrays(F.array(*[F.lit(m) for m in (*spec.metadata, "section_heading_text")]), F.array(*[has(m) for m in spec.metadata], F.col("_c.heading"))).alias("metadata"),
        F.lit("").alias("chunked_at"),
    )
