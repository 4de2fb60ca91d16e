"""Chunks of court rules, of opinions joined to their cluster and docket, and of parentheticals."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions import folds, text as X
from corpusloom.operators import filters
from corpusloom.operators.chunkers import CUT_ROWS
from corpusloom.operators.records import text_or_html
from corpusloom.operators.relational import left_lookup
from corpusloom.session import arrow_batches, stage_table

#: Weight of a precedential status; any other has 0.3.
STATUS_WEIGHT = {"Published": 1.0, "Unpublished": 0.5, "Errata": 0.1, "Separate": 0.4, "In-chambers": 0.3, "Relating-to": 0.2, "Unknown": 0.3}
#: Codes of opinion types and what they stand for.
OPINION_CODES = {
    "010combined": "combined", "015unamimous": "unanimous", "020lead": "majority", "025plurality": "plurality", "030concurrence": "concurrence",
    "035concurrence-in-part": "concurrence_in_part", "040dissent": "dissent", "050addendum": "addendum", "060remittitur": "remittitur",
    "070rehearing": "rehearing", "080on-the-merits": "on_the_merits", "090on-motion": "on_motion",
}
MAJORITY = ("combined", "unanimous", "majority", "plurality")
#: Names of courts.
COURTS = {"ill": "Illinois Supreme Court", "illappct": "Illinois Appellate Court"}
CLUSTER = ["case_name", "case_name_short", "date_filed", "judges", "precedential_status", "citation_count", "docket_id"]
DOCKET = ["court_id", "docket_number", "nature_of_suit", "cause", "date_terminated"]


def named(c: Column, names: dict[str, str]) -> Column:
    """The name of a code, else the code."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[c], c)


def weight_of(status: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in STATUS_WEIGHT.items() for x in kv])[status], F.lit(0.3))


def dated(name: Column, date: Column, bare: str = "") -> Column:
    """A case name with its year, where both are known."""
    year = X.year_of(date)
    return F.when((name != "") & (year != ""), F.concat(name, F.lit(" ("), year, F.lit(")"))).otherwise(F.when(name != "", name).otherwise(bare))


def with_case(rows: DataFrame, clusters: DataFrame, dockets: DataFrame) -> DataFrame:
    """Cluster, then docket columns by ``cluster_id``; what is missing is blank; of repeated ids the last by ``seq`` counts, where there is one."""
    seq = lambda df: "seq" if "seq" in df.columns else None
    out = left_lookup(rows, clusters, "cluster_id", CLUSTER, seq(clusters))
    return left_lookup(out, dockets, "docket_id", DOCKET, seq(dockets)).withColumn("court_label", named(F.col("court_id"), COURTS))


def parenthetical_chunks(parentheticals: DataFrame, opinions: DataFrame, clusters: DataFrame, dockets: DataFrame) -> DataFrame:
    """One chunk per parenthetical that has text, with the case of the describing opinion.

    ``parentheticals(id, text, describing_opinion_id, described_opinion_id, score)``; ``opinions(id, cluster_id)``.
    A missing opinion, cluster or docket leaves its columns blank; a score that is no number counts 0.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = parentheticals.filter(F.coalesce(F.trim("text"), F.lit("")) != "")
    rows = rows.select(blank("id").alias("id"), F.trim("text").alias("text"), blank("describing_opinion_id").alias("describing_opinion_id"), blank("described_opinion_id").alias("described_opinion_id"), F.coalesce(F.expr("try_cast(score as double)"), F.lit(0.0)).alias("score"))
    of = opinions.select(F.col("id").cast("string").alias("describing_opinion_id"), F.col("cluster_id").cast("string").alias("cluster_id"))
    case = with_case(left_lookup(rows, of, "describing_opinion_id", ["cluster_id"]), clusters, dockets)
    header = X.join_header(F.col("case_name"), F.col("date_filed"), F.col("court_label"))
    mark = F.when(header != "", F.concat(header, F.lit(" [parenthetical]"))).otherwise("[parenthetical]")
    base = dated(F.col("case_name"), F.col("date_filed"))
    return case.select(
        F.concat(F.lit("par_"), F.col("id")).alias("chunk_id"), F.col("describing_opinion_id").alias("parent_id"), F.lit(0).alias("chunk_index"), F.lit(1).alias("chunk_total"),
        "text", F.concat(mark, F.lit("\n\n"), F.col("text")).alias("enriched_text"), F.lit("courtlistener").alias("source"), X.token_count(F.col("text")).alias("token_count"),
        F.when(base != "", F.concat(base, F.lit(" — parenthetical"))).otherwise("parenthetical").alias("display_citation"),
        F.struct(
            F.lit("parenthetical").alias("chunk_type"), "describing_opinion_id", "described_opinion_id", "score", "case_name", "date_filed",
            "court_id", "court_label", "precedential_status", weight_of(F.col("precedential_status")).alias("precedential_weight"),
        ).alias("metadata"),
    )


def opinion_pieces(text: str) -> list[tuple[str, str, str, str]]:
    """(heading, body, number of the section, tokens)."""
    return [(h, p, str(i), str(folds.count_tokens(p))) for i, (h, body) in enumerate(folds.opinion_sections(text)) for p in folds.split_body(body, soften=True)]


def opinion_chunks(opinions: DataFrame, clusters: DataFrame, dockets: DataFrame, min_tokens: int = 50) -> DataFrame:
    """Opinions with their case, cut by sections; short and noise chunks go before the rest are numbered.

    ``opinions(id, cluster_id, type, plain_text, html_with_citations, author_str, per_curiam)``; opinions without text give none.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = opinions.select(
        blank("id").alias("opinion_id"), blank("cluster_id").alias("cluster_id"), named(blank("type"), OPINION_CODES).alias("opinion_type"),
        text_or_html(F.col("plain_text"), F.col("html_with_citations")).alias("_text"), blank("author_str").alias("author"), (F.lower(blank("per_curiam")) == "true").alias("per_curiam"),
    ).filter(F.trim("_text") != "")
    cut = folds.sections_over_column(opinion_pieces, ("heading", "body", "section", "tokens"))
    with arrow_batches(opinions.sparkSession, CUT_ROWS):
        parts = stage_table(rows.withColumn("_p", cut("_text")).drop("_text"), "opinion-parts")
    parts = with_case(parts, clusters, dockets)
    size = lambda p: p["tokens"].cast("int")
    parts = parts.withColumn("_p", F.filter("_p", lambda p: (size(p) >= min_tokens) & ~filters.noise(p["body"], size(p))))
    out = parts.select("*", F.size("_p").alias("chunk_total"), F.posexplode("_p").alias("chunk_index", "_c"))
    heading, body = F.col("_c.heading"), F.col("_c.body")
    return out.select(
        F.concat(F.col("opinion_id"), F.lit("_c"), F.col("chunk_index").cast("string")).alias("chunk_id"), F.col("opinion_id").alias("parent_id"), "chunk_index", "chunk_total",
        body.alias("text"), X.enriched(X.join_header(F.col("case_name_short"), F.col("date_filed"), F.col("court_label")), heading, body).alias("enriched_text"),
        F.lit("courtlistener").alias("source"), F.col("_c.tokens").cast("int").alias("token_count"), dated(F.col("case_name_short"), F.col("date_filed")).alias("display_citation"),
        F.struct(
            F.when(heading != "", "opinion_section").otherwise("opinion_paragraph").alias("chunk_type"), heading.alias("section_heading"), F.col("_c.section").cast("int").alias("section_index"),
            "opinion_id", "opinion_type", F.col("opinion_type").isin(*MAJORITY).alias("is_majority"), "author", "per_curiam", "cluster_id", "case_name", "case_name_short", "date_filed", "judges",
            "precedential_status", weight_of(F.col("precedential_status")).alias("precedential_weight"), F.coalesce(F.expr("try_cast(citation_count as int)"), F.lit(0)).alias("citation_count"),
            "docket_id", "court_id", "court_label", "docket_number", "nature_of_suit", "cause", "date_terminated",
        ).alias("metadata"),
    )


def kept_rule_text(text: str) -> bool:
    """F8 for use inside a fold."""
    t = text.strip()
    return not any(re.match(p, t, re.I) for p in filters.RULE_SKIP) and (any(re.search(p, t, re.I) for p in filters.RULE_KEEP) or bool(re.search(r"\w", t)))


RULE_FIELDS = ("content_type", "article_number", "article_title", "part_letter", "part_title", "rule_number", "rule_title", "subsection", "index", "total", "text")


def rule_pieces(text: str) -> list[tuple[str, ...]]:
    """What a rule document holds, in order, as ``RULE_FIELDS``: headers, rules or their subsections, comments."""
    out: list[tuple[str, ...]] = []
    for r in folds.rule_records(text):
        place = tuple(r[k] or "" for k in RULE_FIELDS[1:7])
        if r["content_type"] != "rule_text":
            if r["content_type"].endswith("_header") or kept_rule_text(r["text"]):
                out.append((r["content_type"], *place, "", "0", "1", r["text"]))
            continue
        if not kept_rule_text(r["text"]):
            continue
        parts = [(s, p) for s, p in folds.rule_split(r["text"]) if kept_rule_text(p)]
        out += [("rule_subsection" if s else "rule_text", *place, s, str(i), str(len(parts)), p) for i, (s, p) in enumerate(parts)]
    return out


def rule_chunks(documents: DataFrame) -> DataFrame:
    """T38 of rule documents ``documents(id, text)``; a null text gives no chunk. Ids number a document's chunks in order."""
    rows = documents.select("id", F.posexplode(folds.sections_over_column(rule_pieces, RULE_FIELDS)("text")).alias("_i", "_c"))
    c = lambda name: F.col(f"_c.{name}")
    sub = F.when(c("subsection") != "", F.concat(F.lit("("), c("subsection"), F.lit(")"))).otherwise("")
    number = F.concat(F.lit("Rule "), c("rule_number"), sub)
    path = F.concat_ws(
        " → ", F.when(c("article_number") != "", F.concat(F.lit("Article "), c("article_number"))), F.when(c("part_letter") != "", F.concat(F.lit("Part "), c("part_letter"))),
        F.when(c("rule_number") != "", number),
    )
    ruled = F.when(c("rule_title") != "", F.concat(number, F.lit(" — "), c("rule_title"))).otherwise(number)
    shown = F.when(c("rule_number") != "", ruled).otherwise(F.when(path != "", path).otherwise(F.regexp_replace(c("content_type"), "_", " ")))
    title = F.when(c("rule_number") != "", F.concat_ws(
        " ", F.concat(F.lit("Rule "), c("rule_number")), X.blank_to_null(sub), F.when((c("rule_title") != "") & (c("subsection") == ""), F.concat(F.lit(": "), c("rule_title"))),
    ))
    context = F.concat_ws("\n", F.when(c("article_title") != "", F.concat(F.lit("["), c("article_title"), F.lit("]"))), X.blank_to_null(c("part_title")), title)
    return rows.select(
        F.concat_ws("_", F.lit("iscr"), F.col("id"), F.lpad(F.col("_i").cast("string"), 4, "0")).alias("chunk_id"), F.col("id").alias("parent_id"),
        c("index").cast("int").alias("chunk_index"), c("total").cast("int").alias("chunk_total"), c("text").alias("text"),
        F.when(context != "", F.concat(context, F.lit("\n\n"), c("text"))).otherwise(c("text")).alias("enriched_text"),
        F.lit("illinois_supreme_court_rules").alias("source"), X.token_count(c("text")).alias("token_count"), shown.alias("display_citation"),
        F.struct(
            "_c.content_type", path.alias("hierarchical_path"), *[f"_c.{k}" for k in RULE_FIELDS[1:7]], c("subsection").alias("subsection_id"),
            X.amendment_history(c("text")).alias("amendment_history"), X.cross_references(c("text")).alias("cross_references"),
        ).alias("metadata"),
    )
