"""Queries that cut texts at matches: statutes, codes, headings, opinions, directories, subsections."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusloom.functions import matches as M
from corpusloom.plans.base import Registry
from corpusloom.session import table

Q = Registry()

_TRIM = r"regexp_replace({0}, '^[\s\x{{A0}}]+|[\s\x{{A0}}]+$', '', 'g')"


def _trim(sql: str) -> str:
    return _TRIM.format(sql)


def _docs(spark, sf, text: Column):
    return table(spark, sf, "documents").select("doc_id", text.alias("text"))


def _id() -> Column:
    return F.col("doc_id").cast("string")


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def _cut(before: str, hits: str, text: str) -> str:
    """CTEs ``p`` (pieces and hits), ``w`` (a row for each hit, its place, the next one's start) of ``before``'s column t."""
    return f"""{before}, p as (select doc_id, t, regexp_split_to_array(t, '{hits}') as pieces, regexp_extract_all(t, '{hits}') as hits from d),
w as (select doc_id, t, k, hit, cast(gone + sum(length(piece) + length(hit)) over (partition by doc_id order by k) as bigint) as stop from (
  select doc_id, t, unnest(range(len(hits))) as k, unnest(hits) as hit, unnest(pieces[1:len(hits)]) as piece, 0 as gone from p))"""


@Q(_cut("""with d as (select doc_id, coalesce(text, '') || chr(10) || '(720 ILCS 5/' || doc_id || '-1)' || chr(10) || '(from Ch. 38)' || chr(10) || 'Sec. ' || doc_id || '-1. Short' || chr(10) || 'title. ' || coalesce(text, '') || ' ( 5 ILCS 70/1)' ||
 substr(coalesce(text, ''), 1, doc_id % 400) || ' Sec. 1. Last. (Repealed)' as t from documents)""", r"(?i)\(\s*\d+\s+ILCS\s+[\w/.\-]+\)", "t") + r""",
o as (select doc_id, t, k, hit, stop, stop - length(hit) as start, lead(stop - length(hit), 1, length(t)) over (partition by doc_id order by k) as next_start from w where regexp_matches(substr(t, stop + 1, 300), '(?i)\bSec\.\s+[\w./\-]+\.')),
b as (select doc_id, row_number() over (partition by doc_id order by k) - 1 as pos, hit, substr(t, start + 1, next_start - start) as block from o)
select doc_id, cast(pos as int) as pos, regexp_extract(hit, '(?i)\(\s*(\d+)\s', 1) || ' ILCS ' || regexp_extract(hit, '(?i)ILCS\s+([\w/.\-]+)\)', 1) as citation,
 rtrim(""" + _trim(r"regexp_replace(regexp_extract(block, '(?is)Sec\.\s+[\w./\-]+\.\s*(.*?)\.', 1), '\s+', ' ', 'g')") + """, '.') as heading, md5(""" + _trim("block") + r""") as body_md5, regexp_matches(block, '(?i)\(Repealed\)') as repealed from b""")
def statute_sections(spark, sf):
    """A citation opens a section where a section mark follows it closely, and ends at the next such."""
    text = F.concat(_text(), F.lit("\n(720 ILCS 5/"), _id(), F.lit("-1)\n(from Ch. 38)\nSec. "), _id(), F.lit("-1. Short\ntitle. "), _text(), F.lit(" ( 5 ILCS 70/1)"),
                    F.substr(_text(), F.lit(1), (F.col("doc_id") % 400).cast("int")), F.lit(" Sec. 1. Last. (Repealed)"))
    found = _docs(spark, sf, text).select("doc_id", F.posexplode(M.statute_sections(F.col("text"))).alias("pos", "x"))
    return found.select("doc_id", "pos", "x.citation", "x.heading", F.md5("x.body").alias("body_md5"), "x.repealed")


@Q(r"""with d as (select doc_id, coalesce(text, '') || chr(10) || 'Section ' || (10 + doc_id % 90) || '.' || doc_id || '  Scope.' || chr(10) || coalesce(text, '') || chr(10) || '  section 9.1 too short a number' || chr(10) || 'SECTION 100.2.3' || chr(10) || chr(10) || 'Title' || chr(10) || 'x' as t from documents),
s as (select doc_id, unnest(string_split(regexp_replace(t, '(?im)(^[ \t]*Section\s+\d)', chr(1) || '\1', 'g'), chr(1))) as part, generate_subscripts(string_split(regexp_replace(t, '(?im)(^[ \t]*Section\s+\d)', chr(1) || '\1', 'g'), chr(1)), 1) as k from d),
h as (select doc_id, row_number() over (partition by doc_id order by k) - 1 as pos, regexp_extract(part, '(?i)^[ \t]*Section\s+(\d{2,4}\.\d+(?:\.\d+)?)\s+', 1) as section_num,
 list_filter(string_split(""" + _trim(r"regexp_replace(part, '(?i)^[ \t]*Section\s+(\d{2,4}\.\d+(?:\.\d+)?)\s+', '')") + r""", chr(10)), lambda x: regexp_matches(x, '[^\s\x{A0}]')) as lines from s where regexp_matches(part, '(?i)^[ \t]*Section\s+(\d{2,4}\.\d+(?:\.\d+)?)\s+'))
select doc_id, cast(pos as int) as pos, section_num, rtrim(""" + _trim("coalesce(lines[1], '')") + """, '.') as heading,
 md5(""" + _trim("'Section ' || section_num || '  ' || rtrim(" + _trim("coalesce(lines[1], '')") + ", '.') || chr(10) || " + _trim("array_to_string(lines[2:], chr(10))")) + """) as body_md5 from h""")
def code_sections(spark, sf):
    """T10."""
    text = F.concat(_text(), F.lit("\nSection "), (10 + F.col("doc_id") % 90).cast("string"), F.lit("."), _id(), F.lit("  Scope.\n"), _text(), F.lit("\n  section 9.1 too short a number\nSECTION 100.2.3\n\nTitle\nx"))
    found = _docs(spark, sf, text).select("doc_id", F.posexplode(M.code_sections(F.col("text"))).alias("pos", "x"))
    return found.select("doc_id", "pos", "x.section_num", "x.heading", F.md5("x.body").alias("body_md5"))


def _headed(pattern: str) -> str:
    return f"""select doc_id, '{{kind}}' as kind, unnest(list_concat([''], regexp_extract_all(t, '{pattern}'))) as heading, unnest(regexp_split_to_array(t, '{pattern}')) as body,
 unnest(range(len(regexp_split_to_array(t, '{pattern}')))) as k from d"""


_ROMAN, _LETTER, _NUMBER = (p.replace("(?md)", "(?m)") for p in (M.ROMAN, M.LETTER, M.NUMBER))


@Q("""with d as (select doc_id, coalesce(text, '') || chr(10) || 'IV. SCOPE' || chr(10) || coalesce(text, '') || chr(10) || 'B. Purpose of This' || chr(10) || 'x' || chr(10) || doc_id || '.  RULE 7' || chr(10) || coalesce(text, '') as t from documents),
e as (""" + " union all ".join(_headed(p).format(kind=k) for k, p in (("roman", _ROMAN.replace("{", "{{").replace("}", "}}")), ("letter", _LETTER.replace("{", "{{").replace("}", "}}")), ("number", _NUMBER.replace("{", "{{").replace("}", "}}")))) + """),
f as (select doc_id, kind, k, """ + _trim("heading") + " as heading, " + _trim("body") + """ as body from e)
select doc_id, kind, cast(row_number() over (partition by doc_id, kind order by k) - 1 as int) as pos, heading, md5(body) as body_md5 from f where body <> ''""")
def headed_sections(spark, sf):
    """T22."""
    text = F.concat(_text(), F.lit("\nIV. SCOPE\n"), _text(), F.lit("\nB. Purpose of This\nx\n"), _id(), F.lit(".  RULE 7\n"), _text())
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), M.sections(F.col("text"), p).alias("found")) for k, p in (("roman", M.ROMAN), ("letter", M.LETTER), ("number", M.NUMBER))])
    found = _docs(spark, sf, text).select("doc_id", F.explode(kinds).alias("x")).select("doc_id", "x.kind", F.posexplode("x.found").alias("pos", "s"))
    return found.select("doc_id", "kind", "pos", "s.heading", F.md5("s.body").alias("body_md5"))


_MARK = M.MARKER.replace("(?mid)", "(?mi)")
_TYPES = " ".join(f"when '{k}' then '{v}'" for k, v in M.OPINION_TYPES.items())


@Q(f"""with d as (select doc_id, case when doc_id % 5 = 0 then coalesce(text, '') else coalesce(text, '') || chr(10) || '[Majority]' || chr(10) || coalesce(text, '') || chr(10) || '[Concurrence-In-Part] x' || chr(10) || '[other] y' || chr(10) || '[per curiam]' end as t from documents),
e as (select doc_id, t, unnest(list_concat([''], regexp_extract_all(t, '{_MARK}'))) as head, unnest(regexp_split_to_array(t, '{_MARK}')) as body, unnest(range(len(regexp_split_to_array(t, '{_MARK}')))) as k, len(regexp_extract_all(t, '{_MARK}')) as n from d),
f as (select doc_id, k, case when n = 0 then 'majority' when head = '' then 'preamble' else case lower(translate(head, '[]', '')) {_TYPES} end end as opinion_type, {_trim('body')} as body, n from e)
select doc_id, cast(row_number() over (partition by doc_id order by k) - 1 as int) as pos, opinion_type, md5(body) as body_md5 from f where body <> '' or n = 0""")
def opinion_segments(spark, sf):
    """T23."""
    marked = F.concat(_text(), F.lit("\n[Majority]\n"), _text(), F.lit("\n[Concurrence-In-Part] x\n[other] y\n[per curiam]"))
    found = _docs(spark, sf, F.when(F.col("doc_id") % 5 == 0, _text()).otherwise(marked)).select("doc_id", F.posexplode(M.opinion_segments(F.col("text"))).alias("pos", "x"))
    return found.select("doc_id", "pos", F.col("x.heading").alias("opinion_type"), F.md5("x.body").alias("body_md5"))


@Q(r"""with d as (select doc_id, 'Type of Legal Assistance' || chr(10) || coalesce(text, '') || chr(10) || 'Type of Legal Assistance  ' || chr(10) || 'x Type of Legal Assistance' || chr(10) || coalesce(text, '') as t from documents),
e as (select doc_id, string_split(regexp_replace(t, '(?m)(^Type of Legal Assistance\s*\n)', chr(1) || '\1', 'g'), chr(1)) as parts from d),
f as (select doc_id, unnest(parts) as part, generate_subscripts(parts, 1) as k from e)
select doc_id, cast(row_number() over (partition by doc_id order by k) - 1 as int) as pos, md5(""" + _trim("part") + ") as entry_md5 from f where " + _trim("part") + " <> ''")
def directory_entries(spark, sf):
    """T24."""
    text = F.concat(F.lit("Type of Legal Assistance\n"), _text(), F.lit("\nType of Legal Assistance  \nx Type of Legal Assistance\n"), _text())
    return _docs(spark, sf, text).select("doc_id", F.posexplode(M.directory_entries(F.col("text"))).alias("pos", "x")).select("doc_id", "pos", F.md5("x").alias("entry_md5"))


@Q(r"""with d as (select doc_id, '(a) ' || coalesce(text, '') || chr(10) || '(b) no end' || chr(10) || '(c) ' || coalesce(text, '') || ' or' || chr(10) || '(d) all;' || chr(10) || '(1) part' || chr(10) || chr(10) || '(e) ' || coalesce(text, '') as t from documents),
c as (select doc_id, string_split(regexp_replace(t, '\n(\([a-z]\))', chr(10) || chr(1) || '\1', 'g'), chr(1)) as parts from d),
l as (select doc_id, unnest(parts) as part, generate_subscripts(parts, 1) as k from c),
m as (select *, lag(part) over (partition by doc_id order by k) as before from l),
g as (select doc_id, k, part, sum(case when before is null or regexp_matches(before, '[.!?:;]\s*$') or regexp_matches(before, '(?i) (or|and)\s*$') or not regexp_matches(before, '\S') then 1 else 0 end) over (partition by doc_id order by k) as seg from m),
s as (select doc_id, seg, string_agg(part, '' order by k) as body from g group by all)
select doc_id, cast(row_number() over (partition by doc_id order by seg) - 1 as int) as pos, md5(""" + _trim("body") + ") as body_md5 from s where " + _trim("body") + " <> ''")
def subsection_cuts(spark, sf):
    """T25."""
    text = F.concat(F.lit("(a) "), _text(), F.lit("\n(b) no end\n(c) "), _text(), F.lit(" or\n(d) all;\n(1) part\n\n(e) "), _text())
    return _docs(spark, sf, text).select("doc_id", F.posexplode(M.subsections(F.col("text"))).alias("pos", "x")).select("doc_id", "pos", F.md5("x").alias("body_md5"))
