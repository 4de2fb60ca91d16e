"""Court rules, case law and a crawl: each query with its SQL equivalent."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import caselaw
from corpusloom.plans.base import Registry
from corpusloom.session import table
from corpusloom.sources import readers

Q = Registry()

_FLAT = "trim(regexp_replace(coalesce(text, ''), '[\\s]+', ' ', 'g'))"
_RULES = f"""with t as (select doc_id as id, 'x' || {_FLAT} as b, lang from documents),
p as (select id, 'Rule ' || (id % 900) || '. On ' || coalesce(lang, '?') || chr(10) || 'It shall be so.' as head, '(a) ' || b as pa, '(b) ' || b as pb, '(c) ' || b as pc, b from t),
w as (select *, head || chr(10) || pa || chr(10) || pb || chr(10) || pc as whole, regexp_extract(head, 'On (.*)', 1) as title from p), e as (select *, length(whole) > 1000 as long from w),
c as (select id, 0 as i, 'article_header' as kind, 'Article IV' as path, 'Article IV' as shown, '' as sub, 0 as ci, 1 as ct, 'Article IV. Discovery' as text, '[Discovery]' as ctx from e
 union all select id, 1, 'part_header', 'Article IV → Part B', 'Article IV → Part B', '', 0, 1, 'Part B. Scope', '[Discovery]' || chr(10) || 'Scope' from e
 union all select id, 2, 'rule_text', 'Article IV → Part B → Rule ' || (id % 900), 'Rule ' || (id % 900) || ' — On ' || title, '', 0, 1, whole, '[Discovery]' || chr(10) || 'Scope' || chr(10) || 'Rule ' || (id % 900) || ' : On ' || title from e where not long
 union all select id, 2 + k, 'rule_subsection', 'Article IV → Part B → Rule ' || (id % 900) || '(' || s || ')', 'Rule ' || (id % 900) || '(' || s || ') — On ' || title, s, k, 3, case k when 0 then head || chr(10) || pa when 1 then pb else pc end, '[Discovery]' || chr(10) || 'Scope' || chr(10) || 'Rule ' || (id % 900) || ' (' || s || ')' from e, (values (0, 'a'), (1, 'b'), (2, 'c')) v(k, s) where long
 union all select id, case when long then 5 else 3 end, 'committee_comment', 'Article IV → Part B → Rule ' || (id % 900), 'Rule ' || (id % 900) || ' — On ' || title, '', 0, 1, 'Committee Comments' || chr(10) || b, '[Discovery]' || chr(10) || 'Scope' || chr(10) || 'Rule ' || (id % 900) || ' : On ' || title from e)
select 'iscr_' || id || '_' || lpad(cast(i as varchar), 4, '0') as chunk_id, kind as content_type, path as hierarchical_path, shown as display_citation, sub as subsection_id, ci as chunk_index, ct as chunk_total, sha256(ctx || chr(10) || chr(10) || text) as digest from c"""


@Q(_RULES)
def rule_chunks(spark, sf):
    """T32, T33, T38, F8."""
    nl = F.lit("\n")
    body = F.concat(F.lit("x"), F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\s]+", " ")))
    text = F.concat(
        F.lit("Article IV. Discovery\nPart B. Scope\n\nRule "), (F.col("doc_id") % 900).cast("string"), F.lit(". On "), F.coalesce("lang", F.lit("?")), F.lit("\nIt shall be so.\n[PAGE 2]\n"),
        F.lit("(a) "), body, nl, F.lit("(b) "), body, nl, F.lit("(c) "), body, F.lit("\n  Committee Comments\n"), body,
    )
    out = caselaw.rule_chunks(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), text.alias("text")))
    return out.select("chunk_id", "metadata.content_type", "metadata.hierarchical_path", "display_citation", "metadata.subsection_id", "chunk_index", "chunk_total", F.sha2("enriched_text", 256).alias("digest"))


_CASES = """op as (select doc_id as id, doc_id * 2 as cluster_id from documents),
cl as (select c_custkey as cluster_id, c_name as case_name, case when c_custkey % 4 = 0 then '' else '19' || lpad(cast(c_custkey % 100 as varchar), 2, '0') || '-01-02' end as date_filed, ['Published', 'Unpublished', 'Other'][c_custkey % 3 + 1] as status, c_nationkey as docket_id from customer),
dk as (select n_nationkey as docket_id, ['ill', 'illappct', 'ca7'][n_nationkey % 3 + 1] as court_id from nation)"""


def _cases(spark, sf):
    pick = lambda c, xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (c % 3 + 1).cast("int"))
    key = F.col("c_custkey")
    date = F.when(key % 4 == 0, "").otherwise(F.concat(F.lit("19"), F.lpad((key % 100).cast("string"), 2, "0"), F.lit("-01-02")))
    none = F.lit("").alias
    clusters = table(spark, sf, "customer").select(
        key.cast("string").alias("cluster_id"), F.col("c_name").alias("case_name"), F.concat(F.lit("s "), "c_name").alias("case_name_short"), date.alias("date_filed"), none("judges"),
        pick(key, ("Published", "Unpublished", "Other")).alias("precedential_status"), F.lit("7").alias("citation_count"), F.col("c_nationkey").cast("string").alias("docket_id"),
    )
    n = F.col("n_nationkey")
    dockets = table(spark, sf, "nation").select(n.cast("string").alias("docket_id"), pick(n, ("ill", "illappct", "ca7")).alias("court_id"), *[none(c) for c in caselaw.DOCKET[1:]])
    return clusters, dockets


@Q(f"""with {_CASES}, p as (select conv_id * 100 + turn as id, cast(conv_id * 13 + turn as bigint) as of_id, trim(text, ' ') as text, turn from conversations where trim(coalesce(text, ''), ' ') <> ''),
j as (select p.*, coalesce(case_name, '') as case_name, coalesce(date_filed, '') as date_filed, coalesce(status, '') as status, coalesce(court_id, '') as court_id from p left join op on op.id = of_id left join cl using (cluster_id) left join dk using (docket_id)),
k as (select *, case court_id when 'ill' then 'Illinois Supreme Court' when 'illappct' then 'Illinois Appellate Court' else court_id end as court_label from j),
h as (select *, array_to_string(list_filter([case_name, date_filed, court_label], lambda x: x <> ''), ' | ') as header, case when case_name <> '' and date_filed <> '' then case_name || ' (' || date_filed[1:4] || ')' else case_name end as base from k)
select 'par_' || id as chunk_id, cast(of_id as varchar) as parent_id, court_label, case status when 'Published' then 1.0 when 'Unpublished' then 0.5 else 0.3 end::double as precedential_weight, case when turn % 2 = 0 then 0.0 else turn end::double as score,
 case when base = '' then 'parenthetical' else base || ' — parenthetical' end as display_citation, sha256(case when header = '' then '' else header || ' ' end || '[parenthetical]' || chr(10) || chr(10) || text) as digest from h""")
def parenthetical_chunks(spark, sf):
    """T37, J2."""
    conv, turn = F.col("conv_id"), F.col("turn")
    p = table(spark, sf, "conversations").select((conv * 100 + turn).alias("id"), "text", (conv * 13 + turn).alias("describing_opinion_id"), conv.alias("described_opinion_id"), F.when(turn % 2 == 0, "none").otherwise(turn.cast("string")).alias("score"))
    opinions = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), (F.col("doc_id") * 2).alias("cluster_id"))
    out = caselaw.parenthetical_chunks(p, opinions, *_cases(spark, sf))
    return out.select("chunk_id", "parent_id", "metadata.court_label", "metadata.precedential_weight", "metadata.score", "display_citation", F.sha2("enriched_text", 256).alias("digest"))


@Q()
def caselaw_opinions(spark, sf):
    """T18, T20, T38, J1, F6, F7."""
    plain = F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("BACKGROUND\n"), F.col("text"), F.lit("\nANALYSIS\n"), F.col("text")))
    d = table(spark, sf, "documents")
    kind = F.element_at(F.array(F.lit("010combined"), F.lit("040dissent"), F.lit("other")), (F.col("doc_id") % 3 + 1).cast("int"))
    opinions = d.select(F.col("doc_id").alias("id"), (F.col("doc_id") * 2).alias("cluster_id"), kind.alias("type"), plain.alias("plain_text"), F.concat(F.lit("<p>"), "text", F.lit("</p>")).alias("html_with_citations"), F.lit("").alias("author_str"), F.lit("True").alias("per_curiam"))
    out = caselaw.opinion_chunks(opinions, *_cases(spark, sf))
    return out.select("chunk_id", "parent_id", "chunk_index", "chunk_total", "token_count", "display_citation", "metadata.opinion_type", "metadata.is_majority", "metadata.section_index", "metadata.court_label", F.sha2("enriched_text", 256).alias("digest"))


@Q("""with recursive s as (select page_id, (page_id * 3 + 1) % 1000003 as a, page_id * 2 as b from pages where page_id % 13 <> 5), r(page_id, depth) as (select page_id, 0 from s where page_id % 20 = 0 union select n.page_id, r.depth + 1 from r join s on s.page_id = r.page_id cross join lateral (select unnest([s.a, s.b]) as page_id) n where r.depth < 4 and n.page_id % 10 <> 7)
select 'https://site.test/p/' || r.page_id as link, min(depth) as depth from r join s using (page_id) group by 1""")
def crawl_rounds(spark, sf):
    """Five rounds over a link graph whose pages link to two others; some pages are missing, some links not allowed."""
    page = F.col("page_id")
    link = lambda c: F.concat(F.lit('<a href="/p/'), c.cast("string"), F.lit('">x</a>'))
    site = table(spark, sf, "pages").filter("page_id % 13 <> 5").select(F.concat(F.lit("https://site.test/p/"), page.cast("string")).alias("link"), F.concat(link((page * 3 + 1) % 1000003), link(page * 2)).alias("html"))
    seeds = table(spark, sf, "pages").filter("page_id % 20 = 0 and page_id % 13 <> 5").select(F.concat(F.lit("https://site.test/p/"), page.cast("string")).alias("link"))
    got = readers.crawl(lambda level: level.join(site, "link"), seeds, "https://site.test/", ~F.col("link").rlike("7$"), max_rounds=5)
    return got.select("link", "depth")
