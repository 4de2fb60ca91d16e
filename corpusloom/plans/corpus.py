"""Scans, profiles, cleaning, segmentation and chunking over the text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import bpe, folds, text as X
from corpusloom.operators import chunkers, filters, relational as R, validate
from corpusloom.plans.base import Registry
from corpusloom.session import table
from corpusloom.sources import readers

Q = Registry()


@Q("""select source, count(*) as n, count(*) filter (where trim(text) <> '') as with_text, min(length(text)) as shortest, max(length(text)) as longest,
 sum(n_chars) as chars, count(distinct lang) as langs from documents group by source""")
def scan_profile(spark, sf):
    """S10, A2, A6, A13, A17."""
    return table(spark, sf, "documents").groupBy("source").agg(
        F.count("*").alias("n"), F.count_if(F.trim("text") != "").alias("with_text"), F.min(F.length("text")).alias("shortest"), F.max(F.length("text")).alias("longest"),
        F.sum("n_chars").alias("chars"), F.count_distinct("lang").alias("langs"))


@Q("""with c as (select count(*) as n_rows, count(*) filter (where coalesce(trim(text), '') = '') as empty_text,
 count(*) filter (where coalesce(trim(text), '') <> '' and length(text) < 100) as stubs, count(distinct source) as n_sources, count(*) filter (where doc_id is null) as missing_id from documents),
d as (select count(*) as duplicate_ids, cast(coalesce(sum(n - 1), 0) as bigint) as extra_rows from (select doc_id, count(*) as n from documents group by 1 having count(*) > 1))
select *, case when n_rows < 200 or n_rows = 0 or duplicate_ids > 0 or empty_text > 0 then 'fail' when stubs * 1.0 / n_rows > 0.2 or n_sources > 3 then 'warn' else 'ok' end as status from c, d""")
def validate_corpus(spark, sf):
    """V1 to V4, A5."""
    return validate.verdict(validate.profile(table(spark, sf, "documents"), "doc_id"), 200)


@Q("""select event_id, list_sort(list_filter(['device', 'page', 'k', 'source'], lambda x: not list_contains(json_keys(props), x))) as missing from events""")
def required_fields(spark, sf):
    """U3, V2."""
    raw = table(spark, sf, "events").select("event_id", F.col("props").alias("raw"))
    return validate.missing_fields(raw, ("device", "page", "k", "source")).select("event_id", F.array_sort("missing").alias("missing"))


@Q("""select p_partkey, chapter, citation from (select p_partkey, cast(p_size * 5 as varchar) as chapter, cast(p_size * 5 as varchar) || ' ILCS ' || cast(p_partkey * 5 as varchar) || '/1' as citation from part)
where chapter in ('20','50','225','325','410','430','625','705','720','725','730','735','750','775')
and not (chapter = '20' and (starts_with(citation, '20 ILCS 605') or starts_with(citation, '20 ILCS 1205') or starts_with(citation, '20 ILCS 1370') or starts_with(citation, '20 ILCS 1605') or starts_with(citation, '20 ILCS 2505') or starts_with(citation, '20 ILCS 3205')))""")
def scope_filter(spark, sf):
    """F1."""
    chapter = (F.col("p_size") * 5).cast("string")
    df = table(spark, sf, "part").select("p_partkey", chapter.alias("chapter"), F.concat(chapter, F.lit(" ILCS "), (F.col("p_partkey") * 5).cast("string"), F.lit("/1")).alias("citation"))
    return df.filter(filters.statute_scope(F.col("chapter"), F.col("citation")))


@Q("""select o_orderkey, d, name, ((d = '' or d >= '1996-01-01') and (regexp_matches(name, '(?i)\\bPeople\\b|^In re\\b') or regexp_matches(name, '\\b(705|720|725|730)\\s+ILCS\\b'))) as opinion_scope,
 (d <> '' and d >= '1996') as dated, (d = '' or (d >= '1995-01-01' and d <= '1997-12-31')) as in_range
from (select o_orderkey, case when o_orderkey % 7 = 0 then '' else strftime(o_orderdate, '%Y-%m-%d') end as d,
 case o_custkey % 4 when 0 then 'People v. Smith' when 1 then 'In re Jones' when 2 then 'Doe v. 720 ILCS 5' else 'Roe v. Wade' end as name from orders)""")
def opinion_filters(spark, sf):
    """F2 to F5."""
    k = F.col("o_custkey") % 4
    name = F.when(k == 0, "People v. Smith").when(k == 1, "In re Jones").when(k == 2, "Doe v. 720 ILCS 5").otherwise("Roe v. Wade")
    df = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d"), name.alias("name"))
    d, n = F.col("d"), F.col("name")
    return df.select("*", filters.opinion_scope(d, n, n, "1996-01-01").alias("opinion_scope"), filters.dated_from(d, "1996").alias("dated"), filters.in_dates(d, "1995-01-01", "1997-12-31").alias("in_range"))


@Q("""with t as (select doc_id, text, len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]')) as tokens from documents),
m as (select doc_id, tokens, cast(regexp_matches(text, '(?m)^\\s*-\\s*\\d+\\s*-\\s*$') as int) + cast(regexp_matches(text, '\\x0c') as int) + cast(regexp_matches(text, '(?mi)^\\s*(?:FIRST|SECOND|THIRD|FOURTH|FIFTH|SIXTH)\\s+DISTRICT\\s*$') as int)
 + cast(regexp_matches(text, '(?mi)^\\s*(?:ILLINOIS\\s+)?SUPREME\\s+COURT\\s*$') as int) + cast(regexp_matches(text, 'v\\.\\s{2,}[\\)|\\|]') as int) + cast(regexp_matches(text, '\\bNos?\\.\\s+\\d+[-\\w]+') as int)
 + cast(regexp_matches(text, '(?mi)^\\s*NOTICE\\s*$') as int) + cast(regexp_matches(text, '(?i)Order filed|Decision filed') as int) + cast(regexp_matches(text, '(?i)This order was filed under|Rule 23') as int)
 + cast(regexp_matches(text, '(?m)^\\s*_{5,}\\s*$') as int) + cast(regexp_matches(text, '(?m)^\\s*Nos?\\.\\s+\\d') as int) as marks from t)
select doc_id, tokens, tokens <= 150 and marks >= case when tokens < 60 then 1 else 2 end as noise, tokens >= 50 as large_enough from m""")
def noise_filter(spark, sf):
    """F6, F7, T14."""
    df = table(spark, sf, "documents").select("doc_id", "text", X.token_count(F.col("text")).alias("tokens"))
    return df.select("doc_id", "tokens", filters.noise(F.col("text"), F.col("tokens")).alias("noise"), (F.col("tokens") >= 50).alias("large_enough"))


@Q("""select page_id, contains(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1), 'example.com') and not ends_with(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '.pdf')
 and not regexp_matches(coalesce(nullif(rtrim(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/'), ''), '/'), '/locations|/careers|/news|/about|/contact|/search|^/$') as wanted,
 case when regexp_matches(url, '/fr/') then 'french' when regexp_matches(url, '/(de|es)/') then 'other' when regexp_matches(url, 'blog') then 'blog' else 'english' end as category,
 substr(regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80) as slug from pages""")
def url_rules(spark, sf):
    """F11, P16, P17."""
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", filters.wanted_url(url, "example.com").alias("wanted"), X.first_match(url, [("/fr/", "french"), ("/(de|es)/", "other"), ("blog", "blog")], "english").alias("category"), X.slug(url).alias("slug"))


@Q("""select page_id, sha256(t) as digest, length(t) as n, length(t) >= 200 as kept from (select page_id,
 regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
 '(?is)<script\\b[^>]*>.*?</script\\s*>', '', 'g'), '(?is)<style\\b[^>]*>.*?</style\\s*>', '', 'g'), '(?is)<nav\\b[^>]*>.*?</nav\\s*>', '', 'g'), '(?is)<header\\b[^>]*>.*?</header\\s*>', '', 'g'), '(?is)<footer\\b[^>]*>.*?</footer\\s*>', '', 'g'), '(?is)<noscript\\b[^>]*>.*?</noscript\\s*>', '', 'g'),
 '(?is)<!--.*?-->', '', 'g'), '(?i)<(p|br|div|h[1-6]|li|tr)\\b[^>]*>', chr(10), 'g'), '(?s)<[^>]+>', '', 'g'),
 '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \\t]+', ' ', 'g'), '\\s*\\n\\s*\\n\\s*', chr(10) || chr(10), 'g'), '^[\\s\\x{A0}]+|[\\s\\x{A0}]+\\z', '', 'g') as t from pages)""")
def strip_html(spark, sf):
    """T7, F13."""
    df = table(spark, sf, "pages").select("page_id", X.strip_html(F.col("html")).alias("t"))
    return df.select("page_id", F.sha2("t", 256).alias("digest"), F.length("t").alias("n"), (F.length("t") >= 200).alias("kept"))


@Q("""with h as (select page_id, regexp_extract_all(html, '(?i)href="([^"#?]+)', 1) as hs from pages)
select page_id, list_transform(hs, lambda h: regexp_replace(case when regexp_matches(h, '^https?://') then h when starts_with(h, '//') then 'https:' || h when starts_with(h, '/') then 'https://www.example.com' || h else 'https://www.example.com/' || h end, '/+$', '')) as raw from h""".replace("as raw from h", "as all_links from h"))
def link_discovery(spark, sf):
    """T11, T13 before distinct."""
    hrefs = F.regexp_extract_all("html", F.lit(r'(?i)href="([^"#?]+)'), F.lit(1))
    full = lambda h: F.regexp_replace(F.when(h.rlike("^https?://"), h).when(h.startswith("//"), F.concat(F.lit("https:"), h)).when(h.startswith("/"), F.concat(F.lit("https://www.example.com"), h)).otherwise(F.concat(F.lit("https://www.example.com/"), h)), "/+$", "")
    return table(spark, sf, "pages").select("page_id", F.transform(hrefs, full).alias("all_links"))


@Q("""with h as (select distinct regexp_replace(case when regexp_matches(h, '^https?://') then h when starts_with(h, '//') then 'https:' || h when starts_with(h, '/') then 'https://www.example.com' || h else 'https://www.example.com/' || h end, '/+$', '') as link
 from (select unnest(regexp_extract_all(html, '(?i)href="([^"#?]+)', 1)) as h from pages))
select link from h where link not in (select regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') from pages where url is not null)""")
def crawl_frontier(spark, sf):
    """S7, T13, J4."""
    return readers.frontier(table(spark, sf, "pages"), "url", "html", "https://www.example.com/")


@Q("""select doc_id, sha256(array_to_string(list_filter(string_split(text, chr(10)), lambda l: not (regexp_matches(l, '\\.{4,}') and (length(l) - length(replace(l, '.', '')) > 0.2 * length(l) or regexp_matches(l, '\\d\\s*$') or regexp_matches(l, '\\.{4,}\\s*$')))), chr(10))) as digest from
 (select doc_id, text || chr(10) || 'Intro ' || repeat('.', doc_id % 9) || ' ' || doc_id || chr(10) || 'tail' as text from documents)""")
def toc_strip(spark, sf):
    """T4."""
    nl = F.lit("\n")
    text = F.concat("text", nl, F.lit("Intro "), F.expr("repeat('.', int(doc_id % 9))"), F.lit(" "), F.col("doc_id").cast("string"), nl, F.lit("tail"))
    return table(spark, sf, "documents").select("doc_id", F.sha2(X.strip_toc(text), 256).alias("digest"))


@Q("""select doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '\\r\\n?', chr(10), 'g'), '[ \\t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), '^[\\s\\x{A0}]+|[\\s\\x{A0}]+\\z', '', 'g')) as statute,
 sha256(regexp_replace(regexp_replace(t, '\\s+', ' ', 'g'), '^[\\s\\x{A0}]+|[\\s\\x{A0}]+\\z', '', 'g')) as heading,
 sha256(regexp_replace(regexp_replace(t, '(?i)[^\\n]*\\bpage \\d+ of \\d+\\b[^\\n]*\\n?', '', 'g'), '^[\\s\\x{A0}]+|[\\s\\x{A0}]+\\z', '', 'g')) as headers,
 sha256(substr(t, 1, 2000)) as clipped from (select doc_id, ' Page ' || doc_id || ' of 9' || chr(13) || chr(10) || chr(10) || chr(10) || text || '  ' as t from documents)""")
def text_cleaning(spark, sf):
    """T1, T3, P10, P11."""
    t = F.concat(F.lit(" Page "), F.col("doc_id").cast("string"), F.lit(" of 9\r\n\n\n"), F.col("text"), F.lit("  "))
    return table(spark, sf, "documents").select(
        "doc_id", F.sha2(X.clean_statute(t), 256).alias("statute"), F.sha2(X.clean_heading(t), 256).alias("heading"), F.sha2(X.strip_page_headers(t), 256).alias("headers"), F.sha2(X.clip(t), 256).alias("clipped"))


@Q("""with s as (select doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') as s from documents)
select doc_id, len(s) as n, sha256(array_to_string(s, chr(1))) as digest from s""")
def sentence_split(spark, sf):
    """T16."""
    df = table(spark, sf, "documents").select("doc_id", X.sentences(F.col("text")).alias("s"))
    return df.select("doc_id", F.size("s").alias("n"), F.sha2(F.array_join("s", "\x01"), 256).alias("digest"))


@Q("""with t as (select doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') as t from documents),
n as (select doc_id, t, len(t) as n, case when len(t) <= 100 then 1 else 1 + cast(ceil((len(t) - 100) / 80.0) as int) end as c from t),
w as (select doc_id, t, i from n, range(0, 100000) r(i) where i < c and n > 0)
select doc_id, i as idx, least(100, len(t) - i * 80) as n_words, sha256(array_to_string(t[i * 80 + 1 : i * 80 + 100], ' ')) as digest from w""")
def window_tokens(spark, sf):
    """T15."""
    df = table(spark, sf, "documents").select("doc_id", F.posexplode(X.token_windows(F.col("text"), 100, 20)).alias("idx", "w"))
    return df.select("doc_id", F.col("idx").cast("long").alias("idx"), F.size(F.split("w", " ")).cast("long").alias("n_words"), F.sha2("w", 256).alias("digest"))


@Q("""with l as (select doc_id, unnest(string_split(t, chr(10))) as line, generate_subscripts(string_split(t, chr(10)), 1) as pos from (select doc_id, text || chr(10) || 'FINAL REPORT AND FINDINGS' || chr(10) || 'done ' || doc_id as t from documents)),
h as (select *, regexp_matches(trim(line), '^[A-Z][A-Z0-9\\s()\\-/,]{3,59}$') and len(regexp_split_to_array(trim(line), '\\s+')) >= 3 as is_h from l),
s as (select *, sum(cast(is_h as int)) over (partition by doc_id order by pos rows unbounded preceding) as section from h)
select doc_id, cast(section as bigint) as section, max(case when is_h then trim(line) end) as heading, count(*) as n_lines, sum(length(line)) as chars from s group by doc_id, section""")
def line_sections(spark, sf):
    """T21, W6."""
    t = F.concat("text", F.lit("\nFINAL REPORT AND FINDINGS\ndone "), F.col("doc_id").cast("string"))
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split(t, "\n")).alias("pos", "line"))
    lines = R.heading_sections(lines.withColumn("is_h", X.is_heading(F.col("line"))), "doc_id", "pos", F.col("is_h"))
    return lines.groupBy("doc_id", "section").agg(F.max(F.when(F.col("is_h"), F.trim("line"))).alias("heading"), F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("chars"))


@Q("""with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents)
select doc_id, cast(row_number() over (partition by doc_id order by pos) - 1 as bigint) as chunk_index, count(*) over (partition by doc_id) as chunk_total, substr(sha256(concat_ws(chr(31), cast(doc_id as varchar), line)), 1, 16) as chunk_id from l where length(line) >= 40""")
def chunk_numbering(spark, sf):
    """T36, W2, P16."""
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).filter(F.length("line") >= 40)
    out = R.numbered(lines, ["doc_id"], F.col("pos"))
    return out.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), "chunk_total", X.short_id(F.col("doc_id").cast("string"), F.col("line")).alias("chunk_id"))


@Q("""with t as (select doc_id, text || ' See Rule 401, 402 and 403; Section 12A & 7. Amended May ' || (1 + doc_id % 28) || ', 1999, eff. now.' as t from documents)
select doc_id, list_sort(list_distinct(flatten(list_transform(regexp_extract_all(t, '(?i)\\b(?:Rules?|Section|§)\\s+(\\d{1,4}[A-Z]?(?:\\s*(?:,|and|&)\\s*\\d{1,4}[A-Z]?)*)', 1), lambda g: regexp_extract_all(g, '\\d{1,4}[A-Z]?'))))) as refs,
 nullif(trim(regexp_extract(t, '(?s)(?:Amended|Adopted|Effective)\\s+[A-Za-z]+\\s+\\d{1,2},\\s+\\d{4}', 0)), '') as amended from t""")
def references(spark, sf):
    """T34, T35."""
    t = F.concat("text", F.lit(" See Rule 401, 402 and 403; Section 12A & 7. Amended May "), (1 + F.col("doc_id") % 28).cast("string"), F.lit(", 1999, eff. now."))
    return table(spark, sf, "documents").select("doc_id", X.cross_references(t).alias("refs"), F.substring_index(F.regexp_extract(X.amendment_history(t), r"^(\w+\s+[A-Za-z]+\s+\d{1,2},\s+\d{4})", 1), "\n\n\n", 1).alias("amended"))


@Q("""with recursive p as (select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') as parts from documents),
f as (select doc_id, parts, 1 as i, parts[1] as cur, [] :: varchar[] as done from p where len(parts) > 0
 union all select doc_id, parts, i + 1, case when length(cur) + 1 + length(parts[i + 1]) <= 1500 then cur || chr(10) || parts[i + 1] else parts[i + 1] end, case when length(cur) + 1 + length(parts[i + 1]) <= 1500 then done else list_append(done, cur) end from f where i < len(parts))
select doc_id, len(done) + 1 as n, sha256(array_to_string(list_append(done, cur), chr(1))) as digest from f where i = len(parts)""")
def pack_fold(spark, sf):
    """T26."""
    packed = folds.over_column(lambda t: folds.pack([p for x in t.split("\n") if (p := x.strip(" "))]))
    df = table(spark, sf, "documents").select("doc_id", packed("text").alias("p")).filter(F.size("p") > 0)
    return df.select("doc_id", F.size("p").alias("n"), F.sha2(F.array_join("p", "\x01"), 256).alias("digest"))


@Q(r"""with t as (select doc_id, string_split(replace(replace(coalesce(text, ''), '. ', '.' || chr(10) || '(a) '), ', ', ',' || chr(10) || ' '), chr(10)) as raw from documents),
l as (select doc_id, list_transform(raw, lambda x: trim(x, ' ')) as ls from t),
j as (select doc_id, list_reduce(ls, lambda a, x: case when x = '' or a = '' or ends_with(a, chr(10)) or regexp_matches(x, '^\s*(\([a-z0-9]+\)|[a-z]\)|Section\s|AGENCY|SOURCE|\d+\.)') then a || chr(10) || x else a || ' ' || x end) as text from l)
select doc_id, md5(text) as joined_md5, len(string_split(text, chr(10))) as n_lines from j""")
def wrapped_lines(spark, sf):
    """Lines broken at commas join again, sentences that open with a mark keep their lines."""
    text = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit(". "), F.lit(".\n(a) ")), F.lit(", "), F.lit(",\n "))
    joined = table(spark, sf, "documents").select("doc_id", X.collapse_wraps(text).alias("t"))
    return joined.select("doc_id", F.md5("t").alias("joined_md5"), F.size(F.split("t", "\n")).cast("long").alias("n_lines"))


@Q("""select doc_id, md5(trim(regexp_replace(replace(replace(replace(coalesce(text, ''), ', ', chr(10) || chr(10) || chr(10) || chr(10)), '. ', '.' || chr(160)), chr(160), ' '), chr(10) || '{3,}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) as text_md5 from documents""")
def blank_lines(spark, sf):
    """T6."""
    text = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit(", "), F.lit("\n\n\n\n")), F.lit(". "), F.lit(".\u00a0"))
    return table(spark, sf, "documents").select("doc_id", F.md5(X.collapse_blank_lines(text)).alias("text_md5"))


_SPAN = "coalesce(text, '') || ' see 720 ILCS 5/' || (doc_id % 40) || '-1.5, Rule ' || (doc_id % 900) || case when doc_id % 2 = 0 then 'A' else '' end || ' and [19' || lpad(cast(doc_id % 100 as varchar), 2, '0') || '] UKHL ' || doc_id"


@Q(f"""select doc_id, md5(regexp_replace({_SPAN}, '(\\d+ ILCS \\d+/[\\d\\-.]+|Rule \\d+[A-Z]?|\\[\\d{{4}}\\] [A-Z]+ \\d+)', '<span class="cite">\\1</span>', 'g')) as html_md5 from documents""")
def cited_spans(spark, sf):
    """P21."""
    n = F.col("doc_id")
    text = F.concat(
        F.coalesce("text", F.lit("")), F.lit(" see 720 ILCS 5/"), (n % 40).cast("string"), F.lit("-1.5, Rule "), (n % 900).cast("string"), F.when(n % 2 == 0, "A").otherwise(""),
        F.lit(" and [19"), F.lpad((n % 100).cast("string"), 2, "0"), F.lit("] UKHL "), n.cast("string"),
    )
    return table(spark, sf, "documents").select("doc_id", F.md5(X.render_citations(text)).alias("html_md5"))


@Q()
def chunk_policy_reports(spark, sf):
    """T3, T4, T17, T19, T21, T30, T36, T38, D1, P6, P7."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "text", F.col("source").alias("title"), F.lit("").alias("url"), F.col("lang").alias("category"), F.lit("1999").alias("year"), F.col("doc_id").alias("seq"))
    return chunkers.chunk(docs, chunkers.SPECS["policy_reports"], "seq").select("chunk_id", "parent_id", "chunk_index", "chunk_total", "token_count", "display_citation", F.sha2("enriched_text", 256).alias("digest"))


@Q()
def chunk_statutes(spark, sf):
    """T1, T25 to T29, T31, T38."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "text", F.col("source").alias("act_name"), F.col("lang").alias("chapter_name"), F.lit("Heading").alias("section_heading"), F.concat(F.lit("720 ILCS 5/"), F.col("doc_id").cast("string")).alias("section_citation"))
    return chunkers.chunk(docs, chunkers.SPECS["statutes"]).select("chunk_id", "parent_id", "chunk_index", "chunk_total", "token_count", "display_citation", F.sha2("enriched_text", 256).alias("digest"))


@Q()
def chunk_opinions(spark, sf):
    """P2, T18, T20, T23, T38, F7."""
    text = F.concat(F.lit("[Majority]\nBACKGROUND\n"), F.col("text"), F.lit("\n[Dissent]\nANALYSIS\n"), F.col("text"))
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), text.alias("text"), F.concat(F.lit("People v. "), F.col("source")).alias("case_name_abbr"), F.lit("1999-01-02").alias("date_decided"), F.lit("ill").alias("court"))
    return chunkers.chunk(docs, chunkers.SPECS["bulk_opinions"]).select("chunk_id", "parent_id", "chunk_index", "chunk_total", "token_count", F.sha2("enriched_text", 256).alias("digest"))


@Q("""with l as (select source, lang, doc_id, length(text) as n from documents) select source, cast(avg(n) as double) as avg_n, min(n) as min_n, max(n) as max_n, count(*) filter (where n >= 1000) as multi, count(*) filter (where n < 1000) as single from l group by source""")
def token_stats(spark, sf):
    """A2, A3."""
    df = table(spark, sf, "documents").select("source", F.length("text").alias("n"))
    return df.groupBy("source").agg(F.avg("n").alias("avg_n"), F.min("n").alias("min_n"), F.max("n").alias("max_n"), F.count_if(F.col("n") >= 1000).alias("multi"), F.count_if(F.col("n") < 1000).alias("single"))


#: A byte-level vocabulary as ranks.
RANKS = "file:///opt/tokenizers/byte_bpe_50k.tiktoken"


@Q()
def bpe_tokens(spark, sf, ranks: str = RANKS):
    """Counted by merge ranks; tested against the library that made them."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return bpe.token_counts(docs, bpe.read_ranks(spark, ranks), "doc_id")
