"""Records, payloads, sources and sinks: each query with its SQL equivalent."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from corpusloom.functions import text as X
from corpusloom.operators import filters, records as P, relational as R, validate
from corpusloom.plans.base import Registry
from corpusloom.session import shared_dir, table
from corpusloom.sources import byte_ranges, ordered, readers, sinks, versions

Q = Registry()


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/out/{name}-{uuid.uuid4().hex}"


_CASE = """select doc_id as id, lang as name, cast(null as varchar) as abbr, case when doc_id % 2 = 0 then source else '' end as slug, doc_id % 7 as cid, case when doc_id % 3 = 0 then 'App. Ct.' else '' end as ca, source as cn,
 [cast(doc_id % 90 as varchar) || ' U.S. 5', case when doc_id % 5 = 0 then '' else cast(doc_id % 500 as varchar) || [' Ill. App. 3d ', ' Ill. 2d ', ' Ill. ', ' N.E. '][doc_id % 4 + 1] || '7' end] as cites, text from documents"""


def _cases(spark, sf):
    d = table(spark, sf, "documents")
    n = lambda k: F.col("doc_id") % k
    kind = F.element_at(F.array(*[F.lit(x) for x in (" Ill. App. 3d ", " Ill. 2d ", " Ill. ", " N.E. ")]), (n(4) + 1).cast("int"))
    cites = F.array(
        F.struct(F.concat(n(90).cast("string"), F.lit(" U.S. 5")).alias("cite")),
        F.struct(F.when(n(5) == 0, "").otherwise(F.concat(n(500).cast("string"), kind, F.lit("7"))).alias("cite")),
    )
    court = F.struct(F.when(n(2) == 0, F.col("source")).otherwise("").alias("slug"), n(7).alias("id"), F.col("source").alias("name"), F.when(n(3) == 0, "App. Ct.").otherwise("").alias("name_abbreviation"))
    none = F.lit(None).cast("string")
    return d.select(F.col("doc_id").alias("id"), F.col("lang").alias("name"), none.alias("name_abbreviation"), court.alias("court"), none.alias("decision_date"), cites.alias("citations"), none.alias("docket_number"), none.alias("frontend_url"), F.col("lang").alias("url"), "text")


@Q(f"""with c as ({_CASE}), k as (select *, list_filter(cites, lambda x: x <> '') as cs from c where trim(coalesce(text, '')) <> '')
select 'cap-' || id as id, coalesce(name, '') as case_name, coalesce(abbr, '') as case_name_abbr, coalesce(nullif(ca, ''), nullif(cn, ''), '') as court, coalesce(nullif(slug, ''), cast(cid as varchar)) as court_id,
 array_to_string(cs, ';') as citations, case when len(cs) < 2 then null when cs[2] like '% Ill. App. 3d %' then 'ill-app-3d' when cs[2] like '% Ill. 2d %' then 'ill-2d' when cs[2] like '% Ill. %' then 'ill' end as reporter, coalesce(name, '') as url from k""")
def case_records(spark, sf):
    """P1, P3, P18."""
    out = P.case_records(_cases(spark, sf))
    return out.select("id", "case_name", "case_name_abbr", "court", "court_id", F.array_join("citations", ";").alias("citations"), "reporter", "url")


@Q("select doc_id, case when doc_id % 3 = 0 or coalesce(text, '') = '' then trim(coalesce(lang, '') || ' ' || coalesce(source, '')) else text end as text from documents")
def text_fallback(spark, sf):
    """P4."""
    plain = F.when(F.col("doc_id") % 3 != 0, F.col("text"))
    html = F.concat(F.lit("<script>x</script><b>"), F.coalesce("lang", F.lit("")), F.lit("</b> <i>"), F.coalesce("source", F.lit("")), F.lit("</i>"))
    return table(spark, sf, "documents").select("doc_id", P.text_or_html(plain, html).alias("text"))


_META = ["case_name", "date_filed", "court_label", "section_heading"]


def _chunks(spark, sf):
    d = table(spark, sf, "documents")
    flat = d.select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("chunk_id"), F.concat(F.lit("o"), F.col("doc_id").cast("string")).alias("opinion_id"), (F.col("doc_id") % 9).cast("int").alias("chunk_index"), F.col("n_chars").cast("int").alias("token_count"),
        F.when(F.col("doc_id") % 4 != 0, F.col("source")).alias("case_name"), F.when(F.col("doc_id") % 5 != 0, F.lit("2019-05-04")).otherwise("").alias("date_filed"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("scotus")).alias("court_label"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("section_heading"), "text",
    )
    return P.normalised(flat, _META)


_NORMAL = """select 'c' || doc_id as chunk_id, 'o' || doc_id as parent_id, cast(doc_id % 9 as int) as chunk_index, case when doc_id % 4 <> 0 then source else '' end as cn, case when doc_id % 5 <> 0 then '2019' else '' end as yr,
 case when doc_id % 3 = 0 then 'scotus' else 'ca7' end as cl, case when doc_id % 2 = 0 then lang else '' end as sh, coalesce(text, '') as text from documents"""
_CHUNKS = f"""n as ({_NORMAL}), k as (select *, case when cn <> '' then cn || ' (' || yr || ')' else '' end as display_citation,
 case when cn <> '' then '[' || cl || ' | ' || cn || ' (' || yr || ')]' else '[' || cl || ']' end || case when sh <> '' then chr(10) || '[' || sh || ']' else '' end || chr(10) || chr(10) || text as enriched_text from n)"""


@Q(f"with {_CHUNKS} select chunk_id, parent_id, chunk_index, display_citation, md5(enriched_text) as enriched_md5, nullif(cn, '') as case_name from k")
def chunk_normalise(spark, sf):
    """P8."""
    return _chunks(spark, sf).select("chunk_id", "parent_id", "chunk_index", "display_citation", F.md5("enriched_text").alias("enriched_md5"), F.col("metadata")["case_name"].alias("case_name"))


@Q(f"with {_CHUNKS} select chunk_id, parent_id, 'courtlistener' as source, substr(replace(text, chr(0), ''), 1, 2000) as text, substr(replace(enriched_text, chr(0), ''), 1, 2000) as enriched_text, nullif(cn, '') as case_name, nullif(sh, '') as section_heading from k")
def payload_projection(spark, sf):
    """P9."""
    return P.payload(_chunks(spark, sf), ["chunk_id", "parent_id", "source", "text", "enriched_text"], ["case_name", "section_heading"])


@Q(f"""with {_CHUNKS} select chunk_id, key, value from (select chunk_id, unnest([struct_pack(key := 'parent_id', value := parent_id), struct_pack(key := 'chunk_index', value := cast(chunk_index as varchar)),
 struct_pack(key := 'display_citation', value := display_citation), struct_pack(key := 'case_name', value := nullif(cn, '')), struct_pack(key := 'section_heading', value := nullif(sh, ''))], recursive := true) from k) where value is not null""")
def metadata_flatten(spark, sf):
    """P12."""
    rows = _chunks(spark, sf).select("chunk_id", "text", "enriched_text", "parent_id", "chunk_index", "display_citation", F.map_filter("metadata", lambda k, v: k.isin("case_name", "section_heading") & v.isNotNull()).alias("metadata"))
    return P.flat_metadata(rows).select("chunk_id", F.explode("metadata"))


@Q("""with s as (select doc_id, coalesce(source, '') || ' ' || coalesce(lang, '') as h, coalesce(lang, '') as c, [coalesce(text, ''), '(a) ' || coalesce(text, ''), ' (1) short', 'plain'] as segs from documents),
e as (select doc_id, h, c, unnest(segs) as seg, generate_subscripts(segs, 1) as i from s)
select doc_id, cast(i - 1 as int) as pos, md5(case when i > 1 and regexp_matches(seg, '^\\s*\\([a-z0-9]\\)') then case when length(h || chr(10) || seg) <= 1500 then h || chr(10) || seg when c <> '' then '[' || c || ']' || chr(10) || substr(seg, 1, 1500 - length('[' || c || ']' || chr(10))) else seg end else seg end) as segment_md5 from e""")
def orphan_prefix(spark, sf):
    """T31."""
    text, lang = F.coalesce("text", F.lit("")), F.coalesce("lang", F.lit(""))
    segments = F.array(text, F.concat(F.lit("(a) "), text), F.lit(" (1) short"), F.lit("plain"))
    out = P.with_context(segments, F.concat(F.coalesce("source", F.lit("")), F.lit(" "), lang), lang)
    return table(spark, sf, "documents").select("doc_id", F.posexplode(out).alias("pos", "s")).select("doc_id", "pos", F.md5("s").alias("segment_md5"))


@Q("""select page_id, not regexp_matches(url, '(?i)meeting.agenda|meeting.minutes|agenda.final|minutes.final') as file_ok, regexp_matches(cast(page_id as varchar), '^\\d+$') as id_ok, regexp_matches(url, '^\\d+$') as url_numeric,
 not regexp_matches(coalesce(url, ''), '(?i)\\(Repealed\\)') as in_force, [' mental health ', 'FIELD OPERATIONS', 'budget'][page_id % 3 + 1] <> 'budget' as category_ok, ['ca7', 'ca8', ''][page_id % 3 + 1] = 'ca7' as court_ok from pages""")
def name_filters(spark, sf):
    """F9, F10, F12, F17, F18."""
    pick = lambda *v: F.element_at(F.array(*[F.lit(x) for x in v]), (F.col("page_id") % 3 + 1).cast("int"))
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", filters.wanted_file(url).alias("file_ok"), filters.numeric_id(F.col("page_id").cast("string")).alias("id_ok"), filters.numeric_id(url).alias("url_numeric"),
        filters.not_repealed(url).alias("in_force"), P.wanted_category(pick(" mental health ", "FIELD OPERATIONS", "budget")).alias("category_ok"), P.in_courts(pick("ca7", "ca8", "")).alias("court_ok"))


@Q("""select o_custkey, o_orderkey, last_value(case when o_orderkey % 3 = 1 then o_totalprice end ignore nulls) over (partition by o_custkey order by o_orderkey) as price from orders""")
def forward_fill(spark, sf):
    """W5."""
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 3 == 1, F.col("o_totalprice")).alias("price"))
    return R.fill_forward(rows, "o_custkey", "o_orderkey", ["price"])


@Q("select count(*) as n from (select 1 from documents where length(coalesce(text, '')) < 5 limit 3)")
def leak_check(spark, sf):
    """V5: at most three rows that break the rule are looked at."""
    return validate.leaks(table(spark, sf, "documents"), F.length(F.coalesce("text", F.lit(""))) >= 5).agg(F.count("*").alias("n"))


_DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())])


@Q("select doc_id, text, source from documents")
def jsonl_round_trip(spark, sf):
    """Written, found and read."""
    path = _folder(spark, "jsonl")
    sinks.write_jsonl(table(spark, sf, "documents").select("doc_id", "text", "source"), path)
    assert readers.exists(spark, path)
    return readers.read_jsonl(spark, path, _DOC)


@Q("select doc_id, text, source from documents")
def jsonl_strict(spark, sf):
    """S2."""
    path = _folder(spark, "jsonl")
    sinks.write_jsonl(table(spark, sf, "documents").select("doc_id", "text", "source"), path)
    return readers.read_jsonl(spark, path, _DOC, strict=True)


_PAGE = T.StructType([T.StructField("page_id", T.StringType()), T.StructField("url", T.StringType())])


def _csv(spark, sf, compression):
    path = _folder(spark, "csv")
    sinks.write_csv(table(spark, sf, "pages").filter("url is not null"), path, ["page_id", "url"], compression)
    return readers.read_csv(spark, path, _PAGE)


@Q("select cast(page_id as varchar) as page_id, url from pages where url is not null")
def csv_round_trip(spark, sf):
    """S3, K3."""
    return _csv(spark, sf, "none")


@Q("select cast(page_id as varchar) as page_id, url from pages where url is not null")
def csv_bz2_round_trip(spark, sf):
    """S4."""
    return _csv(spark, sf, "bzip2")


@Q("select doc_id, source from documents where text is not null")
def checked_replace(spark, sf):
    """K7, S10."""
    path = _folder(spark, "checked")
    kept = readers.table_text(table(spark, sf, "documents")).select("doc_id", "source")
    sinks.write_checked(kept, path, {"rows": lambda df: not df.isEmpty()})
    return spark.read.parquet(path)


@Q("select source as stage, count(*) as n_queries, round(avg(n_chars), 6) as avg_chars from documents group by source")
def report_json(spark, sf):
    """K8."""
    path = _folder(spark, "report")
    sinks.write_report(table(spark, sf, "documents").select(F.col("source").alias("stage"), F.col("doc_id").alias("id"), F.lit("").alias("query"), "n_chars"), path)
    return spark.read.json(path).select("stage", "n_queries", F.round("averages.n_chars", 6).alias("avg_chars"))


@Q("select c_name as query, c_mktsegment as positive, c_mktsegment as negative, c_custkey as positive_chunk_id, c_nationkey as negative_chunk_id from customer")
def triplet_jsonl(spark, sf):
    """K9."""
    path = _folder(spark, "triplets")
    c = table(spark, sf, "customer")
    sinks.write_triplets(c.select(F.col("c_name").alias("query"), F.col("c_mktsegment").alias("positive"), F.col("c_mktsegment").alias("negative"), F.col("c_custkey").alias("positive_chunk_id"), F.col("c_nationkey").alias("negative_chunk_id"), F.lit(0.5).alias("negative_score")), path)
    return spark.read.json(path).drop("negative_score")


@Q("select doc_id, source as title, 'f' || doc_id || '.pdf' as path, lang as category, 'MENTAL HEALTH' as sub_category from documents")
def manifest_rows(spark, sf):
    """One manifest line a document."""
    d = table(spark, sf, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("t"), F.coalesce("lang", F.lit("")).alias("l"))
    name = F.concat(F.lit("f"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    raw = d.select(F.to_json(F.array(F.array(F.to_json(F.array("t", name, F.lit("y"))), F.col("l"), F.lit("MENTAL HEALTH")))).alias("raw"))
    found = readers.manifest(raw)
    return found.select(F.regexp_extract("path", r"f(\d+)", 1).cast("long").alias("doc_id"), "title", "path", "category", "sub_category")


@Q("select doc_id, count(*) as n_pages, coalesce(string_agg('[PAGE ' || p || ']' || chr(10) || b, chr(10) || chr(10) order by p), '') as text from (select doc_id, p, trim([source, lang, ''][p]) as b from documents, range(1, 4) r(p)) where b <> '' group by doc_id")
def page_join(spark, sf):
    """S6."""
    d = table(spark, sf, "documents").select("doc_id", F.posexplode(F.array("source", "lang", F.lit(""))).alias("i", "text")).withColumn("page", F.col("i") + 1)
    n = d.filter(F.trim("text") != "").groupBy("doc_id").agg(F.count("*").alias("n_pages"))
    return readers.join_pages(d, "doc_id", markers=True).join(n, "doc_id")


@Q("select doc_id, case when strpos(text, 'e') > 0 then substr(text, strpos(text, 'e')) else text end as text, case when strpos(text, 'zz') > 0 then rtrim(substr(text, 1, strpos(text, 'zz') - 1), ' ') else rtrim(text, ' ') end as before_zz from documents")
def boilerplate_cuts(spark, sf):
    """T5, T8."""
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.trim_boilerplate(F.col("text"), "e").alias("text"), X.cut_at_first(F.col("text"), ["zz"]).alias("before_zz"))


@Q("select event_id, ts, user_id, event_type, value from (select *, row_number() over (partition by user_id, event_type order by src desc, event_id desc) as rn from (select *, cast(event_id % 3 = 0 as int) as src from events)) where rn = 1")
def bucket_upsert(spark, sf):
    """K4, K5: a table in hash buckets takes in new rows; only their buckets are rewritten."""
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    rows = versions.BucketTable(spark, f"{shared_dir(spark)}/bucket-upsert-{uuid.uuid4().hex}", ["user_id", "event_type"], buckets=16)
    rows.upsert(e.filter("event_id % 3 <> 0"), "event_id")
    rows.upsert(e.filter("event_id % 3 = 0"), "event_id")
    return rows.read()


@Q("select doc_id, md5(text) as text_md5, doc_id % 3 as batch_id from documents")
def resumable_append(spark, sf):
    """K2: batches that overlap, one of them sent twice; each key is appended once, with the first batch that holds it."""
    docs = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("text_md5"), F.lit(0).alias("seq"))
    log = versions.AppendLog(spark, f"{shared_dir(spark)}/append-{uuid.uuid4().hex}", "doc_id")
    for batch in (0, 1, 1, 2):
        log.append(batch, docs.filter(F.col("doc_id") % 3 <= batch))
    return log.read().select("doc_id", "text_md5", "batch_id")


@Q("""select lang, min(doc_id) as first_id, max(doc_id) as last_id, min(seq) as first_seq, max(seq) as last_seq from (select doc_id, lang, row_number() over (order by doc_id) - 1 as seq from documents) group by lang""")
def input_order(spark, sf):
    """First and last wins by the place in JSON files that were written in order of the id."""
    path = f"{shared_dir(spark)}/input-order-{uuid.uuid4().hex}"
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.json(path)
    rows = ordered.read_ordered(spark, path, schema="doc_id long, lang string, text string").select("doc_id", "lang", "seq")
    last = R.last_wins(rows, ["lang"]).select("lang", F.col("doc_id").alias("last_id"), F.col("seq").alias("last_seq"))
    first = R.first_by(rows, ["lang"], F.col("seq").asc()).select("lang", F.col("doc_id").alias("first_id"), F.col("seq").alias("first_seq"))
    return first.join(last, "lang").select("lang", "first_id", "last_id", "first_seq", "last_seq")


@Q()
def byte_range_sample(spark, sf):
    """A sampling operator; records from five byte ranges of each of the files that hold the documents."""
    path = f"{shared_dir(spark)}/byte-ranges-{uuid.uuid4().hex}"
    table(spark, sf, "documents").select("doc_id", "lang", "text").write.json(path)
    return byte_ranges.sample_records(spark, path, "doc_id long, lang string, text string", "doc_id", 5, 1 << 16).select("doc_id", "lang", F.length("text").alias("n_chars"))
