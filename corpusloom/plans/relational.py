"""Joins, deduplication, merges and upserts over the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import relational as R
from corpusloom.plans.base import Registry
from corpusloom.session import table
from corpusloom.sources import readers, sinks

Q = Registry()
#: Weight of a precedential status and kind of an opinion type.
PRECEDENTIAL = {"Published": 1.0, "Unpublished": 0.5, "Errata": 0.1, "Separate": 0.4, "In-chambers": 0.3, "Relating-to": 0.2, "Unknown": 0.3, "": 0.3}
OPINION_KINDS = {
    "010combined": "combined", "015unamimous": "unanimous", "020lead": "majority", "025plurality": "plurality", "030concurrence": "concurrence", "035concurrence-in-part": "concurrence_in_part",
    "040dissent": "dissent", "050addendum": "addendum", "060remittitur": "remittitur", "070rehearing": "rehearing", "080on-the-merits": "on_the_merits", "090on-motion": "on_motion",
}


def mapped(values: dict, key, default):
    return F.coalesce(F.element_at(F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v))]), key), F.lit(default))


@Q("""with s as (select o_orderkey, case o_orderkey % 5 when 0 then 'Published' when 1 then 'Unpublished' when 2 then 'Errata' when 3 then 'Never heard of' else '' end as st, case o_custkey % 3 when 0 then '020lead' when 1 then '040dissent' else 'x' end as ty from orders)
select o_orderkey, case st when 'Published' then 1.0 when 'Unpublished' then 0.5 when 'Errata' then 0.1 else 0.3 end :: double as weight, case ty when '020lead' then 'majority' when '040dissent' then 'dissent' else ty end as kind, ty = '020lead' as is_majority from s""")
def enum_map(spark, sf):
    """P5."""
    k, j = F.col("o_orderkey") % 5, F.col("o_custkey") % 3
    st = F.when(k == 0, "Published").when(k == 1, "Unpublished").when(k == 2, "Errata").when(k == 3, "Never heard of").otherwise("")
    ty = F.when(j == 0, "020lead").when(j == 1, "040dissent").otherwise("x")
    kinds = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in OPINION_KINDS.items() for x in kv]), F.col("ty")), F.col("ty"))
    df = table(spark, sf, "orders").select("o_orderkey", st.alias("st"), ty.alias("ty"))
    return df.select("o_orderkey", mapped(PRECEDENTIAL, F.col("st"), 0.3).alias("weight"), kinds.alias("kind"), kinds.isin("combined", "unanimous", "majority", "plurality").alias("is_majority"))


@Q("""select o_orderkey, case when c <> '' then c when s <> '' then s when r <> '' then 'Rule ' || r || case when t <> '' then ' — ' || t else '' end else 'orders' end as citation, case when n <> '' and y <> '' then n || ' (' || y || ')' else n end as display,
 trim(n || ' | ' || y, ' |') as header from (select o_orderkey, case when o_orderkey % 4 = 0 then 'Cite ' || o_orderkey else '' end as c, case when o_orderkey % 4 = 1 then '720 ILCS ' || o_orderkey else '' end as s, case when o_orderkey % 4 = 2 then cast(o_orderkey % 900 as varchar) else '' end as r,
 case when o_orderkey % 8 = 2 then 'Discovery' else '' end as t, case when o_orderkey % 3 = 0 then '' else 'People v. ' || o_custkey end as n, case when o_orderkey % 5 = 0 then '' else strftime(o_orderdate, '%Y') end as y from orders)""")
def display_citation(spark, sf):
    """P6, P7, P13, P14, P15."""
    k = F.col("o_orderkey")
    key = k.cast("string")
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.when(k % 4 == 0, F.concat(F.lit("Cite "), key)).otherwise("").alias("c"), F.when(k % 4 == 1, F.concat(F.lit("720 ILCS "), key)).otherwise("").alias("s"), F.when(k % 4 == 2, (k % 900).cast("string")).otherwise("").alias("r"),
        F.when(k % 8 == 2, "Rule 5. Discovery").otherwise("").alias("t"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("People v. "), F.col("o_custkey").cast("string"))).alias("n"), F.when(k % 5 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM")).alias("d"))
    year = X.year_of(F.col("d"))
    return df.select("o_orderkey", X.citation(F.col("c"), F.col("s"), F.col("r"), F.col("t"), F.lit("orders")).alias("citation"), F.when((F.col("n") != "") & (year != ""), F.concat("n", F.lit(" ("), year, F.lit(")"))).otherwise(F.col("n")).alias("display"), X.join_header(F.col("n"), year).alias("header"))


@Q("select doc_id, source, lang, length(text) as n from (select *, row_number() over (partition by source, lang order by length(text) desc, doc_id) as rn from documents) where rn = 1")
def dedup_longest(spark, sf):
    """D1, D2, W3."""
    return R.keep_longest(table(spark, sf, "documents"), ["source", "lang"], "text", "doc_id").select("doc_id", "source", "lang", F.length("text").alias("n"))


@Q("select event_id, user_id, event_type, value from (select *, row_number() over (partition by user_id, event_type order by event_id desc) as rn from events) where rn = 1")
def dedup_last_wins(spark, sf):
    """D5, D7, K5."""
    return R.last_wins(table(spark, sf, "events"), ["user_id", "event_type"], "event_id").select("event_id", "user_id", "event_type", "value")


@Q("select event_id, ts, user_id, event_type, value from (select *, row_number() over (partition by user_id, event_type order by src desc, event_id desc) as rn from (select *, cast(event_id % 3 = 0 as int) as src from events)) where rn = 1")
def feedback_upsert(spark, sf):
    """K4, K5, K6: a table of old rows takes the new ones in."""
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    keys = ["user_id", "event_type"]
    old = R.last_wins(e.filter("event_id % 3 <> 0"), keys, "event_id")
    return R.upsert(old, e.filter("event_id % 3 = 0"), keys, "event_id")


@Q("select event_id, substr(sha256(event_type), 1, 16) as query_id, case when user_id % 3 = 0 then 'anonymous' else 'u' || user_id end as expert_id, case when event_id % 2 = 0 then null else 'c' end as comment from events")
def feedback_rows(spark, sf):
    """K6."""
    e = table(spark, sf, "events").select("event_id", F.col("event_type").alias("query_text"), F.when(F.col("user_id") % 3 == 0, "  ").otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("expert_id"), F.when(F.col("event_id") % 2 == 0, " ").otherwise("c").alias("comment"))
    return sinks.feedback_rows(e).select("event_id", "query_id", "expert_id", "comment")


@Q("select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderkey in (select l_orderkey from lineitem where l_quantity > 45))")
def semi_cascade(spark, sf):
    """J3."""
    items = table(spark, sf, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    orders = table(spark, sf, "orders").join(items, "o_orderkey", "left_semi").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").join(orders, "c_custkey", "left_semi").select("c_custkey", "c_name")


@Q("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_custkey is not null and o_totalprice > 300000)")
def anti_resume(spark, sf):
    """J4, K2."""
    return R.not_done(table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@Q("""select o_orderkey, coalesce(c_name, '') as c_name, coalesce(n_name, '') as n_name, coalesce(r_name, '') as r_name from orders left join (select * from customer where c_custkey % 10 <> 3) on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""")
def star_lookup(spark, sf):
    """J1, J2, J14."""
    cust = table(spark, sf, "customer").filter("c_custkey % 10 <> 3")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    df = table(spark, sf, "orders").join(cust, F.col("o_custkey") == F.col("c_custkey"), "left").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return df.select("o_orderkey", *[F.coalesce(c, F.lit("")).alias(c) for c in ("c_name", "n_name", "r_name")])


def _sides(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.floor("l_quantity").cast("long").alias("token_count"))
    return li.filter("n <= 2 and k % 5 <> 0"), li.filter("n > 2 and k % 7 <> 0")


_MERGE = """with li as (select l_orderkey as k, l_linenumber as n, cast(floor(l_quantity) as bigint) as t from lineitem), b as (select k, cast(sum(t) as bigint) as bulk_tokens from li where n <= 2 and k % 5 <> 0 group by k), a as (select k, cast(sum(t) as bigint) as api_tokens from li where n > 2 and k % 7 <> 0 group by k),
m as (select coalesce(b.k, a.k) as k, bulk_tokens, api_tokens, case when api_tokens is null or bulk_tokens > api_tokens then 'bulk' else 'api' end as side from b full join a on b.k = a.k)"""


@Q(_MERGE + " select * from m")
def merge_conflict(spark, sf):
    """J5."""
    return R.merge_sides(*_sides(spark, sf), "k")


@Q(_MERGE + " select li.k, n, t as token_count, side from li join m using (k) where (side = 'bulk' and n <= 2 and li.k % 5 <> 0) or (side = 'api' and n > 2 and li.k % 7 <> 0)")
def merge_rows(spark, sf):
    """J5, U1, U4."""
    return R.merged_rows(*_sides(spark, sf), "k").select("k", "n", "token_count", "side")


@Q(_MERGE + " select count(*) filter (where api_tokens is null) as bulk_only, count(*) filter (where bulk_tokens is null) as api_only, count(*) filter (where api_tokens is not null and bulk_tokens is not null) as both, count(*) as total from m")
def overlap_report(spark, sf):
    """A14, U2."""
    return R.overlap_report(R.merge_sides(*_sides(spark, sf), "k"))


@Q("select id, n from (select c_custkey as id, 1 as n from customer union all select s_suppkey, 2 from supplier) where id not in (select p_partkey from part where p_size > 40) and id in (select o_custkey from orders)")
def set_operations(spark, sf):
    """U1, U2."""
    ids = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.lit(1).alias("n")).unionByName(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.lit(2).alias("n")))
    return ids.join(table(spark, sf, "part").filter("p_size > 40").select(F.col("p_partkey").alias("id")), "id", "left_anti").join(table(spark, sf, "orders").select(F.col("o_custkey").alias("id")), "id", "left_semi").select("id", "n")


@Q("select type, max(date) as date, arg_max(path, date) as path from (select 't' || (c_custkey % 20) as type, strftime(date '2020-01-01' + cast(c_custkey as int), '%Y-%m-%d') as date, 'd/t' || (c_custkey % 20) || '-' || strftime(date '2020-01-01' + cast(c_custkey as int), '%Y-%m-%d') || '.csv.bz2' as path from customer where c_custkey * 20 >= 1000) group by type")
def latest_snapshot(spark, sf):
    """S5, D6, O5."""
    k = F.col("c_custkey")
    name = F.concat(F.lit("d/t"), (k % 20).cast("string"), F.lit("-"), F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), k.cast("int")), "yyyy-MM-dd"), F.lit(".csv.bz2"))
    return readers.latest_snapshots(table(spark, sf, "customer").select(name.alias("path"), (k * 20).alias("length")))


@Q("select event_type, count(*) as n, min(ts) as first_ts, max(ts) as last_ts, count(*) filter (where value is null) as missing, count(distinct user_id) as users from events group by event_type")
def event_breakdown(spark, sf):
    """A6, A13, A15, A17."""
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count_if(F.col("value").isNull()).alias("missing"), F.count_distinct("user_id").alias("users"))


@Q("select user_id, count(*) filter (where event_type = 'click') as clicks, count(*) filter (where event_type = 'view') as views, max(ts) as latest, arg_min(event_type, event_id) as first_type from events group by user_id")
def feedback_history(spark, sf):
    """A12, O4."""
    return table(spark, sf, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "click").alias("clicks"), F.count_if(F.col("event_type") == "view").alias("views"), F.max("ts").alias("latest"), F.min_by("event_type", "event_id").alias("first_type"))


@Q("select user_id, n from (select user_id, count(*) as n from events group by user_id) where n > 1")
def duplicate_histogram(spark, sf):
    """A5."""
    return table(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("n")).filter("n > 1")


@Q("select doc_id, n_chars from documents order by length(text) desc, doc_id limit 50")
def longest_documents(spark, sf):
    """A top-k report."""
    return table(spark, sf, "documents").orderBy(F.length("text").desc(), "doc_id").limit(50).select("doc_id", "n_chars")
