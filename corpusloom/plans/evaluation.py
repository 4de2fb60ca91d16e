"""Evaluation: IR metrics, breakdowns, label precision, triplets, citation sampling."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from corpusloom.operators import relational as R, retrieval as V
from corpusloom.plans.base import Registry
from corpusloom.session import table

Q = Registry()
_RUNS = """with h as (select o_custkey as id, list(distinct o_orderkey % 40) as ks from orders group by 1), runs as (select id, list_sort(ks) as ret, list_sort(list_distinct([x * 7 % 40 for x in ks])) as rel0 from h), r as (select id, ret, case when id % 11 = 0 then [] else rel0[1:4] end as rel from runs),
e as (select id, ret, rel, i, ret[i] as x, list_contains(rel, ret[i]) as hit from r, range(1, 41) t(i) where i <= len(ret)),
c as (select *, sum(cast(hit as int)) over (partition by id order by i) as cum from e)"""


def _metric_sql(k: int) -> str:
    return f"""cast(coalesce(max(case when hit and i <= {k} then 1.0 else 0.0 end), 0) as double) as hit_{k}, round(count(*) filter (where hit and i <= {k}) / {k}.0, 6) :: double as p_{k},
 round(case when len(any_value(rel)) = 0 then 1.0 else count(*) filter (where hit and i <= {k}) * 1.0 / len(any_value(rel)) end, 6) :: double as r_{k},
 round(case when len(any_value(rel)) = 0 then 1.0 else coalesce(sum(1.0 / log2(i + 1)) filter (where hit and i <= {k}), 0) / (select sum(1.0 / log2(j + 1)) from range(1, {k} + 1) t(j) where j <= len(any_value(rel))) end, 6) :: double as ndcg_{k}"""


_METRICS = _RUNS + f""", m as (select id, round(coalesce(max(1.0 / i) filter (where hit), 0), 6) :: double as mrr, round(case when len(any_value(rel)) = 0 then 1.0 else coalesce(sum(cum * 1.0 / i) filter (where hit), 0) / len(any_value(rel)) end, 6) :: double as ap, {', '.join(_metric_sql(k) for k in (3, 6, 10))} from c group by id)"""
_NAMES = ["mrr", "ap", *[f"{m}_{k}" for k in (3, 6, 10) for m in ("hit", "p", "r", "ndcg")]]


def _runs(spark, sf):
    h = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.array_sort(F.collect_set(F.col("o_orderkey") % 40)).alias("retrieved"))
    rel = F.slice(F.array_sort(F.array_distinct(F.transform("retrieved", lambda x: x * 7 % 40))), 1, 4)
    return h.withColumn("relevant", F.when(F.col("id") % 11 == 0, F.array().cast("array<bigint>")).otherwise(rel))


@Q(_METRICS + " select * from m")
def ir_metrics(spark, sf):
    """M1 to M6, A10, W8."""
    return V.ir_metrics(_runs(spark, sf)).select("id", *_NAMES)


@Q(_METRICS + " select id % 3 as difficulty, count(*) as n, " + ", ".join(f"round(avg({c}), 6) as {c}" for c in _NAMES) + " from m group by 1")
def difficulty_breakdown(spark, sf):
    """M7, A10, A11, J11."""
    m = V.ir_metrics(_runs(spark, sf))
    return m.groupBy((F.col("id") % 3).alias("difficulty")).agg(F.count("*").alias("n"), *[F.round(F.avg(c), 6).alias(c) for c in _NAMES])


@Q(_METRICS + " select id, mrr, r_6, case when mrr >= 0.73 then 'refined' when mrr >= 0.58 then 'demo' else 'gap' end as status from m order by mrr, r_6, id limit 10")
def worst_queries(spark, sf):
    """M8, M9, O3: a top-k report."""
    m = V.ir_metrics(_runs(spark, sf))
    return m.select("id", "mrr", "r_6", V.target_status(F.col("mrr"), 0.58, 0.73).alias("status")).orderBy("mrr", "r_6", "id").limit(10)


_LABELLED = """with f as (select d.doc_id, d.source, d.text, case when quality = 1 and toxic = 0 then 'BINDING' when quality = 1 then 'RELEVANT' else 'IRRELEVANT' end as label, (d.doc_id % 97) / 970.0 as rrf, case when d.doc_id % 13 = 0 then null else (d.doc_id % 31) / 4.0 - 3 end as ce from documents d join labels l on l.doc_id = d.doc_id)"""


def _labelled(spark, sf):
    label = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "BINDING").when(F.col("quality") == 1, "RELEVANT").otherwise("IRRELEVANT")
    df = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return df.select(F.col("doc_id").alias("chunk_id"), F.col("source").alias("collection_id"), "text", label.alias("label"), ((F.col("doc_id") % 97) / 970.0).alias("rrf_score"), F.when(F.col("doc_id") % 13 != 0, (F.col("doc_id") % 31) / 4.0 - 3).alias("ce_score"))


@Q(_LABELLED + """ select source as collection_id, count(*) as shown, count(*) filter (where label = 'BINDING') as binding, count(*) filter (where label = 'RELEVANT') as relevant, count(*) filter (where label = 'IRRELEVANT') as irrelevant,
 round(cast(avg(rrf) as decimal(20, 10)), 5) as avg_rrf, round(cast(avg(ce) as decimal(20, 10)), 3) as avg_ce, cast(round(cast(count(*) * 100 as decimal(20, 6)) / sum(count(*)) over (), 1) as double) as share,
 cast(round(cast(count(*) filter (where label <> 'IRRELEVANT') * 100 as decimal(20, 6)) / count(*), 1) as double) as precision from f group by source""")
def collection_precision(spark, sf):
    """A1, J8, W9, V6."""
    return R.collection_precision(_labelled(spark, sf))


@Q(_LABELLED + """, p as (select source, text, doc_id, coalesce(ce, 0) as s, row_number() over (partition by source order by coalesce(ce, 0) desc, doc_id) as rn from f where label <> 'IRRELEVANT'), n as (select source, text, doc_id, coalesce(ce, 0) as s, row_number() over (partition by source order by coalesce(ce, 0) desc, doc_id) as rn from f where label = 'IRRELEVANT')
select p.source as query, sha256(p.text) as positive, sha256(n.text) as negative, p.doc_id as positive_chunk_id, n.doc_id as negative_chunk_id, n.s as negative_score from p join n on p.source = n.source where p.rn = 1 and n.rn = 1""")
def triplets(spark, sf):
    """M11, J6, K9."""
    out = R.training_triplets(_labelled(spark, sf).withColumnRenamed("collection_id", "query"))
    return out.select("query", F.sha2("positive", 256).alias("positive"), F.sha2("negative", 256).alias("negative"), "positive_chunk_id", "negative_chunk_id", "negative_score")


@Q("""with c as (select distinct cast(p_size as varchar) as chapter, p_size || ' ILCS ' || p_partkey as cit from part), r as (select *, row_number() over (partition by chapter order by cit) - 1 as i, count(*) over (partition by chapter) as n from c)
select chapter, cit from (select *, row_number() over (partition by chapter order by i) as pick from r where chapter in ('7', '20') or i % greatest(n // 5, 1) = 0) where chapter in ('7', '20') or pick <= 5""")
def chapter_sample(spark, sf):
    """A sampling operator."""
    c = table(spark, sf, "part").select(F.col("p_size").cast("string").alias("chapter"), F.concat(F.col("p_size").cast("string"), F.lit(" ILCS "), F.col("p_partkey").cast("string")).alias("cit")).distinct()
    w = Window.partitionBy("chapter").orderBy("cit")
    r = c.withColumn("i", F.row_number().over(w) - 1).withColumn("n", F.count("*").over(Window.partitionBy("chapter")))
    full = F.col("chapter").isin("7", "20")
    r = r.filter(full | (F.col("i") % F.greatest(F.floor(F.col("n") / 5), F.lit(1)) == 0)).withColumn("pick", F.row_number().over(Window.partitionBy("chapter").orderBy("i")))
    return r.filter(full | (F.col("pick") <= 5)).select("chapter", "cit")


@Q("""with e as (select o_custkey as id, o_orderkey % 50 as cit from orders where o_custkey % 9 <> 0), v as (select distinct e.id, e.cit from e where e.cit in (select p_partkey from part where p_size < 25)) select id, list_sort(list(cit)) as expected, least(count(*), 4) as bucket from v group by id""")
def valid_expectations(spark, sf):
    """J7, J10, F16, A9."""
    e = table(spark, sf, "orders").filter("o_custkey % 9 <> 0").select(F.col("o_custkey").alias("id"), (F.col("o_orderkey") % 50).alias("cit")).distinct()
    known = table(spark, sf, "part").filter("p_size < 25").select(F.col("p_partkey").alias("cit"))
    return e.join(known, "cit", "left_semi").groupBy("id").agg(F.array_sort(F.collect_list("cit")).alias("expected"), F.least(F.count("*"), F.lit(4)).alias("bucket"))


@Q("select quality, toxic, count(*) as n, round(avg(case when (quality = 1) = (toxic = 0) then 1.0 else 0.0 end), 6) :: double as agreement from labels group by all")
def scope_accuracy(spark, sf):
    """A16."""
    agree = ((F.col("quality") == 1) == (F.col("toxic") == 0)).cast("double")
    return table(spark, sf, "labels").groupBy("quality", "toxic").agg(F.count("*").alias("n"), F.round(F.avg(agree), 6).alias("agreement"))
