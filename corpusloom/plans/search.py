"""Retrieval queries: BM25, vectors, fusion, lookup, near-duplicates, reranking."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import filters, learned_rank, near_text, relational as R, retrieval as V, vector_index
from corpusloom.operators.bm25_index import Bm25Index
from corpusloom.plans.base import Registry
from corpusloom.session import shared_dir, stage_table, table

Q = Registry()

_TOK = "list_concat(list_filter(regexp_split_to_array(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+'), lambda w: w <> ''), regexp_extract_all(lower({0}), '\\d+/\\d+[\\-.\\d]*'))"
_BM25 = f"""with t as (select doc_id as chunk_id, {_TOK.format('text')} as tk from documents where text is not null), l as (select chunk_id, tk, len(tk) as dl from t), g as (select count(*) as n, avg(dl) as avgdl from l),
p as (select chunk_id, dl, term, count(*) as tf from (select chunk_id, dl, unnest(tk) as term from l) group by all), q as (select item_id as query_id, term, count(*) as qtf from (select item_id, unnest({_TOK.format('text')}) as term from benchmark) group by all),
d as (select term, count(*) as df from p group by term), s as (select query_id, chunk_id, round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) as score from p join q using (term) join d using (term), g group by all),
b as (select *, row_number() over (partition by query_id order by score desc, chunk_id) - 1 as rank0 from s where score > 0)"""
_VEC = """vq as (select vec_id as query_id, embedding as e from embeddings where vec_id % 20 = 0), vs as (select query_id, vec_id as chunk_id, round(list_cosine_similarity(cast(embedding as double[]), cast(e as double[])), 6) as score from embeddings, vq),
v as (select *, row_number() over (partition by query_id order by score desc, chunk_id) - 1 as rank0 from vs)"""


def _docs(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("chunk_id"), "text")


def _queries(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def _bm25(spark, sf, k):
    """From an index of the application's own, brought up to date first."""
    name = hashlib.sha256(sf.encode()).hexdigest()[:16]
    index = Bm25Index(spark, f"{shared_dir(spark)}/bm25-{spark.sparkContext.applicationId}-{name}")
    index.refresh(table(spark, sf, "documents").select(F.col("doc_id").alias("chunk_id"), "text", F.col("source").alias("collection_id")))
    return index.search(_queries(spark, sf), k)


def _vectors(spark, sf, k):
    v = table(spark, sf, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")
    return V.vector_top_k(v, v.filter("chunk_id % 20 = 0").select(F.col("chunk_id").alias("query_id"), "embedding"), k)


@Q(_BM25.split(", q as")[0] + " select term, count(*) as df, cast(sum(tf) as bigint) as cf from p group by term")
def bm25_stats(spark, sf):
    """R4, A18, A4, K10."""
    return V.postings(_docs(spark, sf)).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


@Q(_BM25 + " select query_id, chunk_id, score, rank0 from b where rank0 < 20")
def bm25_topk(spark, sf):
    """R5, F14, W1."""
    return _bm25(spark, sf, 20).withColumn("rank0", F.col("rank0").cast("long"))


@Q("with " + _VEC + " select query_id, chunk_id, score, rank0 from v where rank0 < 40")
def vector_topk(spark, sf):
    """R1, R2, R13, J9."""
    return _vectors(spark, sf, 40).withColumn("rank0", F.col("rank0").cast("long"))


def _vector_index(spark, sf):
    v = table(spark, sf, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")
    dim = v.agg(F.max(F.size("embedding"))).first()[0] or 0
    made = vector_index.VectorIndex.build(v, f"{shared_dir(spark)}/vector-index-{uuid.uuid4().hex}", dim)
    return made, v.filter("chunk_id % 20 = 0").select(F.col("chunk_id").alias("query_id"), "embedding")


@Q("with " + _VEC + " select query_id, chunk_id, score, rank0 from v where rank0 < 40")
def match_exact(spark, sf):
    """From the stored index, probed cells first and then all whose bound reaches the k-th score."""
    made, asked = _vector_index(spark, sf)
    return made.search(asked, 40, exact=True).withColumn("rank0", F.col("rank0").cast("long"))


@Q()
def match_cells(spark, sf):
    """From the stored index, the probed cells alone; recall is tested against brute force."""
    made, asked = _vector_index(spark, sf)
    return made.search(asked, 40).withColumn("rank0", F.col("rank0").cast("long"))


_ARMS = _BM25 + ", " + _VEC + ", arms as (select query_id, 'bm25' as arm, 0 as o, chunk_id, rank0 from b where rank0 < 40 union all select query_id // 20, 'documents', 1, chunk_id, rank0 from v where rank0 < 40)"


def _arms(spark, sf):
    a = _bm25(spark, sf, 40).select("query_id", F.lit("bm25").alias("arm"), "chunk_id", "rank0")
    b = _vectors(spark, sf, 40).select((F.col("query_id") / 20).cast("long").alias("query_id"), F.lit("documents").alias("arm"), "chunk_id", "rank0")
    return a.unionByName(b)


def _fused(w1: float, w2: float, n: int) -> str:
    return _ARMS + f""", f as (select query_id, chunk_id, round(sum(case arm when 'bm25' then {w1} else {w2} end / (rank0 + 60)), 9) as score, min(o * 1000 + rank0) as seen from arms group by all)
select query_id, chunk_id, score, rank0 from (select *, row_number() over (partition by query_id order by score desc, seen, chunk_id) - 1 as rank0 from f) where rank0 < {n}"""


@Q(_fused(1.0, 1.0, 40))
def rrf_two_arms(spark, sf):
    """R7, R3."""
    return V.fuse(_arms(spark, sf), {"bm25": 1.0, "documents": 1.0}).withColumn("rank0", F.col("rank0").cast("long"))


@Q(_fused(1.2, 0.7, 60))
def rrf_weighted(spark, sf):
    """R6, R8, R9."""
    return V.fuse(_arms(spark, sf), {k: V.WEIGHTS[k] for k in ("bm25", "documents")}, 60).withColumn("rank0", F.col("rank0").cast("long"))


@Q(_BM25 + """, x as (select query_id, chunk_id, 0 as arm, rank0 from b where rank0 < 5 union all select query_id, chunk_id, 1, rank0 from b where rank0 >= 3 and rank0 < 12), y as (select query_id, chunk_id, min(arm * 1000 + rank0) as first_at from x group by all)
select query_id, chunk_id, row_number() over (partition by query_id order by first_at, chunk_id) - 1 as rank0 from y""")
def append_unseen(spark, sf):
    """D8, D4."""
    b = _bm25(spark, sf, 12)
    return V.append_unseen(b.filter("rank0 < 5"), b.filter("rank0 >= 3")).withColumn("rank0", F.col("rank0").cast("long"))


@Q("""with q as (select conv_id, turn, case when turn % 3 = 0 then 'what does 720 ILCS 5/' || (conv_id % 50) || ' say' when turn % 3 = 1 then 'Rule ' || (conv_id % 50) || ' please' else text end as question from conversations),
k as (select conv_id, turn, nullif(regexp_extract(question, '(\\d+ ILCS \\d+/[\\d\\-.]+\\w*)', 1), '') as statute, nullif(regexp_extract(question, '^Rule (\\d+)', 1), '') as rule from q),
c as (select doc_id, '720 ILCS 5/' || doc_id as statute, cast(doc_id as varchar) as rule from documents)
select k.conv_id, k.turn, c.doc_id, true as pinned from k join c on k.statute = c.statute union select k.conv_id, k.turn, c.doc_id, true from k join c on k.rule = c.rule""")
def citation_lookup(spark, sf):
    """F19, J13."""
    t = F.col("turn") % 3
    k = (F.col("conv_id") % 50).cast("string")
    q = table(spark, sf, "conversations").select("conv_id", "turn", F.when(t == 0, F.concat(F.lit("what does 720 ILCS 5/"), k, F.lit(" say"))).when(t == 1, F.concat(F.lit("Rule "), k, F.lit(" please"))).otherwise(F.col("text")).alias("question"))
    q = q.select("conv_id", "turn", filters.statute_lookup(F.col("question")).alias("statute"), filters.rule_lookup(F.col("question")).alias("rule"))
    c = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("720 ILCS 5/"), F.col("doc_id").cast("string")).alias("statute"), F.col("doc_id").cast("string").alias("rule"))
    a = q.join(c.drop("rule"), "statute").select("conv_id", "turn", "doc_id")
    b = q.join(c.drop("statute"), "rule").select("conv_id", "turn", "doc_id")
    return a.unionByName(b).distinct().withColumn("pinned", F.lit(True))


def _candidates(spark, sf, k=20):
    return _bm25(spark, sf, k).join(_docs(spark, sf), "chunk_id").join(_queries(spark, sf), "query_id")


@Q()
def near_dup(spark, sf):
    """D3, J12."""
    ranked = _candidates(spark, sf).select("query_id", "chunk_id", "score", "rank0", "text")
    return near_text.drop_near(ranked).select("query_id", "chunk_id", "score", "rank0")


_WORDS = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '\\s+'), lambda w: w <> ''))"


@Q(_BM25 + f""", c as (select b.query_id, chunk_id, rank0, {_WORDS.format('i.text')} as a, {_WORDS.format('d.text')} as w from b join documents d on d.doc_id = chunk_id join benchmark i on i.item_id = query_id where rank0 < 20),
ce as (select query_id, chunk_id, rank0, 12.0 * len(list_intersect(a, w)) / len(a) - 6 as ce from c), r as (select *, row_number() over (partition by query_id order by ce desc, rank0, chunk_id) - 1 as post_rank from ce)
select query_id, chunk_id, rank0, round(ce, 6) as ce_score, post_rank, ce >= -3 and post_rank < 6 as survived from r""")
def audit_survival(spark, sf):
    """R10, R11, R12, F15, W4."""
    out = V.rerank(_candidates(spark, sf))
    return out.select("query_id", "chunk_id", F.col("rank0").cast("long").alias("rank0"), F.round("ce_score", 6).alias("ce_score"), F.col("post_rank").cast("long").alias("post_rank"), "survived")


@Q()
def learned_rerank(spark, sf):
    """Feedback calls a candidate relevant where it holds the query's passage; the score learned from its triplets orders all candidates."""
    ranked = stage_table(_candidates(spark, sf), "candidates")
    label = F.when(F.contains(F.lower("text"), F.lower("query")), "RELEVANT").otherwise("IRRELEVANT")
    triplets = R.training_triplets(ranked.select("query", "text", "chunk_id", label.alias("label"), F.col("score").alias("ce_score")))
    out = learned_rank.learned_rerank(ranked, learned_rank.fit(triplets))
    return out.select("query_id", "chunk_id", F.col("rank0").cast("long").alias("rank0"), F.round("ce_score", 4).alias("ce_score"), F.col("post_rank").cast("long").alias("post_rank"), "survived")


@Q("""select doc_id, case when s is null then '' when s >= 2 then 'high' when s >= 0 then 'mid' else 'low' end as bucket, contains(text, split_part(cit, ' — ', 1)) as cited, '[' || cit || ']:' || chr(10) || 'x' as shown
from (select doc_id, text, case when doc_id % 5 = 0 then null else cast(doc_id % 7 as double) - 3 end as s, substr(text, 1, 5) || ' — ' || source as cit from documents)""")
def answer_rendering(spark, sf):
    """P15, P19, P20."""
    df = table(spark, sf, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 5 != 0, (F.col("doc_id") % 7).cast("double") - 3).alias("s"), F.concat(F.substring("text", 1, 5), F.lit(" — "), F.col("source")).alias("cit"))
    return df.select("doc_id", X.score_bucket(F.col("s")).alias("bucket"), X.cited_in(F.col("text"), F.col("cit")).alias("cited"), X.labelled(F.col("cit"), F.lit("x")).alias("shown"))
