"""URL filters: host-suffix and path-prefix expressions, looked up by hash prefix, confirmed by full digest.

Every distinct URL is expanded into (host suffix, path prefix) expressions, but
only into those that some rule could name: as many labels and as many path
characters as occur among the rules. Expressions meet the rules in an equi-join
on a short prefix of their digest; the full digest then confirms, and of the
rules that fit the longest wins (ties: longer host, then ``block``).

Nulls and odd input: a null url, or one without ``://``, has an empty host and
path, fits no rule and gets the default verdict. Repeated rows each return a
row. An empty table returns no row. Columns other than the two named ones are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules may be broadcast up to this many rows; more are joined by shuffle.
BROADCAST_RULES = 200_000
#: Hex digits of the digest that the first join compares.
PREFIX_HEX = 8


def host_of(url):
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), UPPER, LOWER)


def path_of(url):
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def url_filter(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Judge each row's URL by ``rules(host, path, verdict)``.

    Returns ``id_col, host, path, rule, verdict``: a rule as ``host + path``,
    null where none fits and ``verdict`` is then ``default``.
    """
    urls = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    rules = rules.select(
        F.translate(F.col("host"), UPPER, LOWER).alias("r_host"), F.coalesce(F.col("path"), F.lit("")).alias("r_path"), F.col("verdict").alias("r_verdict")
    ).filter("r_host is not null and r_host <> ''")
    shape = rules.agg(
        F.max(F.size(F.split("r_host", r"\."))).alias("labels"), F.collect_set(F.length("r_path")).alias("lens"), F.count("*").alias("n")
    ).first()
    if not shape["n"]:
        lens, labels = [], 0
    else:
        lens, labels = sorted(shape["lens"]), shape["labels"]
    parsed = urls.select("_url").filter("instr(_url, '://') > 0").distinct().select("_url", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    split = parsed.select("_url", "path", F.split("host", r"\.").alias("parts"))
    most = F.least(F.size("parts"), F.lit(labels))
    suffixes = F.transform(F.sequence(F.lit(1), most), lambda i: F.array_join(F.slice("parts", F.size("parts") - i + 1, i), "."))
    prefixes = F.array(*[F.substring("path", 1, n) for n in lens]) if lens else F.array().cast("array<string>")
    exprs = (
        split.filter(F.lit(labels) > 0)
        .select("_url", F.explode(suffixes).alias("e_host"), F.array_distinct(prefixes).alias("paths"))
        .select("_url", "e_host", F.explode("paths").alias("e_path"))
        .withColumn("digest", F.sha2(F.concat_ws("\n", "e_host", "e_path"), 256))
        .withColumn("short", F.substring("digest", 1, PREFIX_HEX))
    )
    best = F.struct((F.length("r_host") + F.length("r_path")).alias("len"), F.length("r_host").alias("hlen"), (F.col("r_verdict") == "block").alias("b"), F.col("r_verdict").alias("v"), F.concat("r_host", "r_path").alias("rule"))
    digests = rules.withColumn("r_digest", F.sha2(F.concat_ws("\n", "r_host", "r_path"), 256)).withColumn("short", F.substring("r_digest", 1, PREFIX_HEX))
    digests = F.broadcast(digests) if shape["n"] <= BROADCAST_RULES else digests
    hits = (
        exprs.join(digests, "short")
        .filter((F.col("digest") == F.col("r_digest")) & (F.col("e_host") == F.col("r_host")) & (F.col("e_path") == F.col("r_path")))
        .groupBy("_url")
        .agg(F.max(best).alias("best"))
    )
    known = F.instr("_url", "://") > 0
    return urls.join(hits, "_url", "left").select(
        F.col("_id").alias(id_col),
        F.when(known, host_of(F.col("_url"))).otherwise("").alias("host"),
        F.when(known, path_of(F.col("_url"))).otherwise("").alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.v"), F.lit(default)).alias("verdict"),
    )


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op4_url_filters(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return url_filter(pages, spark.createDataFrame(RULES, "host string, path string, verdict string"))


OP4_SQL = """
with rules(h, p, v) as (values ('com','/','allow'),('example.com','/en/','block'),('www.example.com','/en/','allow'),('net','/es/','block'),('net','/fr/','block')),
cut as (select page_id, url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
parts as (select page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path, row_number() over () as rid from cut),
hit as (select rid, arg_max(h || p, length(h) + length(p)) as rule, arg_max(v, length(h) + length(p)) as verdict
  from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by rid)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parts left join hit using (rid)
"""
