"""Secret scans: pattern spans within each text, and linking of multipart credentials by interval join.

Base spans are leftmost non-overlapping matches of three kinds (assign, access,
hex), tested for length after matching. Weak candidates (a lone 40-character
base64 word, an endpoint URL or host:port) say little alone. They are reported
only where complementary parts stand within ``scope`` characters of each other:
a lone secret needs an access identifier or an endpoint near it, an endpoint
needs an access identifier or an assignment near it. The interval join compares
starts by bins as wide as the scope: each (document, bin) is reduced to the least
and greatest start of each kind first, so that a document full of parts makes no
pairs. Only rows whose text may have links meet them in a join; the rows of one
text are dealt over ``SALTS`` keys there, as copies may be many.

Defined results: a null text counts as empty (zero spans, digest of the empty
string). Repeated rows each return a row. Whole texts are scanned, of any
length. Columns other than ``doc_id`` and ``text`` are ignored, whatever their
names. Rows with a null doc_id return like others, links included. An empty
table returns no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.bitmap import maybe_in
from corpusloom.session import stage_table

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
LONE = r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/_.=-])"
ENDPOINT = r"https?://[A-Za-z0-9.-]+(?::[0-9]{2,5})?(?:/[A-Za-z0-9._/-]*)?"
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "lone", "endpoint")
SCOPE = 400
#: Matches whose places are summed in one run.
CHUNK = 128
#: Keys over which the copies of one linked text are dealt.
SALTS = 16


def spans(text: Column, kind: str, pattern: str, least: int = 0, group: int = 0) -> Column:
    """``array<struct<start, kind_no, end>>`` of the pattern's matches; code points, end exclusive.

    The pieces between matches and the matches alternate, so running sums of
    their lengths give every position.
    """
    p = F.lit(pattern)
    whole, wanted = F.regexp_extract_all(text, p, F.lit(0)), F.regexp_extract_all(text, p, F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    parts = F.arrays_zip(gaps.alias("gap"), F.transform(whole, lambda x: F.length(x)).alias("size"), F.transform(wanted, lambda x: F.length(x)).alias("want"))
    no = KINDS.index(kind)
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["size"], F.lit(0))
        one = F.struct(start.alias("start"), F.lit(no).alias("kind"), end.alias("end"))
        keep = x["size"].isNotNull() & (x["want"] >= least)
        return F.struct(end.alias("at"), F.when(keep, F.concat(acc["out"], F.array(one))).otherwise(acc["out"]).alias("out"))

    def places(parts):
        # runs of CHUNK pieces are summed apart and then moved to their places: arrays that grow by one stay short
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / CHUNK).cast("int")), lambda i: F.slice(parts, i * CHUNK + 1, CHUNK))
        return F.transform(runs, lambda run: F.aggregate(run, F.struct(F.lit(0).alias("at"), none.alias("out")), step))

    def moved(sums):
        offsets = F.aggregate(sums, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
        return F.flatten(F.zip_with(sums, offsets, lambda x, o: F.transform(x["out"], lambda s: F.struct((s["start"] + o).alias("start"), s["kind"].alias("kind"), (s["end"] + o).alias("end")))))

    once = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)  # binds a value, so that it is worked out once
    return F.when(F.size(whole) > 0, once(once(parts, places), moved)).otherwise(none)


def render(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def linked(parts: DataFrame, key: list[str], scope: int) -> DataFrame:
    """The weak parts (lone, endpoint) that have a complementary part within ``scope`` characters of their start.

    ``parts`` has ``key`` and ``start, kind, end``.
    """
    lone, endpoint, access, assign = (KINDS.index(k) for k in ("lone", "endpoint", "access", "assign"))
    parts = parts.withColumn("bin", F.floor(F.col("start") / scope))
    helps = {"id": F.col("kind").isin(access), "as": F.col("kind").isin(assign), "ep": F.col("kind") == endpoint}
    bins = parts.groupBy(*key, "bin").agg(*[f(F.when(c, F.col("start"))).alias(f"{n}_{k}") for k, c in helps.items() for n, f in (("lo", F.min), ("hi", F.max))])
    names = [c for c in bins.columns if c not in (*key, "bin")]
    # each bin's extremes go to itself and both neighbours; a weak part then meets one row
    near = bins.select(*key, *names, "bin", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("d"))
    near = near.select(*key, (F.col("bin") + F.col("d")).alias("bin"), *[F.when(F.col("d") == d, F.col(c)).alias(f"{c}_{i}") for c in names for i, d in enumerate((-1, 0, 1))])
    near = near.groupBy(*key, "bin").agg(*[F.max(c).alias(c) for c in near.columns if c not in (*key, "bin")])
    weak = parts.filter(F.col("kind").isin(lone, endpoint))

    def within(k: str) -> Column:
        # d = 1: the bin before; d = -1: the bin after
        before = F.coalesce(F.col(f"hi_{k}_2") >= F.col("start") - scope, F.lit(False))
        after = F.coalesce(F.col(f"lo_{k}_0") <= F.col("start") + scope, F.lit(False))
        return before | after | F.col(f"lo_{k}_1").isNotNull()

    need = F.when(F.col("kind") == lone, within("id") | within("ep")).otherwise(within("id") | within("as"))
    return weak.join(near, [*key, "bin"]).filter(need).select(*key, "start", "kind", "end")


def secret_scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row: ``doc_id``, ``base`` and ``added`` (arrays of start, kind number, end; see ``KINDS``)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("text"))
    kinds = [("assign", ASSIGN, 12, 1), ("access", ACCESS, 18, 0), ("hex", HEX, 16, 0), ("lone", LONE, 40, 0), ("endpoint", ENDPOINT, 0, 0)]
    key = ["h1", "h2"]  # two hashes of the text: what is linked depends on the text alone
    scanned = base.select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(11), "text").alias("h2"), *[spans(F.col("text"), *k).alias(k[0]) for k in kinds])
    scanned = stage_table(scanned, "secret-spans")
    complementary = (F.size("lone") > 0) & (F.size("access") + F.size("endpoint") > 0) | (F.size("endpoint") > 0) & (F.size("access") + F.size("assign") > 0)
    some = scanned.filter(complementary).dropDuplicates(key)
    parts = some.select(*key, F.explode(F.concat("assign", "access", "lone", "endpoint")).alias("s")).select(*key, "s.*")
    added = linked(parts, key, scope)
    added = stage_table(added.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("added")), "secret-links")
    rows = scanned.select("doc_id", *key, *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS], F.array_sort(F.concat(*BASE_KINDS)).alias("base"))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    hit = maybe_in(added, key)
    some = hit.keep(rows).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    dealt = added.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    some = some.join(dealt, [*key, "salt"], "left").withColumn("added", F.coalesce("added", empty)).drop("salt")
    return some.unionByName(hit.drop(rows).withColumn("added", empty)).select("doc_id", *[f"n_{k}" for k in BASE_KINDS], "base", "added")


def op5_secret_scan(spark, sf_dir):
    found = secret_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", *[f"n_{k}" for k in BASE_KINDS], F.sha2(render(F.col("base")), 256).alias("base_sha256"),
        render(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )
