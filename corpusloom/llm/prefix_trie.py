"""Trie of conversation prefixes: chained digests of turns, nodes by (depth, digest), subtree sums by ancestors.

A conversation's turns are chained: ``y_0 = H(x_0)``, ``y_i = H(y_(i-1) x_i)``.
To keep a conversation of any length out of one task, it is chained in blocks of
``BLOCK`` turns. The last digests of full blocks are chained the same way, block
by block of their own, and seed the block that follows: the digest of a prefix
of d turns is that of its d / BLOCK full blocks where d is a multiple, else
``H(seed y)``. It is a function of the prefix alone.

Every prefix of every conversation is a row; grouped by depth and digest they
give the nodes. For the sums over subtrees each node is exploded to its
ancestors within its block; what lies below a block's last turn is the same sum
over the tree of full blocks. So a node makes at most ``BLOCK`` rows for a block
level, however deep it is.

Defined results: turns without a conversation id take no part. Turns are ordered
by turn (null first), equal ones by their digests; repeated rows are turns of
their own. A null role or text counts as empty. Texts of any length are hashed
whole. Only named columns are read. An empty table has no conversation and
returns no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.numbering import join_hot, numbered
from corpusloom.session import stage_table

#: Turns of a block.
BLOCK = 64
#: Conversations of a node whose ids are joined to one text.
ENDS = 4096
EMPTY = hashlib.sha256(b"").hexdigest()


def H(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def turn_digest(role: Column, text: Column) -> Column:
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


@dataclass
class Chains:
    """``rows(c, k, size, seed, digests, tokens)``: the prefix digests of each block k of c, and those of its full blocks."""

    rows: DataFrame
    full: Chains | None = None


def chain(items: DataFrame, label: str) -> Chains:
    """Prefix digests of ``items(c, i, x, points)``: digests ``x`` at places i from 0 of each c."""
    kids = F.array_sort(F.collect_list(F.struct("i", "x", "points")))
    blocks = items.groupBy("c", F.floor(F.col("i") / BLOCK).alias("k")).agg(kids.alias("kids"))
    grown = F.aggregate(
        F.col("kids"), F.array().cast("array<binary>"), lambda acc, x: F.array_append(acc, F.when(F.size(acc) == 0, H(x["x"])).otherwise(H(F.element_at(acc, -1), x["x"])))
    )
    blocks = stage_table(blocks.select("c", "k", F.size("kids").alias("size"), grown.alias("y"), F.transform("kids", lambda x: x["points"]).alias("tokens")), label)
    whole = blocks.filter(F.col("size") == BLOCK).select("c", F.col("k").alias("i"), F.element_at("y", -1).alias("x"), F.lit(0).alias("points"))
    if whole.isEmpty():
        return Chains(blocks.select("c", "k", "size", F.lit(None).cast("binary").alias("seed"), F.col("y").alias("digests"), "tokens"))
    full = chain(whole, f"{label}-full")
    at = full.rows.select("c", "k", F.posexplode("digests").alias("j", "u")).select("c", (F.col("k") * BLOCK + F.col("j")).alias("k"), "u")
    blocks = blocks.join(at.select("c", (F.col("k") + 1).alias("k"), F.col("u").alias("seed")), ["c", "k"], "left").join(at.withColumnRenamed("u", "own"), ["c", "k"], "left")
    digests = F.transform("y", lambda y, j: F.when((j == BLOCK - 1) & F.col("own").isNotNull(), F.col("own")).when(F.col("seed").isNull(), y).otherwise(H(F.col("seed"), y)))
    return Chains(stage_table(blocks.select("c", "k", "size", "seed", digests.alias("digests"), "tokens"), f"{label}-seeded"), full)


def prefixes(chains: Chains) -> DataFrame:
    """``c, k, depth, digest, before, points`` of every prefix of at least one turn; ``before`` is its parent's digest, null at depth 1."""
    each = chains.rows.select("c", "k", "seed", "digests", F.posexplode(F.arrays_zip("digests", "tokens")).alias("j", "x"))
    before = F.when(F.col("j") > 0, F.get("digests", F.col("j") - 1)).otherwise(F.col("seed"))
    return each.select("c", "k", (F.col("k") * BLOCK + F.col("j") + 1).alias("depth"), F.col("x.digests").alias("digest"), before.alias("before"), F.col("x.tokens").alias("points"))


def subtree_sums(chains: Chains, own: DataFrame, columns: list[str], label: str) -> DataFrame:
    """``depth, digest`` and the sums of ``columns`` over each node's subtree, itself included.

    ``own(c, depth, digest, *columns)`` has each node once, with a conversation c
    that runs through it.
    """
    depth = F.col("depth")
    if chains.full is not None:
        # what lies beneath the last turn of each full block: sums over the tree of blocks
        seeds = chains.rows.filter("seed is not null").select("c", "k", "seed")
        below = own.withColumn("k", F.floor((depth - 1) / BLOCK)).filter("k > 0").join(seeds, ["c", "k"])
        below = below.groupBy(F.col("k").alias("depth"), F.col("seed").alias("digest")).agg(F.min("c").alias("c"), *[F.sum(x).alias(x) for x in columns])
        # full blocks that nothing follows have no sum of their own
        tops = own.filter(depth % BLOCK == 0).select("c", (depth / BLOCK).cast("long").alias("depth"), "digest")
        below = tops.join(below.drop("c"), ["depth", "digest"], "left").na.fill(0, columns)
        below = subtree_sums(chains.full, stage_table(below, f"{label}-below"), columns, f"{label}-full")
        below = below.select((depth * BLOCK).alias("depth"), "digest", *[F.col(x).alias(f"{x}_below") for x in columns])
        own = own.join(below, ["depth", "digest"], "left").select("c", "depth", "digest", *[(F.col(x) + F.coalesce(f"{x}_below", F.lit(0))).alias(x) for x in columns])
    k, j = F.floor((depth - 1) / BLOCK), F.pmod(depth - 1, F.lit(BLOCK)).cast("int")
    way = own.withColumn("k", k).withColumn("j", j).join(chains.rows.select("c", "k", "digests"), ["c", "k"])
    each = way.select("k", F.posexplode(F.slice("digests", F.lit(1), F.col("j") + 1)).alias("j", "digest"), *columns)
    sums = each.groupBy((F.col("k") * BLOCK + F.col("j") + 1).alias("depth"), "digest").agg(*[F.sum(x).alias(x) for x in columns])
    return stage_table(sums, label)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's texts, which come in order; only one state is held."""
    now, state, out = None, None, []
    for batch in batches:
        for depth, digest, ids in zip(*(batch.column(n).to_pylist() for n in ("depth", "digest", "ids")), strict=True):
            if (depth, digest) != now:
                if now is not None:
                    out.append((*now, state.hexdigest()))
                now, state = (depth, digest), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if len(out) >= 4096:
            yield _as_batch(out)
            out = []
    if now is not None:
        out.append((*now, state.hexdigest()))
    if out:
        yield _as_batch(out)


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.string()), strict=True)], names=["depth", "digest", "ends_sha256"])


def end_digests(ends: DataFrame, label: str) -> DataFrame:
    """``depth, digest, ends_sha256``: SHA-256 of the ids c of ``ends(c, depth, digest)`` in ascending order, joined by commas.

    A node's ids are numbered and joined in runs of ``ENDS``; only the runs meet in
    the one pass that such a digest needs.
    """
    placed = numbered(ends, ["depth", "digest"], ["c"], f"{label}-ends")
    runs = placed.groupBy("depth", "digest", F.floor(F.col("i") / ENDS).alias("run")).agg(F.array_sort(F.collect_list("c")).alias("ids"))
    runs = runs.select("depth", "digest", "run", F.array_join(F.transform("ids", lambda c: c.cast("string")), ",").alias("ids"))
    dealt = runs.repartition("depth", "digest").sortWithinPartitions("depth", "digest", "run")
    return stage_table(dealt.select("depth", "digest", "ids").mapInArrow(_hashed, "depth long, digest binary, ends_sha256 string"), f"{label}-end-digests")


def trie(items: DataFrame, all_ids: DataFrame, label: str = "trie") -> DataFrame:
    """Nodes of the conversations ``items(c, i, x, points)``; ``all_ids(c)`` also names those without turns.

    One row a node: ``conv_id`` (its least member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    chains = chain(items, f"{label}-chains")
    last = items.groupBy("c").agg(F.max("i").alias("last"))
    lengths = stage_table(all_ids.join(last, "c", "left").select("c", (F.coalesce("last", F.lit(-1)) + 1).alias("length")), f"{label}-lengths")
    whole = lengths.agg(F.count("*").alias("n"), F.min("c").alias("least")).first()
    every = prefixes(chains)
    nodes = every.groupBy("depth", "digest").agg(F.count("*").alias("n_convs"), F.min("c").alias("c"), F.min("before").alias("before"), F.max("points").alias("points"))
    nodes = stage_table(nodes, f"{label}-nodes")
    children = nodes.filter("before is not null").groupBy((F.col("depth") - 1).alias("depth"), F.col("before").alias("digest")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["depth", "digest"], "left").na.fill(0, ["n_children"])
    nodes = stage_table(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("points")), f"{label}-counted")
    own = nodes.select("c", "depth", "digest", (F.col("n_children") == 0).cast("long").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    sums = subtree_sums(chains, own, ["n_leaves", "saved_tokens"], f"{label}-sums")
    ends = end_digests(every.groupBy("c").agg(F.max(F.struct("depth", "digest")).alias("x")).select("c", "x.*"), label)
    total = nodes.agg(F.count("*").alias("n"), F.sum((F.col("depth") == 1).cast("long")).alias("first"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"), F.sum("saved").alias("saved")).first()
    parents = nodes.filter("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("digest").alias("before"), F.col("c").alias("parent_conv_id"), F.col("n_children").alias("weight"))
    deeper = join_hot(nodes.filter("depth > 1"), parents, ["depth", "before"], "weight", total["n"])
    first = nodes.filter("depth = 1").withColumn("parent_conv_id", F.lit(whole["least"]))
    out = first.unionByName(deeper.drop("weight")).join(sums, ["depth", "digest"]).join(ends, ["depth", "digest"], "left")
    out = out.select(F.col("c").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
    # the root: a member of it is every conversation, and it has no last text
    empty = lengths.filter("length = 0").select("c", F.lit(0).cast("long").alias("depth"), F.lit(b"").alias("digest"))
    root = lengths.agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", F.lit(total["first"] or 0).cast("long").alias("n_children"),
        F.lit(total["leaves"] or 1).cast("long").alias("n_leaves"), F.lit(total["saved"] or 0).cast("long").alias("saved_tokens"),
    )
    at_root = end_digests(empty, f"{label}-root").first()
    return out.unionByName(root.withColumn("ends_sha256", F.lit(at_root["ends_sha256"] if at_root else EMPTY)))


def turns(conversations: DataFrame, label: str) -> DataFrame:
    """``c, x, points, i, n``: digest and code points of each turn, its place and the turns of its conversation."""
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), "turn", turn_digest(F.col("role"), F.col("text")).alias("x"), F.coalesce(F.length("text"), F.lit(0)).alias("points")
    )
    rows = stage_table(rows, f"{label}-turns")
    return stage_table(numbered(rows, ["c"], ["turn", "x"], f"{label}-numbered").drop("turn"), f"{label}-placed")


#: Conversations that share the head of the first of them, and one more than the most turns of a head.
SHARED, HEADS = 100, 6


def rebuilt(placed: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Each conversation c with its first h turns replaced by those of ``c - c % SHARED``, as many as that has; and all ids."""
    convs = placed.groupBy("c").agg(F.max("n").alias("n"))
    convs = convs.select("c", "n", (F.col("c") - F.col("c") % SHARED).alias("b"), F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(HEADS)).alias("h"))
    held = convs.select(F.col("c").alias("b"), F.least("n", F.lit(HEADS)).alias("of_b"))
    convs = stage_table(convs.join(held, "b", "left").select("c", "n", "b", "h", F.least("h", F.coalesce("of_b", F.lit(0))).alias("head")), f"{label}-convs")
    total = placed.count()
    tails = join_hot(placed.drop("n"), convs.select("c", "h", "head", F.col("n").alias("weight")), ["c"], "weight", total)
    tails = tails.filter("i >= h").select("c", (F.col("i") - F.col("h") + F.col("head")).alias("i"), "x", "points")
    firsts = placed.filter(F.col("i") < HEADS).select(F.col("c").alias("b"), "i", "x", "points")
    heads = convs.filter("head > 0").select("c", "b", "head").join(firsts, "b").filter("i < head").select("c", "i", "x", "points")
    return stage_table(tails.unionByName(heads), f"{label}-rebuilt"), convs.select("c")


def op12_prefix_trie(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return trie(*rebuilt(turns(conversations, "op12"), "op12"), "op12")


#: Unsigned CRC-32 of the decimal form of c.
CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(c as varchar), ''), lambda x: ascii(x)::bigint)),
    lambda a, x: list_reduce(list_prepend(xor(a, x), range(8)), lambda b, k: case when b & 1 = 1 then xor(b >> 1, 3988292384) else b >> 1 end)))"""
OP12_SQL = f"""
with own as (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, x) - 1 as i, x, text from (
    select conv_id, turn, coalesce(text, '') as text, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) as x
    from conversations where conv_id is not null)),
convs as (select c, {CRC_SQL} % 6 as h, c - c % 100 as b from (select distinct c from own)),
sized as (select c, h, b, least(h, (select count(*) from own where own.c = convs.b)) as head from convs),
built as (
  select s.c, o.i - s.h + s.head as i, o.x, o.text from sized s join own o on o.c = s.c and o.i >= s.h
  union all
  select s.c, o.i, o.x, o.text from sized s join own o on o.c = s.b and o.i < s.head),
ways as (
  select c, i + 1 as depth, length(text) as points, string_agg(x, '' order by i) over (partition by c order by i) as path from built
  union all
  select c, 0, 0, '' from convs),
lengths as (select c, max(depth) as length from ways group by c),
nodes as (
  select depth, path, min(c) as conv_id, count(*) as n_convs, max(points) as points,
    sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (depth = length), '')) as ends_sha256
  from ways join lengths using (c) group by depth, path),
kin as (select n.*, p.conv_id as parent_conv_id, (select count(*) from nodes k where k.depth = n.depth + 1 and starts_with(k.path, n.path)) as n_children
  from nodes n left join nodes p on p.depth = n.depth - 1 and starts_with(n.path, p.path)),
sums as (select a.depth, a.path, sum((d.n_children = 0)::bigint) as n_leaves, sum((d.n_convs - 1) * d.points) as saved_tokens
  from kin a join kin d on d.depth >= a.depth and starts_with(d.path, a.path) group by a.depth, a.path)
select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, ends_sha256 from kin join sums using (depth, path)
"""
