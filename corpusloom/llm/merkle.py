"""Merkle manifest of a dataset: a tree over each group's rows, one over the groups, and proofs by coordinates.

Leaves are numbered within their group. Levels are built a tier at a time:
blocks of ``RUN ** LEVELS`` consecutive nodes are folded by one grouping, so no
group gathers more than a block, and the block's last node stands for it in the
next tier. Every node is written with its coordinate (group, level, place).

A proof needs the nodes a leaf's way to the root leaves out. Their coordinates
follow from the leaf's place and the group's size alone; they are exploded and
met with the node table. A leaf asks for those beneath its block's last node
only; that node asks for its own once, and its proof is handed down to the
block's rows. So no node near the root is asked for by a third of all rows: a
coordinate is asked for by at most a block.

Defined results: a null is ``-`` in a leaf; an empty value is ``0:``. A null
group is a group of its own and comes first; rows with a null key come first in
their group. Rows equal in key are ordered by their leaves; repeated rows are
leaves of their own. Texts of any length are hashed whole. An empty table has no
root and returns no row. Only named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.numbering import join_hot, numbered
from corpusloom.session import stage_table

#: Consecutive nodes that become one, and levels of a block.
RUN, LEVELS = 2, 8
WIDTH = RUN**LEVELS
STEPS = "array<struct<place:int,others:array<binary>>>"


def field(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 bytes and, before them, how many."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in fields]), 256))


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _depth(n: Column) -> Column:
    """Levels from a node to the last one of its block, in a group of ``n`` nodes."""
    return reduce(Column.__add__, [(n > RUN**level).cast("int") for level in range(LEVELS)])


def _levels(row: Column, depth: Column) -> Column:
    """All levels of a block as arrays of hex digests, the given one first."""

    def above(nodes: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / RUN).cast("int"))
        return F.transform(runs, lambda j: F.sha2(F.array_join(F.slice(nodes, j * RUN + 1, RUN), ""), 256))

    grown = F.aggregate(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))), F.array(row), lambda acc, _: F.array_append(acc, above(F.element_at(acc, -1))))
    return F.when(depth > 0, grown).otherwise(F.array(row))


@dataclass
class Tier:
    """``rows(g, i, n, digest)``, all ``nodes(g, level, i, digest, n, top)`` over them, and the ``roots(g, digest)`` of groups that end here."""

    rows: DataFrame
    nodes: DataFrame
    roots: DataFrame


def build(leaves: DataFrame, label: str) -> list[Tier]:
    """Tiers over ``leaves(g, i, n, digest)``: places from 0 and sizes of groups that are numbers."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    tiers, rows = [], leaves
    while most > 0:
        kids = F.transform(F.array_sort(F.collect_list(F.struct("i", "digest"))), lambda x: as_hex(x["digest"]))
        blocks = rows.groupBy("g", F.floor(F.col("i") / WIDTH).alias("b")).agg(F.max("n").alias("n"), kids.alias("row"))
        depth = _depth(F.col("n"))
        flat = blocks.select("g", "b", "n", depth.alias("depth"), F.posexplode(_levels(F.col("row"), depth)).alias("level", "row"))
        flat = flat.select("g", "b", "n", "depth", "level", F.posexplode("row").alias("j", "digest"))
        scale = F.element_at(F.array(*[F.lit(WIDTH // RUN**k) for k in range(LEVELS + 1)]), F.col("level") + 1)
        nodes = flat.select("g", "level", (F.col("b") * scale + F.col("j")).alias("i"), F.unhex("digest").alias("digest"), "n", (F.col("level") == F.col("depth")).alias("top"))
        nodes = stage_table(nodes, f"{label}-nodes-{len(tiers)}")
        tops = nodes.filter("top")
        tiers.append(Tier(rows, nodes, tops.filter(F.col("n") <= WIDTH).select("g", "digest")))
        rows = tops.filter(F.col("n") > WIDTH).select("g", "i", F.ceil(F.col("n") / WIDTH).alias("n"), "digest")
        most = -(-most // WIDTH) if most > WIDTH else 0
    return tiers


def roots(tiers: list[Tier]) -> DataFrame:
    return reduce(DataFrame.unionByName, [t.roots for t in tiers])


def _siblings(i: Column, n: Column) -> Column:
    """Coordinates of the other nodes of each run on a node's way up its block."""
    wanted = []
    for level in range(LEVELS):
        at = F.floor(i / RUN**level)
        for k in range(RUN):
            other = F.floor(at / RUN) * RUN + k
            there = (n > RUN**level) & (other != at) & (other < F.ceil(n / RUN**level))
            wanted.append(F.when(there, F.struct(F.lit(level).alias("level"), other.alias("at"))))
    return F.filter(F.array(*wanted), lambda x: x.isNotNull())


def _steps(i: Column, n: Column, found: Column) -> Column:
    """``array<struct<place, others>>``: for each level the node's place in its run and the run's other digests in order."""

    def step(level: int) -> Column:
        place = F.pmod(F.floor(i / RUN**level), F.lit(RUN)).cast("int")
        others = F.transform(F.filter(found, lambda x: x["level"] == level), lambda x: x["digest"])
        return F.struct(place.alias("place"), others.alias("others"))

    return F.slice(F.array(*map(step, range(LEVELS))), F.lit(1), _depth(n))


def prove(tiers: list[Tier], above: DataFrame, label: str) -> DataFrame:
    """``g, i, steps`` and what else ``above(g, steps, ...)`` has, for each leaf; ``above`` has a row for each group's root."""
    carried = [c for c in above.columns if c not in ("g", "steps")]
    higher = None
    for k, tier in reversed(list(enumerate(tiers))):
        ended = tier.roots.select("g").join(above, "g").select("g", F.lit(0).cast("long").alias("b"), F.col("steps").alias("rest"), *carried)
        if higher is not None:
            ended = ended.unionByName(higher.select("g", F.col("i").alias("b"), F.col("steps").alias("rest"), *carried))
        asked = tier.rows.select("g", F.col("i").alias("of"), F.explode(_siblings(F.col("i"), F.col("n"))).alias("x")).select("g", "of", "x.level", F.col("x.at").alias("i"))
        met = asked.join(tier.nodes.select("g", "level", "i", "digest"), ["g", "level", "i"])
        found = met.groupBy("g", F.col("of").alias("i")).agg(F.array_sort(F.collect_list(F.struct("level", F.col("i").alias("at"), "digest"))).alias("found"))
        own = tier.rows.select("g", "i", "n").join(found, ["g", "i"], "left")
        none = F.array().cast("array<struct<level:int,at:long,digest:binary>>")
        own = own.select("g", F.floor(F.col("i") / WIDTH).alias("b"), "i", _steps(F.col("i"), F.col("n"), F.coalesce("found", none)).alias("steps"))
        higher = own.join(ended, ["g", "b"]).select("g", "i", F.concat("steps", "rest").alias("steps"), *carried)
        higher = stage_table(higher, f"{label}-proofs-{k}")
    return higher


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf's digest and a proof's steps give, as hex."""

    def up(acc: Column, step: Column) -> Column:
        others = F.transform(step["others"], as_hex)
        before, after = F.slice(others, F.lit(1), step["place"]), F.slice(others, step["place"] + 1, F.lit(RUN))
        return F.sha2(F.concat(F.array_join(before, ""), acc, F.array_join(after, "")), 256)

    return F.aggregate(steps, as_hex(leaf), up)


def proof_digest(steps: Column) -> Column:
    """Digest of the siblings' hex, level by level."""
    return F.sha2(F.array_join(F.transform(F.flatten(F.transform(steps, lambda s: s["others"])), as_hex), ""), 256)


def manifest(rows: DataFrame, group: str, key: str, digest: str, label: str = "merkle") -> tuple[DataFrame, str | None]:
    """``rows`` with ``steps`` and ``subroot``, and the root (hex, null without rows).

    ``rows`` has a group, a key that orders each group's leaves, and a leaf's
    binary digest; ``steps`` lead from a leaf by its group's root to the root.
    Groups are ordered by their text, bytewise. Columns of ``rows`` named like the
    two new ones give way to them.
    """
    named = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    kept = rows.select(F.struct("*").alias("row"), named.alias("group_"), F.col(key).alias("key"), F.col(digest).alias("digest"))
    placed = numbered(kept, ["group_"], ["key", "digest"], f"{label}-leaves")
    sizes = stage_table(placed.groupBy("group_").agg(F.max("n").alias("size_")), f"{label}-sizes")
    total = sizes.agg(F.sum("size_")).first()[0] or 0
    sizes = numbered(sizes, [], ["group_"], f"{label}-groups").select("group_", "size_", F.col("i").alias("g"))
    placed = stage_table(join_hot(placed, stage_table(sizes, f"{label}-group-ids"), ["group_"], "size_", total).drop("group_", "size_"), f"{label}-placed")
    lower = build(placed.select("g", "i", "n", "digest"), f"{label}-rows")
    given = [F.col("row")[c].alias(c) for c in rows.columns if c.lower() not in ("steps", "subroot")]
    if not lower:
        return placed.select(*given, F.lit(None).cast(STEPS).alias("steps"), F.lit(None).cast("binary").alias("subroot")), None
    tops = stage_table(roots(lower), f"{label}-subroots")
    # written, as a constant known to the planner would make products of its joins
    leaves = stage_table(tops.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("i"), F.lit(tops.count()).cast("long").alias("n"), "digest"), f"{label}-top-leaves")
    upper = build(leaves, f"{label}-top")
    root = roots(upper).first()["digest"]
    end = tops.sparkSession.createDataFrame([(0, [])], f"g long, steps {STEPS}")
    above = prove(upper, end, f"{label}-top").select(F.col("i").alias("g"), "steps").join(tops, "g").withColumnRenamed("digest", "subroot")
    proofs = prove(lower, stage_table(above, f"{label}-above"), f"{label}-rows")
    return placed.join(proofs, ["g", "i"]).select(*given, "steps", "subroot"), root.hex()


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op13_merkle_manifest(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fields = {c: F.col(c) for c in FIELDS}
    changed = fields | {"n_chars": F.col("n_chars") + 1}
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    leaves = docs.select("doc_id", "lang", leaf_digest(list(fields.values())).alias("leaf"), F.when(tampered, leaf_digest(list(changed.values()))).alias("other"))
    proofs, root = manifest(stage_table(leaves, "op13-leaves"), "lang", "doc_id", "leaf", "op13")
    root = F.lit(root).cast("string")
    folded = fold(F.coalesce("other", "leaf"), F.col("steps"))
    out = proofs.select("doc_id", as_hex(F.col("leaf")).alias("leaf"), as_hex(F.col("subroot")).alias("subroot"), root.alias("root"), proof_digest(F.col("steps")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _field_sql(value: str) -> str:
    return f"coalesce(cast(octet_length(encode(cast({value} as varchar))) as varchar) || ':' || cast({value} as varchar), '-')"


#: Unsigned CRC-32 of the decimal form of ``{x}``.
CRC_SQL = """list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast({x} as varchar), ''), lambda c: ascii(c)::bigint)),
    lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)), lambda b, k: case when b & 1 = 1 then xor(b >> 1, 3988292384) else b >> 1 end))"""
OP13_SQL = f"""
with recursive docs as (
  select doc_id, lang, sha256({" || ".join(_field_sql(c) for c in FIELDS)}) as leaf,
    case when xor({CRC_SQL.format(x="doc_id")}, 4294967295) % 7 = 0 then sha256({" || ".join(_field_sql("(n_chars + 1)" if c == "n_chars" else c) for c in FIELDS)}) end as other
  from documents),
placed as (select *, row_number() over (partition by lang order by doc_id, leaf) - 1 as i, count(*) over (partition by lang) as n,
  dense_rank() over (order by lang nulls first) - 1 as g from docs),
nodes(g, level, i, n, h) as (
  select g, 0, i, n, leaf from placed
  union all
  select g, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' order by i)) from nodes where n > 1 group by g, level, i // 2, n),
sub as (select g, h as subroot, count(*) over () as m from nodes where n = 1),
tops(level, i, n, h) as (
  select 0, g, m, subroot from sub
  union all
  select level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' order by i)) from tops where n > 1 group by level, i // 2, n),
ways as (
  select p.doc_id, p.g, p.i, q.level, (p.i >> q.level) & 1 as place, s.h
  from placed p join nodes q on q.g = p.g and q.i = p.i >> q.level and q.n > 1 left join nodes s on s.g = p.g and s.level = q.level and s.i = xor(q.i, 1)
  union all
  select p.doc_id, p.g, p.i, 1000 + q.level, (p.g >> q.level) & 1, s.h
  from placed p join tops q on q.i = p.g >> q.level and q.n > 1 left join tops s on s.level = q.level and s.i = xor(q.i, 1)),
proofs as (select g, i, list(struct_pack(place := place, h := coalesce(h, '')) order by level) as steps, string_agg(h, '' order by level) as sibs from ways group by g, i),
done as (
  select doc_id, leaf, subroot, (select h from tops where n = 1) as root, sha256(coalesce(sibs, '')) as proof_sha256,
    list_reduce(list_prepend(struct_pack(place := 0::bigint, h := coalesce(other, leaf)), coalesce(steps, [])),
      lambda a, s: struct_pack(place := 0::bigint, h := sha256(case when s.place = 1 then s.h || a.h else a.h || s.h end))).h as folded_root
  from placed join sub using (g) left join proofs using (g, i))
select *, folded_root = root as verified from done
"""
