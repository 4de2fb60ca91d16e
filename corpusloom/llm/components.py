"""Links within buckets of an LSH, and connected components of an edge table.

Components come by large-star and small-star rounds of DataFrame joins.

Labels end as the least id of each component. Each round joins edges with their
nodes' least neighbours; the minimum is pre-aggregated before its shuffle and
adaptive execution splits the joins of hub nodes. The edges are written to the
shared folder after each round, which ends lineage. No edge or label reaches
the driver, only a count and a checksum per round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.bitmap import maybe_in
from corpusloom.session import arrow_batches, discard, stage_table


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a and b <> m").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # a < b on every row: each b has its smaller neighbours a
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    linked = edges.join(least, "b").select(F.col("m"), F.explode(F.array("a", "b")).alias("x"))
    return linked.filter("x <> m").select(F.col("m").alias("a"), F.col("x").alias("b")).distinct()


def connected_components(edges: DataFrame, label: str = "cc", max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)`` that isn't itself the least of its component.

    Self-loops, repeats and either direction are fine; a null end drops its edge.
    """
    edges = edges.filter("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = stage_table(edges, label)
    mark = None
    for _ in range(max_rounds):
        old, edges = edges, stage_table(_small_star(_large_star(edges)), label)
        discard(old)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(now) == mark:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
        mark = tuple(now)
    raise RuntimeError(f"components didn't settle in {max_rounds} rounds")


def shared_buckets(bands: DataFrame, label: str, parts: list[DataFrame] | None = None) -> DataFrame:
    """``key, id, hub`` of the buckets of ``bands(id, key)`` with several ids; the hub is the least.

    ``parts`` are the rows of ``bands`` with all rows of a key in one part: each
    is dealt out after the other, so that the disk holds the shuffle of one.
    """
    hubs = []
    for part in parts or [bands]:
        of = part.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("top")).filter("hub < top").select("key", "hub")
        hubs.append(stage_table(of, f"{label}-hubs"))
    hubs = reduce(DataFrame.unionByName, hubs)
    return stage_table(maybe_in(hubs, ["key"], KEY_WORDS)(bands).join(hubs, "key").select("key", "id", "hub"), f"{label}-buckets")


def star_pairs(shared: DataFrame, label: str) -> DataFrame:
    return stage_table(shared.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), f"{label}-stars")


#: The hash sets of a list of payloads, as sorted arrays.
Sets = Callable[[pa.Array], list[np.ndarray]]
#: 64-bit words of the bitmap of shared keys: 2 MB.
KEY_WORDS = 1 << 18
#: Standard errors below the threshold at which pairs of sketches are still compared by their sets (3 in a million are lost).
SIGMAS = 4.5
#: Payload bytes worked on together, and rows of an Arrow batch that holds payloads.
PART_BYTES, PAYLOAD_ROWS = 1 << 20, 512


def _parts(column: pa.Array) -> Iterator[tuple[int, int]]:
    size = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + PART_BYTES, "right")))
        yield at, end
        at = end


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sketches (rows of registers, 0: nothing) may belong to near sets: up to ``SIGMAS`` standard errors below."""
    t = percent / 100
    some = ((a != 0) | (b != 0)).sum(-1)
    same = ((a == b) & (a != 0)).sum(-1)
    return same >= t * some - SIGMAS * np.sqrt(t * (1 - t) * some)


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def likely_pairs(pairs: DataFrame, sketches: DataFrame, kind: type, percent: int, label: str) -> DataFrame:
    """The rows of ``pairs(a, b)`` whose sketches ``(id, q)``, registers of a numpy ``kind``, are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield batch.select(["a", "b"]).filter(pa.array(alike(_matrix(batch.column("x"), kind), _matrix(batch.column("y"), kind), percent)))

    both = pairs.join(sketches.select(F.col("id").alias("a"), F.col("q").alias("x")), "a").join(sketches.select(F.col("id").alias("b"), F.col("q").alias("y")), "b")
    return stage_table(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), label)


def is_near(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    small, large = sorted((s, t), key=len)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(s) + len(t) - both)


def _near_rows(sets: Sets, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in _parts(batch.column("y")):
                part = batch.slice(i, j - i)
                ok = [is_near(s, t, percent) for s, t in zip(sets(part.column("x")), sets(part.column("y")), strict=True)]
                yield part.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def confirmed(pairs: DataFrame, payload: DataFrame, sets: Sets, percent: int, label: str) -> DataFrame:
    """The rows of ``pairs(a, b)`` whose sets, made of ``payload(id, p)``, are near."""
    full = pairs.join(payload.select(F.col("id").alias("a"), F.col("p").alias("x")), "a").join(payload.select(F.col("id").alias("b"), F.col("p").alias("y")), "b")
    with arrow_batches(pairs.sparkSession, PAYLOAD_ROWS):
        return stage_table(full.select("a", "b", "x", "y").mapInArrow(_near_rows(sets, percent), "a long, b long"), label)


class _Row:
    """A row of a block; its set is made when it is first wanted."""

    def __init__(self, one: int, part: int, payload: pa.Scalar, sets: Sets):
        self.one, self.part, self.payload, self.sets, self.known = one, part, payload, sets, None

    def members(self) -> np.ndarray:
        if self.known is None:
            self.known = self.sets(pa.array([self.payload.as_py()], self.payload.type))[0]
        return self.known


Block = list[tuple[_Row, np.ndarray]]


def _alike_in(seekers: Block, members: Block, percent: int) -> Iterator[tuple[int, int]]:
    """Places of the seekers and the members of other components whose sketches are alike."""
    if not members or not seekers:
        return
    parts, sketches = np.array([r.part for r, _ in members]), np.stack([q for _, q in members])
    step = max(1, 4096 // len(members))
    for at in range(0, len(seekers), step):
        some = seekers[at : at + step]
        q = np.stack([q for _, q in some])
        maybe = alike(sketches[None, :, :], q[:, None, :], percent) & (parts[None, :] != np.array([r.part for r, _ in some])[:, None])
        for i, k in np.argwhere(maybe).tolist():
            yield at + i, k


def promising(seekers: Block, members: Block, percent: int) -> tuple[list[int], list[int], list[bool]]:
    """``id, c, member`` of the rows that are alike with one on the other side."""
    found: set[tuple[int, int, bool]] = set()
    for i, k in _alike_in(seekers, members, percent):
        found |= {(seekers[i][0].one, seekers[i][0].part, False), (members[k][0].one, members[k][0].part, True)}
    return tuple(map(list, zip(*sorted(found), strict=True))) or ([], [], [])


def seek(seekers: Block, members: Block, percent: int) -> tuple[list[int], list[int]]:
    """Links: of each seeker one to each component other than its own that holds a near member."""
    met: set[tuple[int, int]] = set()
    for i, k in _alike_in(seekers, members, percent):
        row, part = seekers[i][0], members[k][0].part
        if (row.one, part) not in met and is_near(row.members(), members[k][0].members(), percent):
            met.add((row.one, part))
    return tuple(map(list, zip(*sorted(met), strict=True))) or ([], [])


def _block_rows(f: Callable, names: list[str], kinds: list[pa.DataType], keyed: bool, kind: type, percent: int, sets: Sets | None = None):
    """``f`` of the seekers and the members of each (key, i, j), before which stand those if ``keyed``; rows come sorted by those."""

    def settle(held: list[tuple], now: tuple) -> pa.RecordBatch:
        of = {m: [(r, q) for r, member, q in held if member == m] for m in (False, True)}
        out = f(of[False], of[True], percent)
        columns = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
        if keyed:
            columns = [pa.array([v] * len(out[0]), k) for v, k in zip(now, (pa.int64(), pa.int32(), pa.int32()), strict=True)] + columns
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            if not len(batch):
                continue
            sketches = _matrix(batch.column("q"), kind)
            for at, (k, x, y, one, c, member) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("key", "i", "j", "id", "c", "member")), strict=True)):
                if (k, x, y) != now:
                    if held:
                        yield settle(held, now)
                    held, now = [], (k, x, y)
                held.append((_Row(one, c, sets and batch.column("p")[at], sets), member, sketches[at]))
        if held:
            yield settle(held, now)

    return run


def _tagged(rows: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """``key, id, c`` of ``rows(key, id)``: the component of each id."""
    found = connected_components(links, f"{label}-cc")
    tagged = rows.select("key", "id").join(found.withColumnRenamed("node", "id"), "id", "left")
    return stage_table(tagged.select("key", "id", F.coalesce("component", "id").alias("c")), f"{label}-tagged")


def _still_open(tagged: DataFrame, label: str) -> DataFrame:
    """``key, id, c, main, m, away`` of the buckets that hold several components, of equal buckets one.

    ``main`` is a bucket's most common component, ``m`` counts its ids and
    ``away`` those outside it.
    """
    by_part = tagged.groupBy("key", "c").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("id")).alias("x"))
    by_key = by_part.groupBy("key").agg(F.sum("m").alias("m"), F.bit_xor("x").alias("x"), F.count("*").alias("parts"), F.max(F.struct("m", "c")).alias("main"))
    by_key = by_key.filter("m > 2 and parts > 1")
    one = by_key.groupBy("m", "x").agg(F.min(F.struct("key", "main")).alias("one"))
    one = one.select("one.key", F.col("one.main.c").alias("main"), "m", (F.col("m") - F.col("one.main.m")).alias("away"))
    return stage_table(tagged.join(one, "key"), f"{label}-open")


def link_buckets(shared: DataFrame, pairs: DataFrame, payload: DataFrame, sketches: DataFrame, kind: type, sets: Sets, percent: int, label: str, hubs: int = 4, block: int = 256) -> DataFrame:
    """Links ``a, b`` that join the components of all near pairs which ``shared(key, id, hub)`` holds.

    1. ``pairs(a, b)``: ids and the hubs of their buckets.
    2. Where a bucket of three or more ids still holds several components, and
       over an eighth of a ``block`` of ids outside its largest one, the least
       ids of ``hubs`` of those are compared with the whole bucket. Rows grow
       with the bucket's size, not its square.
    3. The ids that are then still outside the largest component seek among all
       ids of the bucket, in blocks of ``block`` seekers and ``block`` members,
       and report one link to each other component. A bucket with few such ids
       is one pass over it; pairs are never rows.

    Sketches (see ``alike``) spare most comparisons of sets in 2 and 3.

    A link's end may be the label of a component that holds a near id. Payloads
    of the ids of ``pairs`` and of all buckets of three or more ids must be in
    ``payload(id, p)``, their sketches in ``sketches(id, q)``,
    registers of a numpy ``kind``.
    """
    links = confirmed(pairs, payload, sets, percent, f"{label}-links")
    rows = _still_open(_tagged(shared, links, label), label)
    least = rows.filter("c <> main").filter(F.col("away") > block // 8).groupBy("key", "c").agg(F.min("id").alias("a"))
    chosen = least.groupBy("key", F.pmod(F.xxhash64("c"), F.lit(hubs)).alias("s")).agg(F.min(F.struct("a", "c")).alias("hub")).select("key", "hub.a", F.col("hub.c").alias("of"))
    more = rows.join(chosen, "key").filter("c <> of").select("a", F.col("id").alias("b")).distinct()
    more = likely_pairs(more, sketches, kind, percent, f"{label}-likely-2")
    links = links.unionByName(confirmed(more, payload, sets, percent, f"{label}-links-2"))
    rows = _still_open(_tagged(rows, links, label), label)
    blocks = lambda n: F.ceil(F.col(n) / block).cast("int")
    rows = rows.withColumn("bi", blocks("away")).withColumn("bj", blocks("m"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    seekers = rows.filter("c <> main").select("key", F.pmod(F.hash("id"), F.col("bi")).alias("i"), each("bj").alias("j"), "id", "c", F.lit(False).alias("member"))
    members = rows.select("key", each("bi").alias("i"), F.pmod(F.hash("id"), F.col("bj")).alias("j"), "id", "c", F.lit(True).alias("member"))
    at = ["key", "i", "j"]
    dealt = lambda rows: rows.repartition(*at).sortWithinPartitions(*at)
    with arrow_batches(shared.sparkSession, PAYLOAD_ROWS):
        # first by the sketches alone, so that payloads of few rows are dealt out
        some = dealt(seekers.unionByName(members).join(sketches, "id").select(*at, "id", "c", "member", "q"))
        names, kinds = [*at, "id", "c", "member"], [pa.int64(), pa.int64(), pa.bool_()]
        some = stage_table(some.mapInArrow(_block_rows(promising, names, kinds, True, kind, percent), "key long, i int, j int, id long, c long, member boolean"), f"{label}-promising")
        met = dealt(some.join(sketches, "id").join(payload, "id").select(*at, "id", "c", "member", "q", "p"))
        met = met.mapInArrow(_block_rows(seek, ["a", "b"], [pa.int64()] * 2, False, kind, percent, sets), "a long, b long")
        return links.unionByName(stage_table(met, f"{label}-links-3"))
