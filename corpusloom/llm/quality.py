"""Quality classifier by co-training of a text view and a metadata view.

The text view sees shares of single bytes and byte classes, word and line
statistics and repetition; the metadata view sees language, source (hashed) and
length. Each view is a logistic model. For some rounds each labels all unlabelled
rows; the rows it is surest of among all, in the classes' proportion, join the
other view's training set. Both views are then calibrated on folds of the
labelled rows and combined by a last logistic model over their log odds.

The features of the unlabelled rows are written to the shared folder once and
scored there each round; every task reports its surest rows, and the surest of
those win. The fit uses at most ``max_train`` labelled rows, chosen by hash of the
id, and ``max_join`` pseudo-labelled ones a view; their features, not their
texts, reach the driver. Every document is scored, from its whole text.

Defined results: a null text counts as empty; null metadata is a value of its
own. Labels that are null, or of missing documents, are left out. Without both
classes among the labels every score is 0.5 and every row is kept; any number of
labels of both classes is fitted. A fold without which a class has no label is
calibrated by the views fitted on all. Repeated rows each return a row; as
pseudo-labels they count once. Columns other than ``doc_id, text, lang, source, n_chars``
are ignored; of those but the first two any may be missing. An empty table
returns no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.arrays import blocks, mix, text_bytes, word_spans
from corpusloom.llm.bitmap import maybe_in
from corpusloom.session import stage_table

MAX_TRAIN, MAX_JOIN, ROUNDS, SURE = 4_000, 1_000, 4, 0.9
BITMAP_WORDS = 1 << 19
SOURCE_BUCKETS, LANG_BUCKETS = 32, 8
_PUNCT = np.array([b for b in range(33, 127) if not chr(b).isalnum()])
_CLASS = np.zeros((6, 256), bool)
_CLASS[0, 97:123] = _CLASS[1, 65:91] = _CLASS[2, 48:58] = _CLASS[5, 128:] = True
_CLASS[3, [32, 9]] = _CLASS[4, [10, 13]] = True
N_TEXT = 2 * len(_PUNCT) + 6 + 9
N_META = SOURCE_BUCKETS + LANG_BUCKETS + 3


def _top_share(values: np.ndarray) -> tuple[float, float]:
    """Share of distinct values and of the most common one."""
    if not len(values):
        return 1.0, 0.0
    counts = np.unique(values, return_counts=True)[1]
    return len(counts) / len(values), counts.max() / len(values)


def text_features(column: pa.Array) -> np.ndarray:
    data, off = text_bytes(column)
    out = np.zeros((len(off) - 1, N_TEXT))
    for i, j in blocks(off):
        part, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
        h, row, start = word_spans(part, o)
        cut = np.searchsorted(row, np.arange(j - i + 1))
        for r in range(j - i):
            b = part[o[r] : o[r + 1]]
            n = max(1, len(b))
            hist = np.bincount(b, minlength=256)
            words = h[cut[r] : cut[r + 1]]
            distinct, top = _top_share(words)
            lines = np.diff(np.concatenate([[-1], np.flatnonzero(b == 10), [len(b)]])) - 1
            share = hist[_PUNCT] / n
            m = len(words)
            spread = np.diff(start[cut[r] : cut[r + 1]]) if m > 1 else np.zeros(1)
            same = float((words[1:] == words[:-1]).mean()) if m > 1 else 0.0
            extra = [np.log1p(len(b)), np.log1p(m), n / max(1, m) / 10, spread.std() / 10, distinct, top, same, np.log1p(len(lines)), lines.mean() / 500]
            out[i + r] = np.concatenate([share * 20, np.sqrt(share) * 3, _CLASS @ hist / n, extra])
    return out


def meta_features(lang: list, source: list, n_chars: list) -> np.ndarray:
    out = np.zeros((len(lang), N_META))
    for i, (a, s, n) in enumerate(zip(lang, source, n_chars, strict=True)):
        out[i, zlib.crc32(str(s).encode()) % SOURCE_BUCKETS] = 1
        out[i, SOURCE_BUCKETS + zlib.crc32(str(a).encode()) % LANG_BUCKETS] = 1
        x = np.log1p(max(0, n or 0))
        out[i, -3:] = x, (x - 7) ** 2 / 4, n is None
    return out


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 3.0) -> Logistic:
        mean, scale = x.mean(0), x.std(0) + 1e-3
        z = np.clip((x - mean) / scale, -8, 8)
        z = np.hstack([z, np.ones((len(z), 1))])
        w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
        penalty[-1] = 1e-3
        for _ in range(15):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (p - y) + penalty * w)
            w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-3:
                break
        return cls(mean, scale, w)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights[:-1] + self.weights[-1], -30, 30)


def probability(log_odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-log_odds))


@dataclass
class Wish:
    """What a view of one fit asks of the pool: its surest rows of each class, without those it gave before."""

    view: int
    model: Logistic
    given: np.ndarray
    n_good: int
    n_bad: int


def _surest(odds: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest odds of different ids; ties by a hash of the id."""
    order = np.lexsort((rows, ids, mix(ids.astype(np.uint64)), -odds))
    first = np.sort(np.unique(ids[order], return_index=True)[1])[:k]
    return order[first]


class Pool:
    """Features of all unlabelled rows, in the shared folder: ``doc_id, row, x``."""

    def __init__(self, docs: DataFrame, labels: DataFrame):
        docs = _input(docs).filter("doc_id is not null")
        known = labels.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
        hit = maybe_in(known, ["doc_id"], BITMAP_WORDS)
        held = hit.keep(docs)
        # held by chance: found by ids alone, so that few texts are shuffled
        chance = stage_table(held.select("doc_id").distinct().join(known, "doc_id", "left_anti"), "quality-chance")
        back = maybe_in(chance, ["doc_id"], BITMAP_WORDS).keep(held).join(chance, "doc_id", "left_semi")
        rest = hit.drop(docs).unionByName(back.select(docs.columns))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.hstack(_both(batch))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "x"])

        found = rest.mapInArrow(run, "doc_id long, x binary").withColumn("row", F.monotonically_increasing_id())
        self.rows = stage_table(found.select("doc_id", "row", "x"), "quality-pool")
        self.n = self.rows.count()

    def pick(self, wishes: list[Wish], sure: float = SURE) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids, features and labels of the rows that each wish gets."""
        least = np.log(sure / (1 - sure))
        counts = [k for w in wishes for k in (w.n_good, w.n_bad)]  # slot 2i: good, 2i + 1: bad

        def merge(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
            slot, odds, ids, rows = (np.concatenate(c) for c in zip(*parts, strict=True))
            keep = [np.zeros(0, int)]
            for i in np.unique(slot):
                at = np.flatnonzero(slot == i)
                keep.append(at[_surest(odds[at], ids[at], rows[at], counts[i])])
            at = np.concatenate(keep)
            return slot[at], odds[at], ids[at], rows[at]

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = None
            for batch in batches:
                if not len(batch):
                    continue
                ids, rows = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                x = np.frombuffer(b"".join(batch.column(2).to_pylist())).reshape(-1, N_TEXT + N_META)
                parts = [best] if best else []
                for i, w in enumerate(wishes):
                    odds = np.round(w.model.log_odds(_view(x, w.view)), 9)
                    free = ~np.isin(ids, w.given)
                    for slot, towards in ((2 * i, odds), (2 * i + 1, -odds)):
                        at = np.flatnonzero(free & (towards >= least))
                        parts.append((np.full(len(at), slot), towards[at], ids[at], rows[at]))
                best = merge(parts)
            if best:
                yield _candidates(best)

        def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = None
            for batch in batches:
                if len(batch):
                    part = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)
                    best = merge([best, part] if best else [part])
            if best:
                yield _candidates(best)

        found = self.rows.mapInArrow(score, CANDIDATES).repartition(16).mapInArrow(again, CANDIDATES).toArrow()
        columns = [c.to_numpy() for c in found.columns]
        if not found.num_rows:
            return [(np.zeros(0, int), np.zeros((0, N_TEXT + N_META)), np.zeros(0))] * len(wishes)
        slot, _, ids, rows = merge([tuple(columns)])
        wanted = self.rows.sparkSession.createDataFrame(pa.table({"row": np.unique(rows)}))
        have = self.rows.join(F.broadcast(wanted), "row").select("row", "x").toArrow()
        x_of = dict(zip(have.column("row").to_pylist(), have.column("x").to_pylist(), strict=True))
        out = []
        for i in range(len(wishes)):
            at = np.flatnonzero(slot // 2 == i)
            x = np.frombuffer(b"".join(x_of[r] for r in rows[at].tolist())).reshape(-1, N_TEXT + N_META)
            out.append((ids[at], x, 1.0 - slot[at] % 2))
        return out


CANDIDATES = "slot long, odds double, doc_id long, row long"


def _candidates(columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["slot", "odds", "doc_id", "row"])


def _view(x: np.ndarray, view: int) -> np.ndarray:
    return x[:, N_TEXT:] if view else x[:, :N_TEXT]


class Fit:
    """The two views on one set of labelled rows, and what each has been taught by the other."""

    def __init__(self, views: list[np.ndarray], y: np.ndarray):
        self.views, self.y = views, y
        self.gained = [[(np.zeros(0, int), np.zeros((0, N_TEXT + N_META)), np.zeros(0))] for _ in views]
        self.done = False
        self.fit()

    def fit(self) -> None:
        self.models = []
        for v, x in enumerate(self.views):
            more = [_view(g[1], v) for g in self.gained[v]]
            self.models.append(Logistic.fit(np.vstack([x, *more]), np.concatenate([self.y, *(g[2] for g in self.gained[v])])))

    def wishes(self, take: int) -> list[Wish]:
        share = self.y.mean()
        n_good, n_bad = max(1, int(take * share)), max(1, int(take * (1 - share)))
        return [Wish(v, self.models[v], np.concatenate([g[0] for g in self.gained[1 - v]]), n_good, n_bad) for v in (0, 1)]

    def learn(self, new: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        if not sum(len(n[0]) for n in new):
            self.done = True
            return
        for v in (0, 1):  # what one view is sure of teaches the other
            self.gained[1 - v].append(new[v])
        self.fit()

    @property
    def exchanged(self) -> int:
        return sum(len(g[0]) for gained in self.gained for g in gained)


def co_train(fits: list[Fit], pool: Pool, rounds: int = ROUNDS, max_join: int = MAX_JOIN) -> None:
    """Rounds of exchange for several fits together: the pool is read for all at once."""
    take = max(1, min(pool.n // 4, max_join) // max(1, rounds))
    for _ in range(rounds):
        open_fits = [f for f in fits if not f.done]
        if not open_fits or not pool.n:
            break
        got = pool.pick([w for f in open_fits for w in f.wishes(take)])
        for i, f in enumerate(open_fits):
            f.learn(got[2 * i : 2 * i + 2])


@dataclass
class Model:
    views: list[Logistic] | None = None
    last: Logistic | None = None
    exchanged: int = 0

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.views is None:
            half = np.full(len(text), 0.5)
            return half, half, half
        odds = [m.log_odds(x) for m, x in zip(self.views, (text, meta), strict=True)]
        return probability(self.last.log_odds(np.stack(odds, 1))), probability(odds[0]), probability(odds[1])


def folds_of(y: np.ndarray, n: int = 3) -> np.ndarray:
    """A fold of each row; the classes are dealt apart, so that two rows of a class never share all folds."""
    rng, fold = np.random.default_rng(len(y)), np.zeros(len(y), int)
    for label in (0, 1):
        at = np.flatnonzero(y == label)
        fold[at] = rng.permutation(len(at)) % n
    return fold


def train_arrays(text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool: Pool, rounds: int = ROUNDS, max_join: int = MAX_JOIN) -> Model:
    fold = folds_of(y)
    whole, parts = Fit([text, meta], y), {}
    for f in range(3):  # views that haven't seen a fold rate it, for calibration
        a = fold != f
        if len(set(y[a].tolist())) == 2:
            parts[f] = Fit([text[a], meta[a]], y[a])
    co_train([whole, *parts.values()], pool, rounds, max_join)
    odds = np.zeros((len(y), 2))
    for f in range(3):
        b = fold == f
        odds[b] = np.stack([m.log_odds(x[b]) for m, x in zip(parts.get(f, whole).models, (text, meta), strict=True)], 1)
    return Model(whole.models, Logistic.fit(odds, y), whole.exchanged)


COLUMNS = ("lang", "source", "n_chars")


def _input(docs: DataFrame) -> DataFrame:
    kinds = {"lang": "string", "source": "string", "n_chars": "double"}
    have = [F.col(c).cast(kinds[c]).alias(c) if c in docs.columns else F.lit(None).cast(kinds[c]).alias(c) for c in COLUMNS]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *have)


def _both(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return text_features(batch.column(1)), meta_features(*(batch.column(i).to_pylist() for i in (2, 3, 4)))


def featurise(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, meta = _both(batch)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(text), pa.list_(pa.float64())), pa.array(list(meta), pa.list_(pa.float64()))], names=["doc_id", "t", "m"])

    return _input(docs).mapInArrow(run, "doc_id long, t array<double>, m array<double>")


def train(docs: DataFrame, labels: DataFrame, usable=None, max_train: int = MAX_TRAIN, max_join: int = MAX_JOIN, rounds: int = ROUNDS) -> Model:
    known = labels.filter("doc_id is not null and quality is not null").select("doc_id", F.col("quality").cast("int").alias("quality"))
    # contradicting labels count as the lower one; of several rows of an id the greatest stands for it
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.filter(usable) if usable is not None else known
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    some = _input(docs).join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")
    rows = some.groupBy("doc_id").agg(F.max(F.struct("text", *COLUMNS)).alias("row")).select("doc_id", "row.*")
    found = featurise(rows).join(F.broadcast(known), "doc_id").orderBy("doc_id").toPandas()
    y = found["quality"].to_numpy(float)
    if len(set(y.tolist())) < 2:
        return Model()
    text, meta = np.stack(found["t"].to_numpy()), np.stack(found["m"].to_numpy())
    return train_arrays(text, meta, y, Pool(docs, labels), rounds, max_join)


THRESHOLD = 0.5
SCHEMA = "doc_id long, score double, text_score double, meta_score double"


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` (of being good), each view's score, ``keep``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in model.score(*_both(batch)))], names=["doc_id", "score", "text_score", "meta_score"])

    return _input(docs).mapInArrow(run, SCHEMA).withColumn("keep", F.col("score") >= THRESHOLD)


def op1_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
