"""Toxicity: a lexicon trie met with Levenshtein automata, scored in context windows.

The lexicon is learned from labelled rows: words, and word beginnings, that
stand far more often in toxic texts than elsewhere. Its terms form a trie. The
product of that trie with the Levenshtein automaton of the term (one edit from
five letters up, two from ten) is determinised on demand: a word is read letter
by letter and almost every word dies within its first few letters. Each hit is
weighed by its window: a hit between quotation marks or near a reporting mark
counts as quotation, another as abuse. A logistic model over the counts per
document gives the score. Every term with the support and the odds is kept; their
number is bounded by the sample they come from. Counts of hits are clipped at 3. Everything is fitted on a bounded sample of labelled
rows (``max_train``, by hash of the id); every text is scored whole.

Defined results: a null or empty text has no hits and gets the score of a text
without any. Labels that are null or whose document is missing are left out.
Without both classes among the labels the score is 0. Repeated rows each return
a row. Columns other than ``doc_id`` and ``text`` are ignored. Empty tables
return no rows.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from corpusloom.session import stage_table

MAX_TRAIN = 6_000
WORD = re.compile(r"[^\W\d_]+(?:[@$!0134][^\W\d_]+)*")
LEET = str.maketrans("@$!0134", "asioiea")
QUOTES = "\"“”„«»'‘’>"
REPORTING = re.compile(r"(?:said|says|wrote|quote|quoted|called|term|word|zitat|sagte|dit|écrit|dijo|escribió)\W+$", re.I)
MIN_SUPPORT, MIN_ODDS = 6, 2.8
PREFIX_LENGTHS = range(3, 9)
WINDOW = 48
N_FEATURES = 8
#: What a worker remembers: words and the letters of the longest, moves of the automaton.
KEPT_WORDS, KEPT_LETTERS, KEPT_MOVES = 200_000, 64, 150_000


def normal(word: str) -> str:
    return unicodedata.normalize("NFC", word).lower().translate(LEET)


class Automaton:
    """The trie of the terms met with the Levenshtein automaton of the word read, made deterministic on demand.

    A state is a set of (trie node, edits used). A plain term must end where
    the word ends; a beginning (``*`` at its end) accepts whatever follows and
    takes no edits.
    """

    def __init__(self, terms: dict[str, float]):
        self.next: list[dict[str, int]] = [{}]
        self.reach = [0]  # the most edits that any term below may take
        self.end: list[tuple[str, int] | None] = [None]
        self.head: list[str | None] = [None]
        self.weight = terms
        for term in sorted(terms):
            stem = term.rstrip("*")
            most = 0 if term.endswith("*") else (2 if len(stem) >= 10 else 1 if len(stem) >= 5 else 0)
            node = 0
            self.reach[0] = max(self.reach[0], most)
            for c in stem:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({}), self.reach.append(0), self.end.append(None), self.head.append(None)
                node = self.next[node][c]
                self.reach[node] = max(self.reach[node], most)
            if term.endswith("*"):
                self.head[node] = term
            else:
                self.end[node] = (term, most)
        self.none: set[str] = set()  # words seen, without and with a match
        self.some: dict[str, tuple[str, int]] = {}
        self._reset()

    def _reset(self) -> None:
        """Forget all states but the first and the dead one. A state is kept once, under its number."""
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, tuple[int, str | None]]] = []
        self.finals: list[tuple[str, int] | None] = []
        self.made = 0
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        self.dead = self._number(set())
        self.start = self._number({(0, 0)})

    def _number(self, states: set[tuple[int, int]]) -> int:
        closed = self._close(states)
        at = self.numbers.setdefault(closed, len(self.sets))
        if at == len(self.sets):
            ends = [(used, -len(self.end[node][0]), self.end[node][0]) for node, used in closed if self.end[node] and used <= self.end[node][1]]
            best = min(ends, default=None)
            self.sets.append(closed), self.moves.append({}), self.finals.append(best and (best[2], best[0]))
        return at

    def _close(self, states: set[tuple[int, int]]) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:  # letters of the term that the word lacks
            node, used = todo.pop()
            for child in self.next[node].values():
                s = (child, used + 1)
                if used < self.reach[child] and s not in seen:
                    seen.add(s), todo.append(s)
        least: dict[int, int] = {}
        for node, used in seen:
            least[node] = min(used, least.get(node, 9))
        return frozenset(self.pairs.setdefault(s, s) for s in least.items())

    def _move(self, state: int, c: str) -> tuple[int, str | None]:
        out, head = set(), None
        for node, used in self.sets[state]:
            if used < self.reach[node]:
                out.add((node, used + 1))  # a letter too many
            for letter, child in self.next[node].items():
                cost = used + (letter != c)
                if cost <= self.reach[child] or cost == 0:
                    out.add((child, cost))
                    if cost == 0 and self.head[child]:
                        head = self.head[child]
        move = self.moves[state][c] = self._number(out), head
        self.made += 1
        return move

    def known(self, words: set[str]) -> dict[str, tuple[str, int]]:
        """The matches of words as they are written; longer ones than ``KEPT_LETTERS`` aren't remembered."""
        found = {}
        for word in words.difference(self.none):
            hit = self.some.get(word)
            if hit is None:
                hit = self.match(normal(word))
                if len(word) <= KEPT_LETTERS:
                    if len(self.none) + len(self.some) >= KEPT_WORDS:
                        self.none.clear(), self.some.clear()
                    if hit:
                        self.some[word] = hit
                    else:
                        self.none.add(word)
            if hit:
                found[word] = hit
        return found

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its distance; ties: the longer, then the first term. None if none is in reach."""
        if self.made > KEPT_MOVES:
            self._reset()
        state, head, moves, dead = self.start, None, self.moves, self.dead
        for c in word:
            state, at = moves[state].get(c) or self._move(state, c)
            head = at or head
            if state == dead:
                break
        found = self.finals[state]
        if head and (found is None or found[1]):
            found = (head, 0)
        return found


def quoted(text: str, start: int, end: int) -> bool:
    """Whether the window around a hit marks it as a quotation."""
    left, right = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    return any(q in left[-24:] for q in QUOTES) and any(q in right[:24] for q in QUOTES) or bool(REPORTING.search(left))


def hits(text: str | None, auto: Automaton) -> list[tuple[int, int, str, int, bool]]:
    """Spans of lexicon hits: start, end, term, edits, quoted."""
    known = auto.known(set(WORD.findall(text or "")))
    if not known:
        return []
    return [(m.start(), m.end(), *known[m.group()], quoted(text, m.start(), m.end())) for m in WORD.finditer(text) if m.group() in known]


def features(text: str | None, auto: Automaton) -> list[float]:
    exact = near = said = weight = heads = 0.0
    kinds = set()
    for _, _, term, edits, cited in hits(text, auto):
        kinds.add(term)
        if cited:
            said += 1
        elif term.endswith("*"):
            heads += 1
        elif edits:
            near += 1
        else:
            exact += 1
        weight += auto.weight[term] * (0.3 if cited else 1.0) * (0.7**edits)
    words = (text or "").count(" ") + 1
    return [min(exact, 3), min(near, 3), min(heads, 3), min(said, 3), float(exact + near > 0), float(heads > 0), np.log1p(weight), min(1.0, 40 * weight / (words + 40) / 4)]


def terms_of(text: str | None) -> set[str]:
    """The words of a text in normal form, and their beginnings with ``*``."""
    words = {normal(m.group()) for m in WORD.finditer(text or "")}
    return words | {w[:n] + "*" for w in words for n in PREFIX_LENGTHS if len(w) >= n}


def learn_terms(texts: list[str], labels: np.ndarray) -> dict[str, float]:
    """Terms (``x``) and beginnings (``x*``) with their log odds of toxic against other texts."""
    counts = (Counter(), Counter())
    for text, y in zip(texts, labels, strict=True):
        counts[y].update(terms_of(text))
    return choose_terms(counts, [int((labels == c).sum()) for c in (0, 1)])


def choose_terms(counts: tuple[Counter, Counter], sizes: list[int]) -> dict[str, float]:
    """The lexicon, of the numbers of other and of toxic texts that hold each term."""
    sizes = [max(1, n) for n in sizes]
    odds = {}
    for term, c in counts[1].items():
        if c >= MIN_SUPPORT:
            o = np.log((c + 0.5) / (sizes[1] + 1)) - np.log((counts[0][term] + 0.5) / (sizes[0] + 1))
            if o >= MIN_ODDS:
                odds[term] = float(o)
    kept: dict[str, float] = {}
    for term in sorted(odds, key=lambda t: (len(t.rstrip("*")), t)):
        stem = term.rstrip("*")
        # a beginning that is a whole word's own, or that a shorter one already covers, adds nothing
        if term.endswith("*") and (counts[1][stem] >= 0.8 * counts[1][term] or any(stem[:n] + "*" in kept for n in PREFIX_LENGTHS if n < len(stem))):
            continue
        if term.endswith("*") and any(counts[1][w] >= 0.8 * counts[1][term] for w in odds if w.startswith(stem) and not w.endswith("*")):
            continue
        if not term.endswith("*") and any(term[:n] + "*" in kept for n in PREFIX_LENGTHS):
            continue
        kept[term] = odds[term]
    return kept


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 60) -> np.ndarray:
    """Weights (the last is the bias) by Newton's method."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        grad = x1.T @ (p - y) + penalty * w
        hess = (x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, terms: dict[str, float], weights: np.ndarray):
        self.terms, self.weights, self.auto = terms, weights, None

    def __getstate__(self):
        return {"terms": self.terms, "weights": self.weights, "auto": None}

    def score(self, text: str | None) -> float:
        if not self.terms:
            return 0.0
        if self.auto is None:
            self.auto = Automaton(self.terms)
        return float(1 / (1 + np.exp(-np.clip(features(text, self.auto) @ self.weights[:-1] + self.weights[-1], -30, 30))))


def train(docs: DataFrame, labels: DataFrame, usable, max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` labelled rows for which ``usable`` (a column) holds.

    Of contradicting labels of an id the toxic one counts, of several texts the
    least. Terms are counted and features taken in the executors: what reaches
    the driver is counts of terms with some support, and features.
    """
    rows = labels.filter("doc_id is not null and toxic is not null").filter(usable).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train).withColumn("half", F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(2)).cast("int"))
    texts = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").groupBy("doc_id", "toxic", "half").agg(F.min("text").alias("text"))
    texts = stage_table(texts, "toxicity-train")
    sizes = {(r.half, r.toxic): r["count"] for r in texts.groupBy("half", "toxic").count().collect()}
    if len({y for _, y in sizes}) < 2:
        return Model({}, np.zeros(N_FEATURES + 1))

    @F.pandas_udf("array<string>")
    def terms(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted(terms_of(t)))

    found = texts.select("half", "toxic", F.explode(terms("text")).alias("term")).groupBy("term").agg(
        *[F.count_if((F.col("half") == h) & (F.col("toxic") == y)).alias(f"n{h}{y}") for h in (0, 1) for y in (0, 1)]
    )
    # a term's own support, and that of the stems it is held against, is at least 0.8 times MIN_SUPPORT
    found = found.filter(F.col("n01") + F.col("n11") >= int(0.8 * MIN_SUPPORT)).toArrow()
    names = found.column("term").to_pylist()
    n = {(h, y): dict(zip(names, found.column(f"n{h}{y}").to_pylist(), strict=True)) for h in (0, 1) for y in (0, 1)}

    def lexicon(halves: tuple[int, ...]) -> dict[str, float]:
        counts = tuple(Counter({t: c for t in names if (c := sum(n[h, y][t] for h in halves))}) for y in (0, 1))
        return choose_terms(counts, [sum(sizes.get((h, y), 0) for h in halves) for y in (0, 1)])

    # features of each half by terms of the other, so that a term's own texts don't vouch for it
    lexicons = {h: lexicon((1 - h,)) for h in (0, 1)}

    @F.pandas_udf("array<double>")
    def taken(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        autos = {h: Automaton(t) for h, t in lexicons.items()}
        for texts, halves in batches:
            yield pd.Series([features(t, autos[h]) for t, h in zip(texts, halves, strict=True)])

    table = texts.select("doc_id", "toxic", taken("text", "half").alias("x")).orderBy("doc_id").toArrow()
    x, y = np.array(table.column("x").to_pylist(), float), table.column("toxic").to_numpy().astype(int)
    return Model(lexicon((0, 1)), fit_logistic(x, y))


def score_documents(docs: DataFrame, model: Model, column: str = "toxicity") -> DataFrame:
    """``docs`` with the score as ``column`` (one of that name is replaced)."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(t) for t in texts], dtype=float)

    return docs.withColumn(column, score("text"))


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 3 == 1


THRESHOLD = 0.7


def op6_toxicity(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out())
    return score_documents(docs, model).select(
        "doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted")
    )


def crc_mod(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % 3
