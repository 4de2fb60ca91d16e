"""SentencePiece encoding and decoding on the tokenizers library, rebuilt from the model file.

The model protobuf is parsed by hand: pieces with scores and types, the
trainer's model type and byte fallback, the normaliser's character map and
flags. From these come a normaliser (character map, blanks collapsed, metaspace
marker, dummy prefix), a Unigram or BPE model with byte fallback, and a decoder.
For BPE the merges are every split of a piece into two pieces, ordered by score.

Where no piece crosses from a letter into a metaspace marker, a text's encoding
is the concatenation of its segments' (markers and what follows them). Segments
a worker doesn't know are encoded in multithreaded batches of the tokenizers
library and kept in a table of bounded size: two generations, the older of which
goes when the younger is full, by number and by characters. Longer segments than
``KEPT_CHARS`` aren't kept. The ids returned are always the tokenizers library's.
New segments of a BPE model go through the libraries joined to longer texts, which
part at the markers. The sentencepiece library encodes each new segment too; rows
with a segment on which the two differ have ``parity`` false. The rebuilt decoder turns each
segment's ids into text again; a row's texts, put together, are compared with the
row's own. A model without that property is encoded, verified and decoded by rows.

Defined results: a null or empty text has no ids and decodes to the empty text.
A text that the normaliser changes (for the identity one: a marker character of
its own) has ``round_trip`` false. Repeated rows each return a row. Columns
other than ``doc_id`` and ``text`` are ignored. An empty table returns no row.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Segments and characters of a generation of the table, and the longest segment kept.
KEPT_SEGMENTS, KEPT_TEXT, KEPT_CHARS = 150_000, 3_000_000, 64
#: Threads of the tokenizers library in a worker; rows, new segments and characters encoded together.
THREADS, ROWS, SEGMENTS, PART_BYTES = 2, 256, 4096, 1 << 20
#: New segments that are encoded as one text.
JOINED = 64


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, data[at : at + n]
            at += n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            yield tag >> 3, data[at : at + n]
            at += n
        else:
            raise ValueError(f"wire type {kind} at {at}")


@dataclass
class Spec:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    collapse: bool = True
    escape: bool = True

    @property
    def unk_id(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def parse_model(data: bytes) -> Spec:
    spec = Spec()
    for no, value in fields(data):
        if no == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            spec.pieces.append((piece, score, kind))
        elif no == 2:
            for n, v in fields(value):
                if n == 3:
                    spec.model_type = v
                elif n == 35:
                    spec.byte_fallback = bool(v)
        elif no == 3:
            for n, v in fields(value):
                if n == 2:
                    spec.charsmap = v
                elif n == 3:
                    spec.dummy_prefix = bool(v)
                elif n == 4:
                    spec.collapse = bool(v)
                elif n == 5:
                    spec.escape = bool(v)
    return spec


def normaliser(spec: Spec) -> normalizers.Normalizer:
    steps = []
    if spec.charsmap:
        steps.append(normalizers.Precompiled(spec.charsmap))
    if spec.collapse:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.dummy_prefix:
        steps.append(normalizers.Prepend(MARK if spec.escape else " "))
    if spec.escape:
        steps.append(normalizers.Replace(" ", MARK))
    return normalizers.Sequence(steps)


def build(spec: Spec) -> Tokenizer:
    usable = {p: i for i, (p, _, kind) in enumerate(spec.pieces) if kind in (NORMAL, USER_DEFINED)}
    unk = spec.pieces[spec.unk_id][0]
    if spec.model_type == UNIGRAM:
        # pieces that a text can't spell keep their places under names no text has
        names = [(p if kind in (NORMAL, USER_DEFINED, BYTE) or i == spec.unk_id else f"{p}", s) for i, (p, s, kind) in enumerate(spec.pieces)]
        model = models.Unigram(names, spec.unk_id, spec.byte_fallback)
    elif spec.model_type == BPE:
        merges = []
        for piece, i in usable.items():
            splits = [(piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in usable and piece[k:] in usable]
            merges += [(-spec.pieces[i][1], i, usable[a], usable[b], a, b) for a, b in splits]
        merges.sort()
        model = models.BPE({p: i for i, (p, _, _) in enumerate(spec.pieces)}, [m[4:] for m in merges], unk_token=unk, fuse_unk=True, byte_fallback=spec.byte_fallback)
    else:
        raise ValueError(f"model type {spec.model_type}")
    tokenizer = Tokenizer(model)
    tokenizer.normalizer = normaliser(spec)
    control = [p for p, _, kind in spec.pieces if kind == CONTROL]
    if control:  # these decode to nothing; in a text their names are ordinary text
        tokenizer.add_special_tokens(control)
        tokenizer.encode_special_tokens = True
    steps = [decoders.Metaspace(replacement=MARK, prepend_scheme="never")]
    if not spec.byte_fallback:  # with it, no text has unknown pieces
        steps.append(decoders.Replace(unk, " ⁇ "))
    tokenizer.decoder = decoders.Sequence([*steps, decoders.ByteFallback(), decoders.Fuse()])
    return tokenizer


def _pack(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def parts(texts: list[str], most: int = ROWS) -> Iterator[list[str]]:
    """``texts`` in order, in lists of at most ``most`` texts and about ``PART_BYTES`` characters."""
    at, held = 0, 0
    for i, text in enumerate(texts):
        if i > at and (i - at >= most or held + len(text) > PART_BYTES):
            yield texts[at:i]
            at, held = i, 0
        held += len(text)
    if at < len(texts):
        yield texts[at:]


class Codec:
    """Encoder and decoder of one model."""

    def __init__(self, model: bytes, kept_segments: int = KEPT_SEGMENTS):
        self.spec = parse_model(model)
        self.tokenizer = build(self.spec)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=model)
        spelled = [p for p, _, kind in self.spec.pieces if kind in (NORMAL, USER_DEFINED)]
        self.local = self.spec.escape and self.spec.dummy_prefix and not any(re.search(f"[^{MARK}]{MARK}", p) for p in spelled)
        plain = not self.spec.charsmap and not self.spec.collapse and self.spec.escape and self.spec.dummy_prefix
        self.normalise = self._plain if plain else normaliser(self.spec).normalize_str
        if self.local:  # texts are normalised before they are cut
            self.tokenizer.normalizer = normalizers.Sequence([])
        self.marked = np.array([p.startswith(MARK) for p, _, _ in self.spec.pieces])
        self.spec.pieces = [p for p in self.spec.pieces if p[2] != NORMAL]
        self.cut = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.kept = kept_segments
        self.young: dict[str, bytes] = {}  # ids as little-endian 32-bit integers
        self.old: dict[str, bytes] = {}
        self.held = 0
        self.long: list[str] = []  # segments of the rows at hand that aren't kept
        self.differ: set[str] = set()  # segments on which the libraries differ
        self.unlike: dict[str, str] = {}  # segments that decode to another text

    @staticmethod
    def _plain(text: str) -> str:
        return MARK + text.replace(" ", MARK)

    def _ask(self, segments: list[str]) -> list[list[int]]:
        """The reference's ids; it adds the first marker itself and is asked for a lone one by its name."""
        want = self.reference.encode([s[1:].replace(MARK, " ") if s.startswith(MARK) else s for s in segments], num_threads=1)
        if MARK in segments:
            want[segments.index(MARK)] = [self.reference.piece_to_id(MARK)]
        return want

    def _learn(self, segments: list[str]) -> None:
        """Segments with one marker, their first character, go through both libraries put together: their ids part at the pieces with a marker."""
        each = segments
        if self.spec.model_type == BPE:
            each, simple = [], []
            for s in segments:
                (simple if len(s) > 1 and s.rfind(MARK) == 0 else each).append(s)
            for part in parts(simple, SEGMENTS):
                each += self._learn_joined([part[i : i + JOINED] for i in range(0, len(part), JOINED)])
        self._learn_each(each)

    def _learn_joined(self, groups: list[list[str]]) -> list[str]:
        """Learns all groups on which the libraries agree and which decode to themselves; returns the segments of the others."""
        whole = ["".join(g) for g in groups]
        plain = [t.replace(MARK, " ") for t in whole]
        got = [e.ids for e in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)]
        want = self._ask(whole)
        left = []
        for g, ids, ref, back, own in zip(groups, got, want, self.tokenizer.decode_batch(got, skip_special_tokens=True), plain, strict=True):
            flat = np.array(ids, "<i4")
            cut = (4 * np.flatnonzero(self.marked[flat])).tolist()
            if ids != ref or back != own or len(cut) != len(g):
                left += g
                continue
            data = flat.tobytes()
            self.young.update(zip(g, [data[a:b] for a, b in zip(cut, [*cut[1:], len(data)], strict=True)], strict=True))
        return left

    def _learn_each(self, segments: list[str]) -> None:
        for part in parts(segments, SEGMENTS):
            got = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            want = self._ask(part)
            if got != want:
                self.differ.update(s for s, x, y in zip(part, got, want, strict=True) if x != y)
            back, own = self.tokenizer.decode_batch(got, skip_special_tokens=True), [s.replace(MARK, " ") for s in part]
            if back != own:
                self.unlike.update((s, x) for s, x, y in zip(part, back, own, strict=True) if x != y)
            self.young.update(zip(part, map(_pack, got), strict=True))

    def _ensure(self, segments: set[str]) -> None:
        """The younger generation gets all ``segments``: from the older one, or learned now."""
        new = []
        for s in segments.difference(self.young):
            ids = self.old.get(s)
            if ids is None:
                new.append(s)
            else:
                self.young[s] = ids
                self.held += len(s)
        if new:
            new.sort()  # neighbours share beginnings, which both libraries then find in the processor's cache
            self._learn(new)
            self.long = [s for s in new if len(s) > KEPT_CHARS]
            self.held += sum(map(len, new)) - sum(map(len, self.long))

    def _forget(self) -> None:
        for s in self.long:
            del self.young[s]
        self.long = []
        if len(self.young) > self.kept or self.held > KEPT_TEXT:
            self.old, self.young, self.held = self.young, {}, 0
            self.differ = {s for s in self.differ if s in self.old}
            self.unlike = {s: t for s, t in self.unlike.items() if s in self.old}
        elif len(self.differ) + len(self.unlike) > self.kept:
            self.young, self.old, self.held, self.differ, self.unlike = {}, {}, 0, set(), {}

    def round_trips(self, texts: list[str]) -> Iterator[tuple[np.ndarray, bool, str]]:
        """Ids of each text, whether both libraries agree on them, and the text they decode to."""
        for part in parts(texts):
            if not self.local:
                got = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                for ids, ref, text in zip(got, self.reference.encode(part, num_threads=1), self.decode_batch(got), strict=True):
                    yield np.array(ids, "<i4"), ids == ref, text
                continue
            whole = [self.normalise(t) if t else "" for t in part]
            split = [self.cut.findall(t) for t in whole]
            self._ensure(set().union(*split))
            ids_of = self.young.__getitem__
            for text, segments in zip(whole, split, strict=True):
                same = not self.differ or self.differ.isdisjoint(segments)
                if self.unlike and not self.unlike.keys().isdisjoint(segments):
                    text = "".join([self.unlike.get(s, s) for s in segments])
                yield np.frombuffer(b"".join(map(ids_of, segments)), "<i4"), same, self._unmark(text.replace(MARK, " "))
            self._forget()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bool]]:
        """Ids of each text, and whether both libraries agree on them."""
        return [(ids, same) for ids, same, _ in self.round_trips(texts)]

    def _unmark(self, text: str) -> str:
        return text[1:] if self.spec.dummy_prefix and text.startswith(" ") else text

    def decode_batch(self, ids: list[list[int]]) -> list[str]:
        return [self._unmark(t) for t in self.tokenizer.decode_batch(ids, skip_special_tokens=True)]

    def decode(self, ids) -> str:
        return self.decode_batch([np.asarray(ids).tolist()])[0]


def read_model(spark, path: str) -> bytes:
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as f:
        return f.read()


SCHEMA = "doc_id long, ids array<int>, n_tokens long, ids_sha256 string, parity boolean, round_trip boolean"


def encode_documents(docs: DataFrame, model_path: str = MODEL, with_ids: bool = True) -> DataFrame:
    """One row per row of ``docs``; the model's bytes go to the executors, its path needn't exist there."""
    model = docs.sparkSession.sparkContext.broadcast(read_model(docs.sparkSession, model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        codec = Codec(model.value)
        for batch in batches:
            at = 0
            while at < len(batch):
                texts, held = [], 0
                while at + len(texts) < len(batch) and len(texts) < ROWS and (not texts or held < PART_BYTES):
                    texts.append(batch.column(1)[at + len(texts)].as_py() or "")
                    held += len(texts[-1])
                n, all_ids, sha, parity, back = [], [], [], [], []
                for text, (ids, same, decoded) in zip(texts, codec.round_trips(texts), strict=True):
                    n.append(len(ids)), sha.append(hashlib.sha256(ids.tobytes()).hexdigest()), parity.append(same), back.append(decoded == text)
                    all_ids.append(ids if with_ids else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(all_ids, pa.list_(pa.int32())), pa.array(n, pa.int64()), pa.array(sha), pa.array(parity, pa.bool_()), pa.array(back, pa.bool_())],
                    names=["doc_id", "ids", "n_tokens", "ids_sha256", "parity", "round_trip"],
                )
                at += len(texts)

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
    return out if with_ids else out.drop("ids")


def op2_sentencepiece(spark, sf_dir):
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
