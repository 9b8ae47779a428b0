"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves pre-tokens that are tokens themselves.
Tier two: the others are merged by a heap of pairs over linked byte spans, lowest rank and leftmost first.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helio.llm.textgrams import mix, span_hashes

U64 = np.uint64
#: White space as the Rust regex library has it; Python's classes also count U+001C to U+001F.
SPACE = r"\t-\r \x85\xa0  -     　"


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of tokens from lines of base64 and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def compile_pattern(pattern: str) -> regex.Pattern:
    """The pre-token pattern with white space spelt out."""
    pattern = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")
    return regex.compile(pattern)


def _hashes(tokens: list[bytes]) -> np.ndarray:
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]])
    return span_hashes(np.frombuffer(b"".join(tokens), np.uint8), starts, ends)


class PerfectHash:
    """Minimal perfect hash by displacement: n keys, n slots; a slot holds its key and the key's value (its place among the keys unless ``values`` are given).

    Keys fall into n/2 buckets; large buckets first, each takes the least displacement that puts its keys
    into free slots; buckets of one key name a free slot themselves.
    """

    def __init__(self, keys: list[bytes], values: list[int] | None = None):
        self.size, self.buckets = len(keys), max(1, len(keys) // 2)
        h = _hashes(keys) if keys else np.zeros(0, U64)
        if len(np.unique(h)) != len(keys):
            raise ValueError("keys must be distinct")
        self.shift, self.slot_key = np.zeros(self.buckets, np.int64), [b""] * self.size
        of = (h % U64(self.buckets)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        edges = np.searchsorted(of[order], np.arange(self.buckets + 1))
        free = np.ones(self.size, bool)
        sizes = np.diff(edges)
        for b in np.argsort(-sizes, kind="stable"):
            mine = order[edges[b] : edges[b + 1]]
            if len(mine) < 2:
                break
            for d in range(0, 1 << 40, 64):  # 64 displacements at a time
                tried = self._slots(h[mine][None, :], np.arange(d, d + 64, dtype=U64)[:, None])
                apart = np.diff(np.sort(tried, axis=1), axis=1).all(1) & free[tried].all(1)
                if apart.any():
                    break
            d += int(apart.argmax())
            slots = tried[d % 64]
            self.shift[b], free[slots] = d, False
            for k, s in zip(mine, slots, strict=True):
                self.slot_key[s] = keys[k]
        rest = np.flatnonzero(free)
        for b, s in zip(np.flatnonzero(sizes == 1), rest, strict=True):
            self.shift[b], self.slot_key[s] = -1 - s, keys[order[edges[b]]]
        of_key = dict(zip(keys, range(len(keys)) if values is None else values, strict=True))
        self.slot_value = [of_key[k] for k in self.slot_key]

    def _slots(self, h: np.ndarray, d) -> np.ndarray:
        return (mix(h + d * U64(0x9E3779B97F4A7C15) + U64(1)) % U64(max(1, self.size))).astype(np.int64)

    @classmethod
    def of_ranks(cls, ranks: dict[bytes, int]) -> PerfectHash:
        return cls(list(ranks), list(ranks.values()))

    def find(self, tokens: list[bytes]) -> list[int | None]:
        """The value of each token that is a key, else None."""
        if not self.size:
            return [None] * len(tokens)
        h = _hashes(tokens)
        d = self.shift[(h % U64(self.buckets)).astype(np.int64)]
        slot = np.where(d < 0, -1 - d, self._slots(h, np.maximum(d, 0).astype(U64)))
        keys, values = self.slot_key, self.slot_value
        return [values[s] if keys[s] == t else None for s, t in zip(slot.tolist(), tokens, strict=True)]


def merge(word: bytes, rank_of) -> tuple[int, ...]:
    """Ids of one pre-token: pairs of linked spans leave a heap by rank, then by place; stale pairs are passed over."""
    n = len(word)
    # The rank of the pair of spans that begins at each place, -1 where there is none; what a heap entry must still equal.
    pair = [rank_of(word[i : i + 2], -1) for i in range(n - 1)]
    pair.append(-1)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [r << 32 | i for i, r in enumerate(pair) if r >= 0]
    heapify(heap)
    while heap:
        top = heappop(heap)
        i = top & 0xFFFFFFFF
        if pair[i] != top >> 32:
            continue
        j = after[i]
        k = after[i] = after[j]
        pair[j] = -1
        if k < n:
            before[k] = i
            r = pair[i] = rank_of(word[i : after[k]], -1)
            if r >= 0:
                heappush(heap, r << 32 | i)
        else:
            pair[i] = -1
        p = before[i]
        if p >= 0:
            r = pair[p] = rank_of(word[p:k], -1)
            if r >= 0:
                heappush(heap, r << 32 | p)
    out, i = [], 0
    while i < n:
        j = after[i]
        out.append(rank_of(word[i:j]))
        i = j
    return tuple(out)


class Codec:
    """Encoder and decoder for one vocabulary; every single byte must be a token. Keeps the pre-tokens met lately (two generations)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, table: PerfectHash | None = None, memory: int = 250_000):
        self.ranks, self.pattern, self.memory = ranks, compile_pattern(pattern), memory
        self.table = table or PerfectHash.of_ranks(ranks)
        self.ids: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        size = max(ranks.values(), default=-1) + 1
        self.lengths = np.zeros(size, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(t for t, _ in sorted(ranks.items(), key=lambda x: x[1])), np.uint8)

    def _learn(self, new: list[str]) -> None:
        if len(self.ids) > self.memory:
            self.old, self.ids = self.ids, {}
        raw = [t.encode("utf-8", "surrogatepass") for t in new]
        rank_of = self.ranks.get
        for t, b, rank in zip(new, raw, self.table.find(raw), strict=True):
            self.ids[t] = merge(b, rank_of) if rank is None else (rank,)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        split = [self.pattern.findall(t) for t in texts]
        met = set(chain.from_iterable(split))
        new = []
        for t in met.difference(self.ids):
            known = self.old.get(t)
            if known is None:
                new.append(t)
            else:
                self.ids[t] = known
        if new:
            keep = self.ids
            self._learn(new)
            if self.ids is not keep:  # a new generation began: this call still needs what it knew
                self.ids.update((t, keep[t]) for t in met if t in keep)
        return [list(chain.from_iterable(map(self.ids.__getitem__, s))) for s in split]

    def decode(self, ids: Iterable[int]) -> bytes:
        """Bytes of some ids; an id outside the vocabulary raises IndexError."""
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return b""
        if ids.min() < 0 or ids.max() >= len(self.lengths):
            raise IndexError("no such token")
        size = self.lengths[ids]
        shift = np.repeat(self.places[ids] - (np.cumsum(size) - size), size)
        return self.flat[shift + np.arange(len(shift))].tobytes()


_codecs: dict = {}


@contextmanager
def _without_gc():
    """Nothing here makes cycles, and scanning a few hundred thousand kept tuples takes long; other operators of the worker get the collector back."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def _codec(shared) -> Codec:
    """One codec a worker process and broadcast, so that what it has met serves its later tasks too."""
    key, *parts = shared.value
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(*parts)
    return _codecs[key]


def _encoded(codec: Codec, texts: list[str | None]) -> Iterator[tuple[int, list[int]]]:
    """(index, ids) of each text, in runs that fit in memory; a text is never cut."""
    run, size = [], 0
    for i, t in enumerate(texts):
        run.append(t or "")
        size += len(run[-1])
        if size > 2_000_000 or i + 1 == len(texts):
            yield from zip(range(i + 1 - len(run), i + 1), codec.encode(run), strict=True)
            run, size = [], 0


def bpe_encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ids (array of int). A null or empty text has no ids, an empty table no rows. No special tokens."""
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, ranks, pattern, PerfectHash.of_ranks(ranks)))

    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            with _without_gc():
                ids = pa.array([ids for _, ids in _encoded(codec, batch.column("_text").to_pylist())], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(id_col), ids], [id_col, "ids"])

    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, f"{id_col} {rows.schema[id_col].dataType.simpleString()}, ids array<int>")


def bpe_decode(encoded: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: ``id_col``, bytes (binary). Null ids decode to no bytes."""
    shared = encoded.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, ranks, pattern, PerfectHash.of_ranks(ranks)))

    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            out = [codec.decode(ids or []) for ids in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(out, pa.binary())], [id_col, "bytes"])

    rows = encoded.select(F.col(id_col), F.col(ids_col).alias("_ids"))
    return rows.mapInArrow(run, f"{id_col} {rows.schema[id_col].dataType.simpleString()}, bytes binary")


def bpe_round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each text and decode its ids again in one pass; digests of both: ``id_col``, n_tokens, ids_sha256, decoded_sha256.

    The first digest is of the decimal ids joined by commas, the second of the decoded bytes, both lowercase
    hex. Null counts as empty. Rows come back as often as they are given; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, ranks, pattern, PerfectHash.of_ranks(ranks)))

    def run(batches):
        codec = _codec(shared)
        decimal = [str(i) for i in range(len(codec.lengths))].__getitem__
        for batch in batches:
            out = [[], [], []]
            with _without_gc():
                for _, ids in _encoded(codec, batch.column("_text").to_pylist()):
                    out[0].append(len(ids))
                    out[1].append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                    out[2].append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, f"{id_col} {rows.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
