"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Lengths are whole numbers up to the sequence length, so the instance is its histogram: at most ``size``
counts, however many documents there are. The reduction and best-fit decreasing work on counts and give a
plan of bin patterns; pieces find their places by their rank among pieces of equal length.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helio.llm.common import cut

BUCKETS = 4096


def reduce_instance(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Fix sets that dominate every other set with their largest member; takes them out of ``counts`` (index: length).

    For the largest length j with room r beside it, sets of one or two more pieces are looked at: an exact
    fill of r; the largest single piece that fits when no two fit or when it is at least as long as any pair
    that fits; a pair (a, b) that fits with b fitting beside the largest a, if every other pair goes into a
    alone or its smaller piece goes into b. It stops where three or more small pieces fit beside j, unless r is
    filled exactly: then no single set need dominate.
    """
    size = len(counts) - 1
    fixed: list[tuple[tuple[int, ...], int]] = []

    def take(parts: tuple[int, ...]) -> None:
        need = defaultdict(int)
        for p in parts:
            need[p] += 1
        # Taking as many as there are at once is right: with fewer pieces left the set still dominates.
        n = min(counts[p] // m for p, m in need.items())
        for p, m in need.items():
            counts[p] -= n * m
        fixed.append((tuple(sorted(parts, reverse=True)), int(n)))

    j = size
    while j > 0:
        if not counts[j]:
            j -= 1
            continue
        r = size - j
        counts[j] -= 1  # the one that is looked at
        small = np.flatnonzero(counts[: r + 1])
        counts[j] += 1
        if not len(small):
            take((j,))
            continue
        one = int(small[-1])
        left = counts.copy()
        left[j] -= 1
        if one == r:
            take((j, one))
            continue
        pair = _best_pair(left, r)
        least = _least_sum(left, 3)
        if pair is None or (least > r and one >= sum(pair)):
            take((j, one))
        elif least > r and _pair_dominates(left, r, one):
            rest = left.copy()
            rest[one] -= 1
            take((j, one, int(np.flatnonzero(rest[: r - one + 1])[-1])))
        else:
            j -= 1  # nothing to fix for this length; shorter ones may still fill up exactly
    return fixed


def _least_sum(counts: np.ndarray, n: int) -> int:
    total = 0
    for s in np.flatnonzero(counts):
        m = min(n, int(counts[s]))
        total, n = total + m * int(s), n - m
        if not n:
            return total
    return 1 << 60


def _best_pair(counts: np.ndarray, room: int) -> tuple[int, int] | None:
    best = None
    have = np.flatnonzero(counts[: room + 1])
    for a in have:
        other = have[(have <= room - a) & (have <= a)]
        if len(other) and other[-1] == a and counts[a] < 2:
            other = other[:-1]
        if len(other) and (best is None or a + other[-1] > sum(best)):
            best = (int(a), int(other[-1]))
    return best


def _pair_dominates(counts: np.ndarray, room: int, a: int) -> bool:
    """Whether (a, b), b the largest beside a, dominates all singles and pairs in ``room``."""
    rest = counts.copy()
    rest[a] -= 1
    beside = np.flatnonzero(rest[: room - a + 1])
    if not len(beside):
        return False
    b = int(beside[-1])
    have = np.flatnonzero(counts[: room + 1])
    for p in have:  # p <= q: fits if p goes into b (and q, at most a, into a), or both go into a
        if p <= b:
            continue
        q = have[(have >= p) & (have <= room - p)]
        if len(q) and q[-1] == p and counts[p] < 2:
            q = q[:-1]
        if len(q) and p + q[-1] > a:
            return False
    return True


def best_fit(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: patterns and how many bins have them."""
    size = len(counts) - 1
    by_room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for s in range(size, 0, -1):
        n = int(counts[s])
        while n:
            room = next((r for r in range(s, size) if by_room.get(r)), None)
            if room is None:
                each = min(n, size // s)  # no open bin has room: fill new bins one after another
                bins = n // each
                by_room[size - each * s].append(((s,) * each, bins))
                n -= bins * each
                continue
            parts, bins = by_room[room].pop()
            # Best fit goes on in the same bin while that leaves the least room.
            each = min(room // s, n)
            for r in range(room - s, s - 1, -s):
                if any(by_room.get(x) for x in range(s, r)):
                    each = (room - r) // s
                    break
            each = max(1, each)
            used = min(bins, n // each)
            if bins > used:
                by_room[room].append((parts, bins - used))
            by_room[room - each * s].append((parts + (s,) * each, used))
            n -= used * each
    return [x for group in by_room.values() for x in group]


def make_plan(histogram: dict[int, int], size: int) -> tuple[np.ndarray, dict]:
    """Runs of places, sorted by length and first rank: length, rank, bin, per_bin, offset; and figures."""
    counts = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    total = int((counts * np.arange(size + 1)).sum())
    fixed = reduce_instance(counts)
    left = int(counts.sum())
    patterns = [x for x in fixed + best_fit(counts) if x[1]]
    rank, runs, bins = defaultdict(int), [], 0
    for parts, n in patterns:
        offset = 0
        for s in sorted(set(parts), reverse=True):
            m = parts.count(s)
            runs.append((s, rank[s], bins, m, offset))
            rank[s] += n * m
            offset += m * s
        bins += n
    figures = {"bins": bins, "bound": -(-total // size), "fixed_bins": sum(n for _, n in fixed), "pieces_after_reduction": left, "patterns": len(patterns)}
    return np.array(sorted(runs), np.int64).reshape(-1, 5), figures


def load_encoding(path: str) -> tuple[dict[bytes, int], dict[str, int], str]:
    """Ranks, special tokens and pattern of a byte-level BPE tokenizer file.

    Ids of such a vocabulary rise with merge order, so they are the ranks; a rank-based encoder then gives the
    same ids as the tokenizers library, several times faster.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
    if merged != sorted(merged):
        raise ValueError("ids do not rise with merge order")
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the public byte-to-character table of byte-level BPE
    rest = [b for b in range(256) if b not in set(printable)]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}
    return ranks, special, r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


_encoders: dict = {}


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of token ids: ``id_col``, piece, start, length, ids_crc32 and, with ``keep_ids``, ids.

    ``end_id`` follows each document's ids; a null text counts as empty, so each document has a piece. Longer
    documents are cut into pieces of ``size``, of which the first may be shorter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_encoding(tokenizer_path))

    def run(batches):
        ranks, special, pattern = shared.value
        if tokenizer_path not in _encoders:
            _encoders.clear()
            _encoders[tokenizer_path] = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        encode = _encoders[tokenizer_path].encode_to_numpy
        for batch in batches:
            rows, piece, start, length, crc, kept = [], [], [], [], [], []
            for row, text in enumerate(batch.column("_text").to_pylist()):
                ids = np.append(encode(text or "", allowed_special="all"), np.uint32(end_id)).astype("<u4")
                first = len(ids) % size or size
                for k, lo in enumerate(range(first - size, len(ids), size)):
                    part = ids[max(0, lo) : lo + size]
                    rows.append(row)
                    piece.append(k)
                    start.append(max(0, lo))
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if keep_ids:
                        kept.append(part)
            out = [batch.column(id_col).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            names = [id_col, "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                out.append(pa.array([p.tolist() for p in kept], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    schema = f"{id_col} {rows.schema[id_col].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return rows.mapInArrow(run, schema)


def pack_pieces(pieces: DataFrame, size: int = 1024) -> DataFrame:
    """Add sequence_id and offset to pieces (length and any other columns) of 1 to ``size`` tokens; places are gapless from 0.

    ``pieces`` is read several times, so cut its lineage first. Ranks are counted within buckets that rows are dealt
    to by their place in the table, so no length and no id, however common, meets in one task; at most ``size`` counts
    reach the driver.
    """
    rows = pieces.withColumn("_row", F.monotonically_increasing_id())
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(BUCKETS)))
    per_bucket = rows.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan, _ = make_plan(histogram, size)
    shared = pieces.sparkSession.sparkContext.broadcast(plan)
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = per_bucket.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_bucket").orderBy("_row")
    ranked = rows.withColumn("_rn", F.row_number().over(inside)).join(base, ["length", "_bucket"])
    ranked = ranked.select(*pieces.columns, (F.col("_base") + F.col("_rn") - 1).alias("_rank"))

    def run(batches):
        plan = shared.value
        key = (plan[:, 0] << 44) + plan[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            at = plan[np.searchsorted(key, (length << 44) + rank, "right") - 1] if len(length) else np.zeros((0, 5), np.int64)
            nth = rank - at[:, 1]
            names = [n for n in batch.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(at[:, 2] + nth // np.maximum(at[:, 3], 1)), pa.array(at[:, 4] + nth % np.maximum(at[:, 3], 1) * length)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack: one row per piece, as from ``tokenize_pieces`` and ``pack_pieces``. An empty table gives no rows."""
    return pack_pieces(cut(tokenize_pieces(docs, tokenizer_path, size, end_id, id_col, text_col, keep_ids)), size)
