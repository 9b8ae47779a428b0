"""Alignment of two tokenizers' tokens by their byte ends: diagonal run skipping, and corpus-wide counts of linked ids.

Both tokenizers encode a space and the text. Where a token of either ends at the same byte, the texts are cut
into groups; each token of a group is linked with each of the other tokenizer in it. Between two cuts that lie one token
apart on both sides the index shift stays, so the arrays of ends are compared at that shift in stretches of doubling
length; only where they part, a group is resolved end by end and the shift updated.

A task tokenizes its rows once. Beside a row for each document it writes one for each block of documents with the
distinct id pairs of the block and the number of documents that hold each; these are summed over the corpus, and each
block gets back the counts of its own pairs. So texts are not shuffled, and no table of all pairs is broadcast.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helio.llm.common import cut
from helio.llm.packing import load_encoding

#: A block ends at so many distinct pairs or bytes of text; texts are encoded in lots of LOT_BYTES.
BLOCK_PAIRS, BLOCK_BYTES, LOT_BYTES = 400_000, 48 << 20, 1 << 20
#: Groups with more links are expanded by distinct ids, so that a text without a common end needs no product of its tokens.
WIDE = 4096
DOC = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


class Tokenizers:
    """Both tokenizers from their files, how many bytes each id spells, and its text in front of a separator."""

    def __init__(self, byte_bpe: str, pieces: str) -> None:
        ranks, _, pattern = load_encoding(byte_bpe)
        self.a = tiktoken.Encoding("align", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.len_a = np.zeros(max(ranks.values()) + 1, np.int64)
        self.len_a[list(ranks.values())] = [len(token) for token in ranks]
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            code = re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece)
            self.bytes_b.append(bytes([int(code[1], 16)]) if code else piece.replace("▁", " ").encode())
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # A's ids end with "," or, last of a group, "|"; B's with "," or ";".
        n = max(len(self.len_a), len(self.len_b))
        self.text = [b"%d%s" % (i, sep) for i in range(n) for sep in (b",", b"|", b";")]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids by either of a space and each text; none where the bytes of its tokens are not those of the text, or it is empty."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            raw = b" " + text.encode()
            a = self.a.encode_ordinary(" " + text)
            if not text or b"".join(map(self.bytes_b.__getitem__, b)) != raw or self.a.decode_bytes(a) != raw:
                a, b = (), ()
            out.append((np.asarray(a, np.int64), np.asarray(b, np.int64)))
        return out


def align_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of tokens of either up to each common end. Both arrays rise and have the same last end (or are empty)."""
    n = len(ends_a)
    x, y = np.append(ends_a, -1).astype("<i8"), np.append(ends_b, -2).astype("<i8")  # the last ones differ, so nothing runs over the end
    raw_a, raw_b, a, b = x.tobytes(), y.tobytes(), x.tolist(), y.tolist()
    i = j = 0  # tokens before the cut; the shift is j - i
    last, other, size = [], [], []  # tokens up to the end of each stretch, and its groups: one where it is irregular
    while i < n:
        if a[i] == b[j]:
            start, step = i, 2
            i, j = i + 1, j + 1
            while raw_a[8 * i : 8 * (i + step)] == raw_b[8 * j : 8 * (j + step)]:  # doubling while the ends agree at this shift
                i, j, step = i + step, j + step, step * 2
            while step > 8:  # then halving down to where they part
                step //= 2
                if raw_a[8 * i : 8 * (i + step)] == raw_b[8 * j : 8 * (j + step)]:
                    i, j = i + step, j + step
            while a[i] == b[j]:
                i, j = i + 1, j + 1
            last.append(i)
            other.append(j)
            size.append(i - start)
        else:
            u, v = a[i], b[j]
            while u != v:
                if u < v:
                    i += 1
                    u = a[i]
                else:
                    j += 1
                    v = b[j]
            i, j = i + 1, j + 1
            last.append(i)
            other.append(j)
            size.append(1)
    sizes = np.array(size, np.int64)
    back = np.repeat(np.cumsum(sizes), sizes) - 1 - np.arange(int(sizes.sum()))  # groups from each to the end of its stretch
    return np.repeat(np.array(last, np.int64), sizes) - back, np.repeat(np.array(other, np.int64), sizes) - back


def _links(ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, pair (A's id << 32 | B's id) and occurrences of the links of all groups; a wide group has a row for each distinct pair."""
    p, q = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    wide = p * q > WIDE
    n = np.where(wide, 0, p * q)
    group = np.repeat(np.arange(len(p)), n)
    k = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
    pairs = ids_a[(cut_a - p)[group] + k // q[group]] << 32 | ids_b[(cut_b - q)[group] + k % q[group]]
    occurs = np.ones(len(group), np.int64)
    for g in np.flatnonzero(wide):
        (a, na), (b, nb) = (np.unique(x[c[g] - w[g] : c[g]], return_counts=True) for x, c, w in ((ids_a, cut_a, p), (ids_b, cut_b, q)))
        group, pairs, occurs = np.append(group, np.full(len(a) * len(b), g)), np.append(pairs, (a[:, None] << 32 | b).ravel()), np.append(occurs, (na[:, None] * nb).ravel())
    return group, pairs, occurs


class _Lot:
    """Texts aligned together: their tokens stand one behind another, so one pass over the ends serves them all."""

    def __init__(self, t: Tokenizers, texts: list[str]) -> None:
        ids = t.encode(texts)
        self.a, self.b = (np.concatenate([x[k] for x in ids]) if ids else np.zeros(0, np.int64) for k in (0, 1))
        self.n_a, self.n_b = (np.array([len(x[k]) for x in ids], np.int64) for k in (0, 1))
        self.ends = np.cumsum(t.len_a[self.a])
        self.cut_a, self.cut_b = align_ends(self.ends, np.cumsum(t.len_b[self.b]))
        self.doc = np.searchsorted(np.cumsum(self.n_a), self.cut_a - 1, "right")  # of each group
        self.p, self.q = np.diff(self.cut_a, prepend=0), np.diff(self.cut_b, prepend=0)
        self.n_groups = np.bincount(self.doc, minlength=len(ids))
        self.n_links = np.bincount(self.doc, self.p * self.q, len(ids)).astype(np.int64)

    def digests(self, t: Tokenizers) -> list[str]:
        """Of each text's groups as ``a1,a2|b1;a3|b2,b3``; the empty text for one without tokens."""
        groups = np.arange(len(self.p))
        of_a, of_b = np.repeat(groups, self.p), np.repeat(groups, self.q)
        merged = np.zeros(len(self.a) + len(self.b), np.int64)
        sep_a, sep_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        sep_a[self.cut_a - 1], sep_b[self.cut_b - 1] = 1, 2
        merged[np.arange(len(self.a)) + (self.cut_b - self.q)[of_a]] = self.a * 3 + sep_a
        merged[np.arange(len(self.b)) + self.cut_a[of_b]] = self.b * 3 + sep_b
        stop, out, parts = np.cumsum(self.n_a + self.n_b), [], merged.tolist()
        for lo, hi in zip([0, *stop[:-1].tolist()], stop.tolist(), strict=True):
            out.append(hashlib.sha256(b"".join(map(t.text.__getitem__, parts[lo:hi]))[:-1]).hexdigest() if hi > lo else "")
        return out


def _lots(batches, key: str, most: int):
    """(ids, texts) of about ``most`` characters each."""
    for batch in batches:
        texts, lo, size = batch.column("_text").to_pylist(), 0, 0
        for k, text in enumerate(texts):
            size += len(text or "")
            if size >= most or k + 1 == len(texts):
                yield batch.column(key).slice(lo, k + 1 - lo), [x or "" for x in texts[lo : k + 1]]
                lo, size = k + 1, 0


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, behind that number."""
    width = next(w for w in (1, 2, 4, 8) if not len(x) or int(x.max()) < 1 << 8 * w - (w == 8))
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def _unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(x, f"<u{x[0]}", offset=1).astype(np.int64)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))


def aligned_blocks(docs: DataFrame, byte_bpe: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document (_id, DOC, and its distinct pairs as places in the block's list, with occurrences) and one for each block (pairs, docs), told apart by ``_block_row``."""

    def run(batches):
        from pyspark import TaskContext

        t, task = Tokenizers(byte_bpe, pieces), TaskContext.get().partitionId()
        number, known, counts, size, schema = 0, {}, np.zeros(0, np.int64), 0, None

        def block_row():
            held = {"_block": [task << 32 | number], "_block_row": [True], "pairs": [np.fromiter(known, np.int64, len(known))], "docs": [counts]}
            return pa.RecordBatch.from_arrays([pa.array(held.get(f.name, [None]), f.type) for f in schema], schema=schema)

        for ids, texts in _lots(batches, "_id", LOT_BYTES):
            schema = schema or pa.schema([("_id", ids.type), *[(c, pa.string() if k == "string" else pa.int64()) for c, k in (x.split() for x in DOC.split(", "))], ("_block", pa.int64()), ("_block_row", pa.bool_()), ("places", pa.binary()), ("occurs", pa.binary()), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64()))])
            lot = _Lot(t, texts)
            group, pairs, occurs = _links(lot.a, lot.b, lot.cut_a, lot.cut_b)
            distinct, local = np.unique(pairs, return_inverse=True)
            place = np.array([known.setdefault(x, len(known)) for x in distinct.tolist()], np.int64)[local] if len(pairs) else pairs
            keys, back = np.unique(lot.doc[group] << 32 | place, return_inverse=True)
            occurs = np.bincount(back, occurs, len(keys)).astype(np.int64)
            of_doc, place = keys >> 32, keys & 0xFFFFFFFF
            before, counts = counts, np.bincount(place, minlength=len(known))
            counts[: len(before)] += before
            edges = np.searchsorted(of_doc, np.arange(len(texts) + 1))
            spans = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
            n = len(texts)
            columns = [ids, *(pa.array(x, pa.int64()) for x in (lot.n_a, lot.n_b, lot.n_groups, lot.n_links)), pa.array(lot.digests(t)), pa.array([task << 32 | number] * n, pa.int64()), pa.array([False] * n)]
            columns += [pa.array([_packed(x[lo:hi]) for lo, hi in spans], pa.binary()) for x in (place, occurs)]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))], schema=schema)
            size += sum(map(len, texts))
            if size >= BLOCK_BYTES or len(known) >= BLOCK_PAIRS:
                yield block_row()
                number, known, counts, size = number + 1, {}, np.zeros(0, np.int64), 0
        if known:
            yield block_row()

    rows = _rows(docs, id_col, text_col)
    return rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, {DOC}, _block long, _block_row boolean, places binary, occurs binary, pairs array<long>, docs array<long>")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """a_id, b_id, n_docs (documents that hold the pair linked) and is_best (no other pair of a_id has more), from ``aligned_blocks``."""
    each = blocks.where("_block_row").select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).select((F.shiftright("x.pairs", 32)).cast("int").alias("a_id"), F.col("x.pairs").bitwiseAND(0xFFFFFFFF).cast("int").alias("b_id"), F.col("x.docs").alias("n"))
    counts = each.groupBy("a_id", "b_id").agg(F.sum("n").alias("n_docs"))
    most = counts.groupBy("a_id").agg(F.max("n_docs").alias("_most"))
    return counts.join(most, "a_id").select("a_id", "b_id", "n_docs", (F.col("n_docs") == F.col("_most")).alias("is_best"))


def align_documents(docs: DataFrame, byte_bpe: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of ``docs``: ``id_col``, numbers of tokens, groups and links, those of links whose pair ``is_best``, the sum of the links' ``n_docs``, the digest of the groups.

    A null or empty text has no tokens, nor has one that the tokens of either tokenizer do not spell; its numbers are 0
    and its digest is the empty text. Repeated rows and ids, also null ones, are documents of their own. An empty table
    gives no rows, other columns are not read. A text has to fit in a task some tens of times over.
    """
    blocks = cut(aligned_blocks(docs, byte_bpe, pieces, id_col, text_col))
    each = blocks.where("_block_row").select("_block", F.posexplode("pairs").alias("_place", "_pair"))
    each = each.select("_block", "_place", F.shiftright("_pair", 32).cast("int").alias("a_id"), F.col("_pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b_id"))
    known = each.join(pair_counts(blocks), ["a_id", "b_id"]).select(F.col("_block").alias("_of"), "_place", "n_docs", "is_best")

    def add(rows: pa.Table, counts: pa.Table) -> pa.Table:
        n, best = np.zeros(counts.num_rows, np.int64), np.zeros(counts.num_rows, np.int64)
        place = counts.column("_place").to_numpy()
        n[place], best[place] = counts.column("n_docs").to_numpy(), counts.column("is_best").to_numpy().astype(np.int64)
        best_of, sum_of = [], []
        for places, occurs in zip(rows.column("places").to_pylist(), rows.column("occurs").to_pylist(), strict=True):
            p, o = _unpacked(places), _unpacked(occurs)
            best_of.append(int(best[p] @ o))
            sum_of.append(int(n[p] @ o))
        kept = [rows.column(c) for c in ("_id", "n_a", "n_b", "n_groups", "n_links")]
        return pa.table([*kept, pa.array(best_of, pa.int64()), pa.array(sum_of, pa.int64()), rows.column("groups_sha256")], [id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    found = blocks.where("NOT _block_row").drop("_block_row", "pairs", "docs")
    kind = blocks.schema["_id"].dataType.simpleString()
    return found.groupBy("_block").cogroup(known.groupBy("_of")).applyInArrow(add, f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def token_groups(docs: DataFrame, byte_bpe: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The groups themselves: ``id_col`` and groups, an array of (end: bytes up to the cut, a: ids, b: ids) in order; empty as in ``align_documents``."""

    def run(batches):
        t = Tokenizers(byte_bpe, pieces)
        for ids, texts in _lots(batches, "_id", LOT_BYTES):
            lot, out = _Lot(t, texts), [[] for _ in texts]
            before = np.concatenate([[0], lot.ends])[np.cumsum(lot.n_a) - lot.n_a]  # bytes in front of each text
            for d, i, j, p, q in zip(*(x.tolist() for x in (lot.doc, lot.cut_a, lot.cut_b, lot.p, lot.q)), strict=True):
                out[d].append({"end": int(lot.ends[i - 1] - before[d]), "a": lot.a[i - p : i].tolist(), "b": lot.b[j - q : j].tolist()})
            yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.list_(pa.struct([("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])))], [id_col, "groups"])

    rows = _rows(docs, id_col, text_col)
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema['_id'].dataType.simpleString()}, groups array<struct<end:long,a:array<int>,b:array<int>>>")
