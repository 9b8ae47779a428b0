"""Near-dedup with b-bit MinHash.

Texts become sets of word shingles and ``BANDS * ROWS`` minima. Bands of full minima give candidates; of each
minimum only ``BITS`` low bits stay, packed into 64-bit words, whose collision-corrected agreement sorts out
most candidates; the rest are compared as full sets. A bucket is not paired out: its members are held against
pivots first, and only members that are still in different components are compared in blocks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helio.llm.common import cut
from helio.llm.components import components, group_of
from helio.llm.textgrams import mix, span_hashes

U64 = np.uint64
BANDS, ROWS, BITS = 32, 4, 4
WORDS = BANDS * ROWS * BITS // 64
_rng = np.random.default_rng(11)
_MUL = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * U64(2) + U64(1)
_ADD = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_PLACE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)


def shingle_sets(texts: list[str | None], width: int):
    """The sorted distinct 64-bit shingle hashes of each text. Words end at ASCII white space; A-Z count as a-z."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    buf = np.frombuffer(b"\n" + b"\n".join(raw) + b"\n", np.uint8)
    edge = np.diff((~_SPACE[buf]).view(np.int8))
    starts, ends = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    words = span_hashes(_LOWER[buf], starts, ends)
    bounds = np.cumsum(np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw)))
    cuts = np.searchsorted(starts, np.concatenate([[0], bounds]))
    n = len(words)
    rolled = np.zeros(n, U64)
    for k in range(min(width, n)):
        rolled[: n - k] += words[k:] * _PLACE[k]
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        count = hi - lo
        if count >= width:
            yield np.unique(mix(rolled[lo : hi - width + 1]))
        elif count:
            yield mix((words[lo:hi] * _PLACE[:count]).sum(dtype=U64)[None] + U64(count))
        else:
            yield np.zeros(0, U64)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that isn't empty."""
    out = np.full(BANDS * ROWS, np.iinfo(U64).max, U64)
    for lo in range(0, len(shingles), 4096):
        out = np.minimum(out, (shingles[None, lo : lo + 4096] * _MUL[:, None] + _ADD[:, None]).min(1))
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    mixed = mix(m.reshape(BANDS, ROWS))
    return mix((mixed * _PLACE[:ROWS]).sum(1, dtype=U64) + np.arange(BANDS, dtype=U64)).view(np.int64)


def packed(m: np.ndarray) -> np.ndarray:
    low = (mix(m) & U64((1 << BITS) - 1)).reshape(WORDS, -1)
    return (low << (np.arange(low.shape[1], dtype=U64) * U64(BITS))).sum(1, dtype=U64).view(np.int64)


def _runs(texts: list[str | None], most: int = 500_000):
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t or "")
        if size > most:
            yield run
            run, size = [], 0
    if run:
        yield run


def text_sha(text: Column) -> Column:
    """SHA-256 of a text, as hexadecimal digits; a null text counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("_text"), F.unhex(text_sha(F.col(text_col))).alias("sha"))


def signatures(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """doc (the row's id), sha (of the text), n_shingles, set_key, bands, sketch; an empty set has neither key, bands nor sketch."""

    def run(batches):
        for batch in batches:
            n, keys, bands, sketch = [], [], [], []
            for texts in _runs(batch.column("_text").to_pylist()):
                for s in shingle_sets(texts, width):
                    n.append(len(s))
                    if not len(s):
                        keys.append(None), bands.append(None), sketch.append(None)
                        continue
                    m = minima(s)
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    bands.append(band_keys(m))
                    sketch.append(packed(m))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("sha"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, longs), pa.array(sketch, longs)], ["doc", "sha", "n_shingles", "set_key", "bands", "sketch"])

    rows = _texts(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, sha binary, n_shingles long, set_key binary, bands array<long>, sketch array<long>")


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """node, shingles of texts (node, _text); a node of repeated rows comes back once."""

    def run(batches):
        for batch in batches:
            sets = [s.view(np.int64) for texts in _runs(batch.column("_text").to_pylist()) for s in shingle_sets(texts, width)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return texts.select("node", "_text").mapInArrow(run, "node long, shingles array<long>").dropDuplicates(["node"])


def _differing(a: str, b: str):
    """How many packed minima differ: lanes of the exclusive or that aren't zero."""
    total = F.lit(0)
    for k in range(WORDS):
        x = F.expr(f"{a}[{k}] ^ {b}[{k}]")
        lanes = x
        for shift in (1, 2, 3)[: BITS - 1]:
            lanes = lanes.bitwiseOR(F.shiftrightunsigned(x, shift))
        total += F.bit_count(lanes.bitwiseAND(F.lit(0x1111111111111111)))
    return total


def most_differing(percent: int, sigmas: float = 5.5) -> int:
    """Differing minima up to which a pair may still have the similarity: the expectation and some standard deviations."""
    n, chance = BANDS * ROWS, 2.0**-BITS
    p = (1 - percent / 100) * (1 - chance)
    return min(n, int(n * p + sigmas * (n * p * (1 - p)) ** 0.5) + 1)


def _confirmed(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that link: sizes, then packed minima, then full sets."""

    def side(table: DataFrame, name: str) -> DataFrame:
        return table.select(*[F.col(c).alias(name if c == "node" else f"{name}_{c}") for c in table.columns])

    near = pairs.distinct().join(side(sketches, "a"), "a").join(side(sketches, "b"), "b")
    sizes = 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
    near = near.where(sizes & (_differing("a_sketch", "b_sketch") <= most_differing(percent))).select("a", "b")
    full = near.join(side(sets, "a"), "a").join(side(sets, "b"), "b")
    both = F.size(F.array_intersect("a_shingles", "b_shingles"))
    return full.where(100 * both >= percent * (F.size("a_shingles") + F.size("b_shingles") - both)).select("a", "b")


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets left[i] and right[j]; many pairs at once are one matrix product over shared shingles."""
    if len(i) < 4 * len(sets):
        return np.array([len(np.intersect1d(sets[left[a]], sets[right[b]], assume_unique=True)) for a, b in zip(i, j, strict=True)], np.int64)
    values, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    often = count[at] > 1
    place, owner = (np.cumsum(count > 1) - 1)[at[often]], owner[often]
    total = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int((count > 1).sum()), 8192):
        part = (place >= lo) & (place < lo + 8192)
        has = np.zeros((len(sets), 8192), np.float32)
        has[owner[part], place[part] - lo] = 1
        total += has[left] @ has[right].T
    return np.rint(total[i, j]).astype(np.int64)


def _block_links(members: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int, block: int = 512) -> DataFrame:
    """Links across components among ``members`` (cluster, node, component) of each cluster, fewer than its rows for each task.

    ``cluster`` is the component that most members of a bucket are in. Its own members are linked already, so
    they are only held against the others, and the others among themselves. Both kinds are dealt into blocks of
    about ``block`` rows, and each row goes to the blocks it meets; so no task has more than two blocks at once. Packed
    minima sort out pairs, full sets confirm them, and a forest of the links stands for all of them.
    """
    limit = most_differing(percent)
    own = F.col("component") == F.col("cluster")
    sizes = members.groupBy("cluster").agg(F.ceil(F.count_if(own) / block).alias("_own"), F.ceil(F.count_if(~own) / block).alias("_others"))
    rows = members.join(cut(sizes), "cluster").join(sketches.select("node", "sketch"), "node").join(sets, "node")
    upto = lambda c: F.when(F.col(c) > 0, F.sequence(F.lit(0).cast("long"), F.col(c) - 1)).otherwise(F.array().cast("array<long>"))
    h = F.xxhash64("node")
    # A meeting has the block of each side; blocks of the cluster's own members are numbered below zero and stand on the left.
    place = F.when(own, -1 - F.pmod(h, F.col("_own"))).otherwise(F.pmod(h, F.col("_others")))
    rows = rows.withColumn("_at", place)
    meet = lambda o: F.struct(F.least("_at", o).alias("i"), F.greatest("_at", o).alias("j"), (F.col("_at") > o).alias("second"))
    others = F.transform(upto("_others"), meet)
    both = F.when(own, others).otherwise(F.concat(F.transform(upto("_own"), lambda o: meet(-1 - o)), others))
    rows = rows.select("cluster", "node", "component", "sketch", "shingles", F.explode(both).alias("m")).select("cluster", "node", "component", "sketch", "shingles", "m.*")

    def compare(pdf):
        import pandas as pd

        words = np.array(pdf["sketch"].tolist(), np.int64).view(U64)
        ids, comp, second = pdf["node"].to_numpy(), pdf["component"].to_numpy(), pdf["second"].to_numpy()
        sets = [np.asarray(x) for x in pdf["shingles"]]
        size = np.array([len(x) for x in sets])
        same = pdf["i"].iloc[0] == pdf["j"].iloc[0]
        left, right = (np.arange(len(ids)),) * 2 if same else (np.flatnonzero(~second), np.flatnonzero(second))
        i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, a in enumerate(left):
            to = right[k + 1 :] if same else right
            x = words[to] ^ words[a]
            lanes = (x | x >> U64(1) | x >> U64(2) | x >> U64(3)) & U64(0x1111111111111111)
            near = (np.bitwise_count(lanes).sum(1) <= limit) & (comp[to] != comp[a])
            near &= 100 * np.minimum(size[to], size[a]) >= percent * np.maximum(size[to], size[a])
            found = np.flatnonzero(near) + (k + 1 if same else 0)
            i.append(np.full(len(found), k))
            j.append(found)
        i, j = np.concatenate(i), np.concatenate(j)
        shared = _common(sets, left, right, i, j)
        sure = 100 * shared >= percent * (size[left[i]] + size[right[j]] - shared)
        group = group_of(len(ids), left[i[sure]], right[j[sure]])
        moved = group != np.arange(len(ids))
        return pd.DataFrame({"a": ids[moved], "b": ids[group[moved]]})

    return rows.groupBy("cluster", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def near_dedup(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_shingles, component_id, kept, text_sha256.

    Texts link when 100 * common >= percent * all of their shingle sets (``width`` words each; a shorter text
    is one shingle). ``component_id`` is the least id reachable over links, null if no row there has an id. Of
    each component exactly one row is kept: one with that id and, if several have it, the least SHA-256 of its
    text. Each row is a node of its own, whether its id is null, repeated or neither. Texts without words (null
    ones too) link with nothing and are kept. An empty table gives no rows; ids may be of any type that can be
    ordered, other columns are ignored. Links are confirmed on full sets of 64-bit hashes; what 32 bands of 4
    miss at 0.8 is about one link in 20 million.

    Equal sets are one class. A bucket is not paired out: its classes meet its least one first, then one of
    another component; what is still in different components is compared in blocks. Components found so far go
    on as stars, to which new links are added.
    """
    # The checkpoint fixes the nodes' numbers.
    rows = cut(signatures(docs, width, id_col, text_col).withColumn("node", F.monotonically_increasing_id()))
    first = F.struct(F.col("doc").isNull().alias("none"), "doc", "sha", "node", F.col("n_shingles").alias("n"), "bands", "sketch")  # no two rows have one node
    heads = cut(rows.where("set_key IS NOT NULL").groupBy("set_key").agg(F.min(first).alias("h")).select("set_key", "h.*"))
    sketches = heads.select("node", "n", "sketch")
    entries = heads.select("node", F.explode(F.array_distinct("bands")).alias("bucket"))
    shared = cut(entries.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("_last"), F.count(F.lit(1)).alias("size")).where("pivot < _last").drop("_last"))
    members = cut(entries.join(shared, "bucket"))
    involved = heads.join(members.select("node").distinct(), "node", "left_semi").select("node", F.col("doc").alias("_doc"), F.col("sha").alias("_sha"))
    texts = _texts(docs, id_col, text_col).join(involved, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("sha") == F.col("_sha")))
    sets = cut(_sets(texts, width))
    found = components(_confirmed(members.where("node > pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")), sketches, sets, percent))
    # Buckets whose classes are in several components: all meet one of another component than the pivot's.
    component = F.coalesce("component", "node").alias("component")
    labelled = members.where("size > 2").join(found.withColumnRenamed("id", "node"), "node", "left").select("bucket", "node", "pivot", component)
    second = F.max(F.struct(F.col("node") != F.col("pivot"), F.xxhash64("component"), "component", "node")).alias("_second")
    mixed = cut(labelled.groupBy("bucket").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"), second).where("_lo < _hi").select("bucket", "_second"))
    open_ = cut(labelled.join(mixed, "bucket"))
    far = open_.where("component <> _second.component").select(F.greatest("node", F.col("_second.node")).alias("a"), F.least("node", F.col("_second.node")).alias("b"))
    stars = lambda links: components(links.unionByName(found.select(F.col("id").alias("a"), F.col("component").alias("b"))))
    found = stars(_confirmed(far, sketches, sets, percent))
    # What is still open goes by the largest component of its bucket: many buckets of one dense group become one cluster.
    labelled = open_.select("bucket", "node").join(found.withColumnRenamed("id", "node"), "node", "left").select("bucket", "node", component)
    largest = labelled.groupBy("bucket", "component").count().groupBy("bucket").agg(F.max(F.struct("count", "component")).alias("_most"), F.count(F.lit(1)).alias("_kinds")).where("_kinds > 1")
    clusters = cut(labelled.join(cut(largest), "bucket").select(F.col("_most.component").alias("cluster"), "node", "component").distinct())
    found = stars(_block_links(clusters, sketches, sets, percent))
    best = heads.select("node", "set_key", F.struct("none", "doc", "sha", "node").alias("best")).join(found.withColumnRenamed("id", "node"), "node", "left")
    tops = cut(best.where("component IS NOT NULL").groupBy("component").agg(F.min("best").alias("_top")))
    reach = best.join(tops, "component", "left").select("set_key", F.coalesce("_top", "best").alias("_top"))
    # Rows without words stay out of the join, where they would share one null key.
    out = rows.where("set_key IS NOT NULL").join(reach, "set_key").select("doc", "sha", "n_shingles", F.col("_top.doc").alias("top"), (F.col("node") == F.col("_top.node")).alias("kept"))
    out = out.unionByName(rows.where("set_key IS NULL").select("doc", "sha", "n_shingles", F.col("doc").alias("top"), F.lit(True).alias("kept")))
    return out.select(F.col("doc").alias(id_col), "n_shingles", F.col("top").alias("component_id"), "kept", F.lower(F.hex("sha")).alias("text_sha256"))
