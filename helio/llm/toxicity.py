"""Toxicity by subword bags: averaged embeddings of words and character n-grams under a linear softmax.

Embeddings and softmax are trained jointly in numpy. Words share the vectors of their n-grams, so a
misspelling that was never seen still lands near the word it is made from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helio.llm.common import carried, fit_on_sample
from helio.llm.textgrams import Words, pieces

GRAMS, BITS, DIM = (3, 4, 5), 18, 4


def _features(words: Words) -> list[np.ndarray]:
    """Buckets by place: of n-grams, and of whole words at their starts (0: none); those of one kind have a table of their own."""
    whole = np.zeros(len(words.codes), np.uint32)
    whole[words.starts] = (words.hashes() >> np.uint64(64 - BITS)).astype(np.uint32)
    return [*(words.grams(n, BITS) for n in GRAMS), whole]


class Model:
    """Embeddings of each kind of feature, softmax weights (DIM, 2) and bias (2)."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.tables = [np.zeros((1 << BITS, DIM), np.float32) for _ in range(len(GRAMS) + 1)]
        self.out, self.bias = rng.standard_normal((DIM, 2)) * 0.5, np.zeros(2)

    def weights(self) -> list[np.ndarray]:
        """What each bucket adds to the log odds before averaging: the softmax is linear in the mean of the vectors."""
        return [(t @ (self.out[:, 1] - self.out[:, 0])).astype(np.float32) for t in self.tables]


def fit(texts: list[str], toxic: list[int], steps: int = 900, batch: int = 64, rate: float = 1.0, sparse: float = 2e-5, least: int = 3, seed: int = 5) -> Model:
    """Train on texts with labels 0 and 1, which weigh alike, for ``steps`` batches however few texts there are. Without texts of both labels the bias alone says which there are.

    Vectors begin at zero, those of features in fewer than ``least`` texts stay there, and an adaptive
    group lasso (``sparse``) pulls back to zero those that are about as frequent under both labels, so rare or unseen neutral words do not sway the mean.
    """
    model, rng = Model(seed), np.random.default_rng(seed)
    y = np.array(toxic, int)
    if len(set(toxic)) < 2:
        model.bias = np.array([0.0, 2.0 if len(y) and y[0] else -2.0])
        return model
    sets = []
    for t in texts:
        cols = [b[b > 0] for b in _features(Words([t]))]
        sets.append([(u, n.astype(np.float32)) for u, n in (np.unique(c, return_counts=True) for c in cols)])
    pull, places, tables = [], [], []
    for k in range(len(model.tables)):
        seen, bad = (np.bincount(np.concatenate([s[k][0] for s, label in zip(sets, y, strict=True) if label >= low]), minlength=1 << BITS) for low in (0, 1))
        used = np.flatnonzero(seen >= least)
        odds = np.log((bad[used] + 0.5) / (seen[used] - bad[used] + 0.5)) - np.log(y.sum() / (len(y) - y.sum()))
        pull.append(sparse / (odds * odds + 0.05))
        places.append(used)
        tables.append(np.zeros((len(used), DIM)))
        dense = np.full(1 << BITS, -1)
        dense[used] = np.arange(len(used))
        # How many features a text has is fixed before, so rare ones still count in the mean.
        for s in sets:
            s.append(s[k][1].sum())
            at = dense[s[k][0]]
            s[k] = (at[at >= 0], s[k][1][at >= 0])
    squares = [np.full(len(t), 1e-8) for t in tables]
    out_sq, bias_sq = np.full(model.out.shape, 1e-4), np.full(2, 1e-4)
    weight = (len(y) / 2 / np.bincount(y, minlength=2))[y]  # both labels count alike
    for _ in range(-(-steps * batch // len(texts))):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            ids = order[lo : lo + batch]
            total = np.array([max(1, sum(sets[i][len(tables) :])) for i in ids])
            rows = [(np.concatenate([sets[i][k][0] for i in ids]), np.concatenate([sets[i][k][1] / n for i, n in zip(ids, total, strict=True)]), np.repeat(np.arange(len(ids)), [len(sets[i][k][0]) for i in ids])) for k in range(len(tables))]
            v = np.zeros((len(ids), DIM))
            for (b, w, r), table in zip(rows, tables, strict=True):
                for d in range(DIM):
                    v[:, d] += np.bincount(r, table[b, d] * w, len(ids))
            logits = v @ model.out + model.bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            diff = (np.eye(2)[y[ids]] - p) * weight[ids, None] / len(ids)
            back = diff @ model.out.T
            for (b, w, r), table, sq, keep in zip(rows, tables, squares, pull, strict=True):
                g = np.stack([np.bincount(b, back[r, d] * w, len(table)) for d in range(DIM)], 1)
                sq += (g * g).mean(1)
                step = (rate / np.sqrt(sq))[:, None]
                table += step * g
                met = np.bincount(b, minlength=len(table)) > 0  # others are not pulled in this batch
                table *= np.where(met[:, None], np.maximum(0, 1 - keep[:, None] * step / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-12)), 1)
            for t, g, sq in ((model.out, v.T @ diff, out_sq), (model.bias, diff.sum(0), bias_sq)):
                sq += g * g
                t += 0.2 * g / np.sqrt(sq)
    for full, used, table in zip(model.tables, places, tables, strict=True):
        full[used] = table
    return model


def _scorer(shared, id_col: str, carry: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
            for run, _ in pieces(texts):
                index = np.array([i for i, _ in run])
                words = Words([t for _, t in run])
                if not len(words.starts):
                    continue
                at = index[words.text]
                value, number = np.zeros(len(words.codes), np.float32), np.zeros(len(words.codes), np.float32)
                for b, w in zip(_features(words), weights, strict=True):
                    value += w[b]
                    number += b > 0
                for x, to in ((value, sums), (number, counts)):
                    to += np.bincount(at, np.add.reduceat(x, words.starts - 1, dtype=np.float64), len(texts))
            odds = sums / np.maximum(counts, 1) + bias
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(1 / (1 + np.exp(-np.clip(odds, -50, 50)))), *(batch.column(c) for c in carry.values())], [id_col, "score", *carry])

    return run


def train(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_each: int = 1500, most_chars: int = 6000) -> Model:
    """Fit on a bounded sample: for each label the ``most_each`` texts first by a hash of id and text among those of up to ``most_chars`` characters.

    Labels stand in ``docs`` or in a table of their own (id and label), joined behind the hash: counting shuffles no text.
    """
    own = [F.col(label_col).alias("y")] if labels is None else []
    rows = docs.where(F.char_length(text_col).between(1, most_chars)).select(F.col(id_col).alias("_id"), F.col(text_col).alias("t"), F.xxhash64(id_col, text_col).alias("h"), *own)
    if labels is not None:
        rows = rows.join(labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("y")), "_id")
    return fit_on_sample(rows, most_each, fit, labels=(0, 1))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col``, score (probability of label 1) and ``carry``. A text without words gets what the bias alone says; a null text counts as empty. Repeated rows come back as often as they are given; an empty table gives no rows."""
    rows, sources, kinds = carried(docs, id_col, text_col, carry)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights(), float(model.bias[1] - model.bias[0])))
    return rows.mapInArrow(_scorer(shared, id_col, sources), f"{id_col} {rows.schema[id_col].dataType.simpleString()}, score double{kinds}")
