"""Language identification of words in mixed text with a linear-chain conditional random field.

Features of a word are its affixes and inner character n-grams (hashed; an n-gram that starts or ends at
the space around the word is an affix) and its place in a lexicon of frequent training words. Transitions
between languages are learned with the feature weights by forward-backward. Marginals label each word; a
text's language is the one with the largest mean marginal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helio.llm.common import carried, fit_on_sample
from helio.llm.textgrams import Words, pieces

GRAMS, BITS, LEXICON_BITS = (2, 3, 4), 16, 17


def forward_backward(emit: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray, steps: int = 64, pairs: bool = True):
    """Marginals (n, labels) and, with ``pairs``, expected transition counts of chains laid end to end.

    emit: positive potentials (n, labels); first: where a chain begins. The row of chains is cut into equal
    chunks that advance together; products of each chunk's matrices carry messages from chunk to chunk.
    """
    n, m = emit.shape
    k = -(-n // steps)
    pad = k * steps - n
    e = np.concatenate([emit, np.ones((pad, m))]).reshape(k, steps, m)
    f = np.concatenate([first, np.ones(pad, bool)]).reshape(k, steps)
    product = np.broadcast_to(np.eye(m), (k, m, m))
    for t in range(steps):
        moved = (product.reshape(k * m, m) @ trans).reshape(k, m, m)
        if f[:, t].any():
            moved = np.where(f[:, t, None, None], product.sum(-1, keepdims=True) * start, moved)
        product = moved * e[:, t, None, :]
        product = product / product.sum((1, 2), keepdims=True)
    into, out = np.empty((k, m)), np.empty((k, m))
    a = np.full(m, 1 / m)
    for i in range(k):
        into[i] = a
        a = a @ product[i]
        a /= a.sum()
    b = np.full(m, 1 / m)
    for i in range(k - 1, -1, -1):
        out[i] = b
        b = product[i] @ b
        b /= b.sum()
    alpha, a = np.empty((k, steps, m)), into
    for t in range(steps):
        a = np.where(f[:, t, None], a.sum(1, keepdims=True) * start, a @ trans) * e[:, t]
        a = a / a.sum(1, keepdims=True)
        alpha[:, t] = a
    beta, b = np.empty((k, steps, m)), out
    for t in range(steps - 1, -1, -1):
        beta[:, t] = b
        b = e[:, t] * b
        b = np.where(f[:, t, None], (b @ start)[:, None] * np.ones(m), b @ trans.T)
        b = b / b.sum(1, keepdims=True)
    gamma = alpha * beta
    gamma = (gamma / gamma.sum(2, keepdims=True)).reshape(-1, m)[:n]
    if not pairs:
        return gamma, None
    alpha, beta, e = alpha.reshape(-1, m), beta.reshape(-1, m), e.reshape(-1, m)
    pair = (alpha[: n - 1, :, None] * trans) * (e * beta)[1:n, None, :]
    pair /= np.maximum(pair.sum((1, 2), keepdims=True), 1e-300)
    return gamma, pair[~first[1:n]].sum(0)


@dataclass
class Model:
    languages: list[str]
    grams: list[np.ndarray]
    lexicon_keys: np.ndarray
    lexicon: np.ndarray
    trans: np.ndarray
    start: np.ndarray

    def features(self, words: Words) -> tuple[list[np.ndarray], np.ndarray]:
        """Buckets of n-grams by place, and of the lexicon by word."""
        h = words.hashes()
        slot = (h >> np.uint64(64 - LEXICON_BITS)).astype(np.int64)
        return [words.grams(n, BITS) for n in GRAMS], np.where(self.lexicon_keys[slot] == h, slot + 1, 0)

    def scores(self, words: Words) -> np.ndarray:
        """Log potentials of words."""
        buckets, slot = self.features(words)
        each = self.grams[0][buckets[0]]
        for table, b in zip(self.grams[1:], buckets[1:], strict=True):
            each += table[b]
        at = words.starts - 1
        total = np.add.reduceat(each, at, axis=0) if len(at) else np.zeros((0, len(self.languages)), np.float32)
        return total + self.lexicon[slot]

    def potentials(self, scores: np.ndarray) -> np.ndarray:
        return np.exp(np.clip(scores - scores.max(1, keepdims=True), -30, 0)).astype(float) if len(scores) else scores

    def marginals(self, scores: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Marginals of words from their ``scores``; each ``text`` is a chain."""
        first = np.diff(text, prepend=-1) > 0
        return forward_backward(self.potentials(scores), first, np.exp(self.trans), np.exp(self.start), pairs=False)[0]


def fit(texts: list[str], langs: list[str], epochs: int = 4, batch: int = 20_000, rate: float = 0.3, seed: int = 7) -> Model:
    """Train on texts in one main language each. Splices of two texts teach the transitions. Needs no text at all: then no language is known."""
    names = sorted(set(langs))
    m = max(1, len(names))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    joined, labels = [], []
    for k, i in enumerate(order):  # the halves of every fourth text stand around another text
        if k % 4 == 0 and k + 1 < len(order):
            j = order[k + 1]
            half = len(texts[i]) // 2
            joined += [texts[i][:half], texts[j][: 1 + len(texts[j]) // 3], texts[i][half:]]
            labels += [(k, langs[i]), (k, langs[j]), (k, langs[i])]
        joined.append(texts[i])
        labels.append((-k - 1, langs[i]))
    model = Model(names, [np.zeros((1 << BITS, m), np.float32) for _ in GRAMS], np.zeros(1 << LEXICON_BITS, np.uint64), np.zeros(((1 << LEXICON_BITS) + 1, m), np.float32), np.zeros((m, m)), np.zeros(m))
    if not names:
        return model
    words = Words(joined)
    if not len(words.starts):
        return model
    keys, counts = np.unique(words.hashes(), return_counts=True)
    for key in keys[counts >= 5][np.argsort(counts[counts >= 5], kind="stable")]:  # the more frequent word wins a slot
        model.lexicon_keys[int(key >> np.uint64(64 - LEXICON_BITS))] = key
    buckets, slot = model.features(words)
    y = np.array([names.index(lang) for _, lang in labels])[words.text]
    chain = np.array([c for c, _ in labels])[words.text]
    first = np.diff(chain, prepend=chain[0] + 1) != 0
    owner = np.zeros(len(words.codes), np.int32)
    owner[words.starts - 1] = 1
    owner = np.maximum(np.cumsum(owner, dtype=np.int32) - 1, 0)
    tables = [*model.grams, model.lexicon, model.trans, model.start]
    squares = [np.full(t.shape, 1e-2) for t in tables]
    cuts = list(range(0, len(words.starts), batch))
    for epoch in range(epochs):
        for lo in rng.permutation(cuts):
            hi = min(lo + batch, len(words.starts))
            p, q = words.starts[lo] - 1, (words.starts[hi] - 1 if hi < len(words.starts) else len(words.codes))
            each = sum(t[b[p:q]] for t, b in zip(model.grams, buckets, strict=True))
            s = np.add.reduceat(each, words.starts[lo:hi] - 1 - p, axis=0) + model.lexicon[slot[lo:hi]]
            f = first[lo:hi].copy()
            f[0] = True
            gamma, pair = forward_backward(model.potentials(s), f, np.exp(model.trans), np.exp(model.start))
            truth = np.eye(m)[y[lo:hi]]
            diff = truth - gamma
            by_place = diff[owner[p:q] - lo]
            seen = np.zeros((m, m))
            stay = ~f[1:]
            np.add.at(seen, (y[lo:hi][:-1][stay], y[lo:hi][1:][stay]), 1)
            grads = [np.stack([np.bincount(b[p:q], by_place[:, k], 1 << BITS) for k in range(m)], 1) for b in buckets]
            grads.append(np.stack([np.bincount(slot[lo:hi], diff[:, k], (1 << LEXICON_BITS) + 1) for k in range(m)], 1))
            grads += [seen - pair, diff[f].sum(0)]
            for k, (t, g, sq) in enumerate(zip(tables, grads, squares, strict=True)):
                g = g / (hi - lo) - 1e-6 * t
                if k <= len(GRAMS):
                    g[0] = 0  # bucket 0 stands for no feature
                sq += g * g
                t += (rate * g / np.sqrt(sq)).astype(t.dtype)
    return model


SCHEMA = "lang_pred string, score double, mixture map<string,double>"


def _predictor(shared, id_col: str, carry: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        m = len(model.languages)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            sums, counts = np.zeros((len(texts), max(1, m))), np.zeros(len(texts))
            held: list[tuple[np.ndarray, np.ndarray]] = []  # scores of a long text's pieces: they are one chain
            for run, more in pieces(texts) if m else ():
                words = Words([t for _, t in run])
                held.append((model.scores(words), np.array([i for i, _ in run])[words.text]))
                if more:
                    continue
                scores, at = (np.concatenate(x) for x in zip(*held, strict=True))
                held = []
                if len(at):
                    gamma = model.marginals(scores, at)
                    counts += np.bincount(at, minlength=len(texts))
                    for k in range(m):
                        sums[:, k] += np.bincount(at, gamma[:, k], len(texts))
            mean = sums / np.maximum(counts, 1)[:, None]
            best = mean.argmax(1)
            known = counts > 0
            pred = [model.languages[b] if k else "und" for b, k in zip(best, known, strict=True)]
            score = np.where(known, np.clip(mean.max(1), 0, 1), 0.0)
            mixture = [list(zip(model.languages, row, strict=True)) if k else [] for row, k in zip(mean.tolist(), known, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(pred, pa.string()), pa.array(score), pa.array(mixture, pa.map_(pa.string(), pa.float64())), *(batch.column(c) for c in carry.values())], [id_col, "lang_pred", "score", "mixture", *carry])

    return run


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_docs: int = 2000, most_chars: int = 4000) -> Model:
    """Fit on a bounded sample: the ``most_docs`` rows first by a hash of id and text among those of 20 to ``most_chars`` characters."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.char_length(text_col).between(20, most_chars))
    return fit_on_sample(rows.select(F.xxhash64(id_col, text_col).alias("h"), F.col(text_col).alias("t"), F.col(lang_col).alias("y")), most_docs, fit)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col``, lang_pred, score (mean marginal), mixture (mean marginal by language) and ``carry``.

    A null text or one without letters, and any text if no language was learned, is ``und`` with score 0. A text of
    any length is one chain. Ties go to the first language by name. Repeated rows come back as often as they are
    given; an empty table gives no rows, and other columns are ignored.
    """
    rows, sources, kinds = carried(docs, id_col, text_col, carry)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_predictor(shared, id_col, sources), f"{id_col} {rows.schema[id_col].dataType.simpleString()}, {SCHEMA}{kinds}")


def fold(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % parts
