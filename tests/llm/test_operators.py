import hashlib
import itertools
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helio.llm import bpe, chat, common, langid, packing, textgrams, toxicity
from helio.llm.components import components
from helio.llm.exact_dedup import exact_dedup
from helio.llm.license_scan import license_scan
from helio.llm.minhash import near_dedup, shingle_sets
from helio.llm.url_filter import rule_table, url_filter
from helio.llm.vectors import near_vectors

#: Columns beside the needed ones have names that operators use inside.
KIND = "doc_id long, text string, _id string, kept string, id string, _text string"
ODD = ["", " ", "\x1c\x1d a\x1e\n\x85 b\u2009c\u3000d\n\n", "日本語 12345 don't", "a" * 3000, "👩‍👩‍👧 é̀ <|endoftext|>", "  x\t\t y", "Hello WORLD hello world"]


def docs(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "c", "c", "c", "c") for i, t in zip(ids or range(len(texts)), texts)], KIND)


def test_empty_tables(spark):
    none = docs(spark, [])
    ranks = {bytes([i]): i for i in range(256)}
    assert exact_dedup(none).count() == license_scan(none).count() == near_dedup(none).count() == 0
    assert bpe.bpe_round_trip(none, ranks, public_tokenizers.PATTERN).count() == 0
    assert packing.pack_documents(none, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert langid.identify(none, langid.train(none.withColumn("lang", F.lit("en")))).count() == 0
    assert toxicity.score(none, toxicity.train(none.withColumn("toxic", F.lit(1)))).count() == 0
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    assert url_filter(spark.createDataFrame([], "page_id long, url string"), rule_table(spark)).count() == 0


def test_exact_dedup(spark):
    rows = docs(spark, ["Ab", "aB", None, "", "x", "x", "É", "é"], [1, 2, 3, 4, None, 5, 6, 7])
    out = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup(rows, keep="max").collect()}
    assert out == {1: (2, 2, False), 2: (2, 2, True), 3: (4, 2, False), 4: (4, 2, True), None: (5, 2, False), 5: (5, 2, True), 6: (6, 1, True), 7: (7, 1, True)}


def test_exact_dedup_hot_group_and_repeated_row(spark):
    rows = docs(spark, ["Hot"] * 300 + [f"t{i}" for i in range(50)] + ["one", "one"], [*range(350), 999, 999])
    out = exact_dedup(rows, keep="min", carry=()).collect()
    assert all((r["keep_id"], r["group_size"]) == (0, 300) for r in out if r["doc_id"] < 300)
    assert sum(r["kept"] for r in out) == 1 + 50 + 1
    for keep, stays in (("min", 3), ("max", 90)):  # null ids and a repeated row in a hot group
        hot = exact_dedup(docs(spark, ["Hot"] * 300, [None] * 200 + [3, 3, 3, *range(4, 90)] + [90] * 11), keep=keep).collect()
        assert len(hot) == 300 and {(r["keep_id"], r["group_size"]) for r in hot} == {(stays, 300)} and [r["doc_id"] for r in hot if r["kept"]] == [stays]
    assert next(r for r in out if r["doc_id"] == 0)["text_sha256"] == hashlib.sha256(b"hot").hexdigest()


def test_license_scan(spark):
    text = "Under the MIT-license; x. apache license, version 2 under the mit license"
    out = license_scan(docs(spark, [text, text, None, "cc by nc", "cc by"], [1, 1, 2, 3, None])).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in out), key=str)
    twice = (1, 13, 3, 0, 9, "apache-2,mit")
    assert got == sorted([twice, twice, (2, 0, 0, None, None, ""), (3, 3, 1, 0, 0, "cc-by-nc"), (None, 2, 0, None, None, "")], key=str)


def _license_base(text):
    """Words, and places of each base phrase, by plain search."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    at = [(i, label) for label, phrase in (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")) for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({label for _, label in at}))


def test_license_base_against_brute_force(spark):
    rng = np.random.default_rng(6)
    bits = ["under the", "mit", "license", "MIT License", "Apache License,", "version 2", "2 cc by", "by-nc", "CC BY NC", "é the", "\u3000 x", "under\x7fthe mit"]
    texts = [" ".join(rng.choice(bits, int(rng.integers(0, 30)))) for _ in range(300)] + ["cc by " * 4000 + "nc"]
    out = {r["doc_id"]: tuple(r)[1:6] for r in license_scan(docs(spark, texts)).collect()}
    assert out == {i: _license_base(t) for i, t in enumerate(texts)}


def test_license_spans_are_verified(spark):
    whole = "permission is hereby granted free of charge to any person obtaining a copy of this software"
    words = whole.split()
    loose = " ".join([*words[:6], "now", *words[6:]])
    part = " ".join(words[:9])
    out = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan(docs(spark, [whole, loose, f"{part} {part} {part}", " ".join(words[8:] + words[:8])])).collect()}
    assert out[0] == ("mit", 1.0) and out[1][0] == "mit" and 0.8 <= out[1][1] < 1
    assert out[2][0] == "" and out[2][1] <= 0.5 and out[3][0] == ""  # one part again and again, and halves in the wrong order


@pytest.mark.parametrize(("label", "text"), [
    ("gpl", "This work is licensed under the GNU General Public License, version 3"), ("lgpl", "It is licensed under the GNU Lesser General Public License."), ("agpl", "you may use it under the terms of the GNU Affero General Public License v3"),
    ("mpl-2", "Licensed under the Mozilla Public License, version 2.0"), ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0"), ("cc0", "CC0 1.0 Universal (Public Domain Dedication)"),
    ("bsd", "Redistribution and use, in source and in binary forms, with or without modification, are permitted"), ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
])
def test_statements_of_licenses_are_labelled(spark, label, text):
    texts = [text, f"Some words before. {text} and some behind, once more: {text}", text.replace(" ", "\n* ")]
    assert [r["labels"] for r in license_scan(docs(spark, texts)).orderBy("doc_id").collect()] == [label] * 3


def test_licenses_in_text_about_them_are_not_labelled(spark):
    texts = ["A licence is a permission. The general public may use the software under the terms of the contract.", "creative people share attribution under common terms", "free software and the gnu project", None, ""]
    assert {r["labels"] for r in license_scan(docs(spark, texts)).collect()} == {""}


def test_loose_spans_against_brute_force(spark):
    """Each template with words put in, left out or changed: its label is found where one run over its grams in order, with at most two words of drift between neighbours, holds 0.8 of them."""
    from helio.llm.license_scan import TEMPLATES, K

    rng = np.random.default_rng(12)
    texts = []
    for _ in range(150):
        words = str(rng.choice([t for _, _, t in TEMPLATES])).split()
        for _ in range(int(rng.integers(0, 4))):
            at = int(rng.integers(0, len(words)))
            words[at : at + int(rng.integers(0, 2))] = ["zzz"] * int(rng.integers(0, 2))
        texts.append(" ".join(["zzz"] * int(rng.integers(0, 5)) + words))

    def best(text, template):
        w, t = text.split(), template.split()
        grams = {p: [i for i in range(len(w) - K + 1) if w[i : i + K] == t[p : p + K]] for p in range(len(t) - K + 1)}
        spots = sorted((i - p, p) for p, each in grams.items() for i in each)
        spans, cover = [], 0
        for d, p in spots:
            if not spans or d - spans[-1][-1][0] > 2:
                spans.append([])
            spans[-1].append((d, p))
        for span in spans:
            first = {}
            for d, p in span:
                first[p] = min(first.get(p, d + p), d + p)
            top, held = -1, 0
            for p in sorted(first):
                held += first[p] > top
                top = max(top, first[p])
            cover = max(cover, held / len(grams))
        return cover

    out = {r["doc_id"]: r["labels"] for r in license_scan(docs(spark, texts)).collect()}
    for i, text in enumerate(texts):
        assert out[i] == ",".join(sorted({label for label, _, t in TEMPLATES if best(text, t) >= 0.8})), text


def test_url_filter(spark):
    urls = ["http://A.Example.ORG/es/x?q", "https://example.org/en/12#f", "x.org/no", None, "http://org", "http://a.com/de/", "http://com/fr/1", "http://b.net:80/de/", "ftp://u://v.org/p"]
    out = {r["page_id"]: tuple(r)[1:] for r in url_filter(spark.createDataFrame([(*x, "c", "c", "c", 1) for x in enumerate(urls)], "page_id long, url string, host string, rule string, _id string, _n int"), rule_table(spark)).collect()}
    assert out[0] == ("a.example.org", "/es/x", "example.org/es/", "block") and out[1] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert out[2] == out[3] == ("", "", None, "allow") and out[4] == ("org", "", None, "allow")
    assert out[5][2:] == ("com/de/", "block") and out[6][2:] == ("com/fr/", "allow") and out[7] == ("b.net:80", "/de/", None, "allow") and out[8][0] == "u:"


def test_bpe_like_tiktoken(spark):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = {r["doc_id"]: r["ids"] for r in bpe.bpe_encode(docs(spark, [*ODD, None]), ranks, public_tokenizers.PATTERN).collect()}
    assert [ids[i] for i in range(len(ODD))] == [encoding.encode_ordinary(t) for t in ODD] and ids[len(ODD)] == []
    back = bpe.bpe_decode(bpe.bpe_encode(docs(spark, ODD), ranks, public_tokenizers.PATTERN), ranks, public_tokenizers.PATTERN)
    assert {r["doc_id"]: bytes(r["bytes"]).decode() for r in back.collect()} == dict(enumerate(ODD))


def test_packing_like_tokenizers(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [*ODD, None, "word " * 3000]
    pieces = packing.pack_documents(docs(spark, texts), path, keep_ids=True).collect()
    plain = Tokenizer.from_file(path)
    for i, t in enumerate(texts):
        mine = sorted((r for r in pieces if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [x for r in mine for x in r["ids"]] == plain.encode(t or "", add_special_tokens=False).ids + [2]
        assert all(r["length"] == 1024 for r in mine[1:]) and all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in mine)
    for s in {r["sequence_id"] for r in pieces}:
        at = 0
        for r in sorted((r for r in pieces if r["sequence_id"] == s), key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024


def test_packing_of_null_and_repeated_ids(spark):
    rows = docs(spark, ["one two three"] * 60 + [None] * 40, [None] * 80 + [7] * 20)
    pieces = packing.pack_documents(rows, public_tokenizers.path("byte_bpe_50k.json"), size=16).collect()
    assert len(pieces) == 100
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in pieces)
    assert all(o == (p[1] + p[2] if p[0] == s else 0) and o + n <= 16 for p, (s, o, n) in zip([(None, 0, 0), *places], places, strict=False))


def _optimum(items, size):
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= size and bins[k] not in bins[:k]:
                bins[k] += items[i]
                go(i + 1, bins)
                bins[k] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def test_reduction_keeps_the_optimum():
    rng = np.random.default_rng(3)
    for _ in range(150):
        size = int(rng.integers(8, 40))
        items = sorted(rng.integers(1, size + 1, int(rng.integers(1, 9))).tolist(), reverse=True)
        counts = np.bincount(items, minlength=size + 1)
        fixed = packing.reduce_instance(counts)
        rest = [s for s in range(size, 0, -1) for _ in range(counts[s])]
        assert sum(n for _, n in fixed) + (_optimum(rest, size) if rest else 0) == _optimum(items, size)


def test_near_dedup_against_brute_force(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = rng.choice(vocabulary, 60).tolist()
        for _ in range(12):
            copy = list(base)
            for _ in range(int(rng.integers(0, 5))):
                copy[int(rng.integers(0, 60))] = str(rng.choice(vocabulary))
            texts.append(" ".join(copy))
    texts += ["", None, " \t", "One two", "one TWO", "one two three"]
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set())
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup(docs(spark, texts), width=4).collect()}
    assert out == {i: (len(sets[i]), find(i), find(i) == i) for i in range(len(texts))}


@pytest.mark.parametrize("width", [4, 5])
@pytest.mark.parametrize("texts", [["One two"], ["one two three"], ["one two", "ONE two three"]])
def test_near_dedup_of_short_texts_alone(spark, texts, width):
    out = {r["doc_id"]: tuple(r)[1:4] for r in near_dedup(docs(spark, texts).coalesce(1), width=width).collect()}
    assert out == {i: (1, i, True) for i in range(len(texts))}
    for t in texts:  # alone in their run, and the same set as beside a longer text
        assert [s.tolist() for s in shingle_sets([t], width)] == [next(iter(shingle_sets([t, "a b c d e f g"], width))).tolist()]


def test_near_vectors(spark):
    a, b = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0]
    rows = [(1, a, 1), (2, b, 1), (3, a, 1), (4, a, 2), (5, [0.0] * 3, 1), (6, None, 1), (7, [1.0, None, 0.0], 1), (8, a, None), (9, [float("nan"), 1.0, 0.0], 1), (10, [2.0, 0.0, 0.0], 1), (None, [0.0, 1.0, 0.0], 1), (11, [1.0, 0.0], 1)]
    out = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(spark.createDataFrame([(*r, 0, 0, 0, 0) for r in rows], "vec_id long, embedding array<double>, label int, id int, node int, n int, kept int")).collect()}
    assert out[1] == (3, 1, True) and out[2] == out[3] == out[10] == (3, 1, False)
    assert all(out[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 11)) and out[None] == (0, None, True)


@pytest.mark.parametrize("cells", [1 << 18, 1 << 10])
def test_near_vectors_against_brute_force(spark, cells):
    rng = np.random.default_rng(9)
    rows = []
    for label, size, dims in ((0, 130, 64), (1, 130, 64), (1, 40, 20), (2, 30, 5)):
        heads = rng.standard_normal((size // 4, dims))
        for k in range(size):
            noise = rng.standard_normal(dims) * rng.choice([0.0, 0.1, 0.14, 0.2])
            rows.append((len(rows), ((heads[k % len(heads)] + noise) * rng.choice([1, 1e-200, 1e200])).tolist(), label))
    rows += [(len(rows) + k, v, 3) for k, v in enumerate([[1e-200, 1e-200], [2e-200, 2e-200], [1e200, 1.0], [2e200, 2.0], [5e-324, 0.0], [0.0, 5e-324]])]
    out = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), tile_cells=cells).collect()}
    norm = [np.array(v) / np.abs(v).max() for _, v, _ in rows]
    norm = [v / np.sqrt((v * v).sum()) for v in norm]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if rows[i][2] == rows[j][2] and len(norm[i]) == len(norm[j]) and norm[i] @ norm[j] >= 0.98]
    count, group = [0] * len(rows), list(range(len(rows)))
    for i, j in links:
        count[i] += 1
        count[j] += 1
        if group[i] != group[j]:
            lo, hi = sorted((group[i], group[j]))
            group = [lo if g == hi else g for g in group]
    assert len(links) > 100 and out == {i: (count[i], group[i]) for i in range(len(rows))}


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_components_in_several_tasks(spark, size):
    rng = np.random.default_rng(size)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(500, k) for k in range(501, 560)] + [(k, k + 1) for k in range(600, 640)]
    group = {x: x for p in pairs for x in p if p[0] != p[1]}
    for a, b in pairs:
        if a != b and group[a] != group[b]:
            lo, hi = sorted((group[a], group[b]))
            group = {x: lo if g == hi else g for x, g in group.items()}
    out = components(spark.createDataFrame(pairs, "a long, b long"), rows_a_task=size * 10).collect()
    assert {r["id"]: r["component"] for r in out} == group and len(out) == len(group)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(40, 41), (41, 40), (50, 50), (None, 3)], "a long, b long")
    out = {r["id"]: r["component"] for r in components(edges).collect()}
    assert out == {**{i: 1 for i in range(1, 31)}, 40: 40, 41: 40}


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(2)
    emit, trans, start = rng.random((5, 2)) + 0.1, rng.random((2, 2)) + 0.1, rng.random(2) + 0.1
    first = np.array([True, False, False, True, False])
    total, sums = 0, np.zeros((5, 2))
    for code in range(32):
        path = [code >> k & 1 for k in range(5)]
        weight = np.prod([(start[s] if first[t] else trans[path[t - 1], s]) * emit[t, s] for t, s in enumerate(path)])
        total += weight
        for t, s in enumerate(path):
            sums[t, s] += weight
    assert np.allclose(langid.forward_backward(emit, first, trans, start, steps=2)[0], sums / total)


def test_samples_are_bounded(spark):
    rows = spark.range(30_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), F.when(F.col("id") < 20_000, F.lit(1)).otherwise(F.col("id"))).alias("t"), F.lit("en").alias("y"))
    seen = common.fit_on_sample(rows.select(F.xxhash64("doc_id", "t").alias("h"), "t", "y"), 500, lambda texts, labels: (len(texts), len(set(texts))))
    assert 450 < seen[0] <= 500 and seen[0] == seen[1]


def test_long_texts_are_as_uncut():
    rng = np.random.default_rng(1)
    words = ["the", "house", "und", "der", "baum", "tree"]
    texts = ["the house and the tree", " ".join(rng.choice(words, 3000)) + "," + "x" * 500 + "." + "\u3000".join(rng.choice(words, 200)), "a" * 700, "", None]
    for most in (64, 1000):
        whole = [t for run, _ in textgrams.pieces(texts, most) for t in run]
        assert ["".join(t for i, t in whole if i == k) for k in range(len(texts))] == [t or "" for t in texts]
        parts = sorted(sum((textgrams.Words([t]).hashes().tolist() for _, t in whole), []))
        assert parts == sorted(textgrams.Words([t or "" for t in texts]).hashes().tolist())
    model = langid.fit(["the house and the tree"] * 9 + ["das haus und der baum"] * 9, ["en"] * 9 + ["de"] * 9)
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts)], ["doc_id", "_text"])
    got = []
    for most in (64, 1 << 20):
        class Shared:
            value = model
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(langid, "pieces", lambda t, most=most: textgrams.pieces(t, most))
            (out,) = langid._predictor(Shared, "doc_id", {})([batch])
        got.append(out.column("score").to_numpy())
    assert np.allclose(got[0], got[1], atol=1e-12)


def test_language_and_toxicity_learn(spark):
    rows = [(i, ("the house and the tree " if i % 2 else "das haus und der baum ") * 4 + ("idiot" if i % 3 == 0 else "nice") + f" {i}", "en" if i % 2 else "de", int(i % 3 == 0)) for i in range(240)]
    known = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    tests = docs(spark, ["the tree", "der baum und das", None, "123 !", "idiott", "nice the tree"])
    langs = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(tests, langid.train(known)).collect()}
    assert langs[0][0] == "en" and langs[1][0] == "de" and langs[2] == langs[3] == ("und", 0.0)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(tests, toxicity.train(known)).collect()}
    assert scores[4] > 0.7 > scores[5] and scores[2] == scores[3]


def _chat(spark, turns, parts=None):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("lines", F.lit(1))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts or before))
        rows = chat.transcript_rows(df, carry=("role",))
        return chat.parse_transcripts(rows.drop("role"), chat.count_model(rows)).orderBy("conv", "turn_no").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_chat_roles(spark):
    turns = [(c, t, r, f"{m}: some words {t}\nand more") for c in range(30) for t, (r, m) in enumerate([("user", "User"), ("assistant", "Bot"), ("user", "Q"), ("assistant", "A")])]
    out = _chat(spark, [*turns, (99, 0, "user", None), (None, None, "user", "User: x"), (None, 3, "assistant", "Bot: y")])
    mine = [r for r in out if r["conv"] == 7]
    assert [(r["turn_no"], r["role"]) for r in mine] == [(0, "user"), (1, "assistant"), (2, "user"), (3, "assistant")]
    assert mine[0]["rendered"] == "<|user|>\nsome words 0\nand more<|end|>"
    assert [r["text"] for r in out if r["conv"] == 99] == [""] and [r["text"] for r in out if r["conv"] is None] == ["x", "y"]
    assert chat.parse_transcripts(chat.transcript_rows(spark.createDataFrame([], "conv_id long, turn long, text string")), {"shown": [], "moves": []}).count() == 0


def test_chat_keeps_words_that_look_like_markers(spark):
    text = {"user": "User: Answer: is this it?\nCustomer-facing words\nAI-based words", "assistant": "Assistant: User: yes\nModel-driven"}
    turns = [(c, t, r, text[r]) for c in range(20) for t, r in enumerate(["user", "assistant"])]
    out = [(r["role"], r["text"]) for r in _chat(spark, turns) if r["conv"] == 3]
    assert out == [("user", "Answer: is this it?\nCustomer-facing words\nAI-based words"), ("assistant", "User: yes\nModel-driven")]


def test_chat_of_long_conversations_is_as_uncut(spark):
    rng = np.random.default_rng(4)
    marks = {"user": ["User: ", "Q: ", ""], "assistant": ["Bot: ", "A: ", ""]}
    turns = []
    for c in (1, 2, 3):
        for t in range(900 if c == 2 else 20):
            r = ("user", "assistant")[t % 2]
            turns.append((c, t, r, str(rng.choice(marks[r])) + "\n".join("w" * int(rng.integers(1, 200 if r == "user" else 900)) for _ in range(int(rng.integers(1, 4))))))
    turns += [(2, 5, "user", "User: again")] * 300  # one place, many times
    one, many = _chat(spark, turns, 1), _chat(spark, turns, 13)
    assert one == many and len(one) > 500


def test_viterbi_against_enumeration():
    rng = np.random.default_rng(8)
    start, move = np.log(rng.random(3)), np.log(rng.random((3, 3)))
    show = {k: np.log(rng.random(3)) for k in "ab"}
    text = "abbab"
    value = lambda p: start[p[0]] + sum(show[c][s] for c, s in zip(text, p, strict=True)) + sum(move[x, y] for x, y in zip(p, p[1:], strict=False))
    best = max(itertools.product(range(3), repeat=5), key=value)
    assert tuple(chat.viterbi(list(text), start, move, show, np.zeros(3))) == best
    first = start + show["a"] + 0
    parts = [(first[:, None] + chat.transfer(list("b"), move, show, np.zeros(3))).max(0), chat.transfer(list("ba"), move, show, np.zeros(3)), chat.transfer(list("b"), move, show, np.zeros(3))]
    assert chat.chained(parts) == [(None, best[1]), (best[1], best[3]), (best[3], best[4])]
    assert tuple(chat.viterbi(list("ba"), start, move, show, np.zeros(3), best[1], best[3])) == best[2:4]


@pytest.mark.parametrize("keys", [0, 1, 2, 1000])
def test_perfect_hash(keys):
    words = [f"k{i}".encode() for i in range(keys)]
    table = bpe.PerfectHash(words)
    assert sorted(table.slot_key) == sorted(words)
    assert table.find([*words, b"no", b""]) == [*range(keys), None, None]
    assert bpe.PerfectHash.of_ranks({w: i * 3 for i, w in enumerate(words)}).find(words) == [i * 3 for i in range(keys)]
