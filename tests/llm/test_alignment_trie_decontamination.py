"""Token alignment, conversation trie and decontamination against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helio.llm import align, prefix_trie
from helio.llm.decontaminate import decontaminate, item_windows

BYTE_BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, _id string, _row string, places string, n_words string"
TEXTS = [None, "", " ", "a", "Hello world", "Hello world", "two  spaces", " lead", "tail \n", "日本語 12345 don't", "a▁b", "<|endoftext|> plain", "\x00\x01", "naïve café 👩‍👩‍👧", "x" * 5000, "The quick brown fox. " * 200, "ﬁ ½ Å"]


def docs(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "c", "c", "c", "c") for i, t in zip(ids or range(len(texts)), texts)], DOCS).repartition(3)


def brute_alignment(texts):
    """Each text's ids by the tokenizers and sentencepiece libraries, groups by sets of ends, links one by one."""
    t, sp = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    t.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    piece = lambda p: bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
    held, counts = [], collections.Counter()
    for text in texts:
        text = text or ""
        a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        spelled = [[bytes(byte[c] for c in t.id_to_token(i)) for i in a], [piece(sp.id_to_piece(i)) for i in b]]
        if not text or any(b"".join(x) != (" " + text).encode() for x in spelled):
            held.append(None)
            continue
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelled]
        groups, cuts = [], sorted(set(ends[0]) & set(ends[1]))
        for lo, hi in zip([0, *cuts], cuts):
            groups.append(tuple([i for i, e in zip(ids, end) if lo < e <= hi] for ids, end in zip((a, b), ends)))
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        held.append((a, b, groups, links))
        counts.update(set(links))
    best = collections.defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for one in held:
        if one is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            a, b, groups, links = one
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            out.append((len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest()))
    return out, held


def test_alignment_against_brute_force(spark, monkeypatch):
    want, held = brute_alignment(TEXTS)
    assert any(w[0] == 0 for w in want[2:]) and any(w[3] > w[0] for w in want)
    got = align.align_documents(docs(spark, TEXTS), BYTE_BPE, PIECES)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert [tuple(r)[1:] for r in got.orderBy("doc_id").collect()] == want
    groups = {r["doc_id"]: r["groups"] for r in align.token_groups(docs(spark, TEXTS), BYTE_BPE, PIECES).collect()}
    for i, one in enumerate(held):
        assert [(g["a"], g["b"]) for g in groups[i]] == ([] if one is None else one[2])
        assert not groups[i] or groups[i][-1]["end"] == len((" " + TEXTS[i]).encode())


def test_alignment_of_null_and_repeated_ids_and_no_rows(spark):
    rows = docs(spark, ["Hello world"] * 4, [None, None, 7, 7])
    got = align.align_documents(rows, BYTE_BPE, PIECES).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["7", "7", "None", "None"] and {r["count_sum"] for r in got} == {4 * got[0]["n_links"]}
    assert align.align_documents(docs(spark, []), BYTE_BPE, PIECES).count() == 0
    assert {tuple(r)[1:] for r in align.align_documents(docs(spark, [None, ""]), BYTE_BPE, PIECES).collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_pair_counts_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(align, "LOT_BYTES", 40)
    words = random.Random(3)
    texts = [" ".join(words.choice(["alpha", "beta", "gamma", "zyxw", "don't", "北京"]) for _ in range(words.randrange(12))) for _ in range(60)]
    rows = docs(spark, texts).coalesce(1)
    monkeypatch.setattr(align, "BLOCK_BYTES", 150)
    blocks = align.aligned_blocks(rows, BYTE_BPE, PIECES).cache()
    want = collections.Counter(x for one in brute_alignment(texts)[1] if one for x in set(one[3]))
    assert {(r["a_id"], r["b_id"]): r["n_docs"] for r in align.pair_counts(blocks).collect()} == want


def test_ends_and_wide_groups(monkeypatch):
    rng = np.random.default_rng(1)
    for _ in range(300):
        end = int(rng.integers(1, 200))
        a, b = (np.append(np.sort(rng.choice(np.arange(1, end), size=int(rng.integers(0, end)), replace=False)) if end > 1 else np.zeros(0, np.int64), end).astype(np.int64) for _ in range(2))
        common = np.intersect1d(a, b)
        cut_a, cut_b = align.align_ends(a, b)
        assert (a[cut_a - 1] == common).all() and (b[cut_b - 1] == common).all() and len(cut_a) == len(common)
        ids_a, ids_b = rng.integers(0, 4, len(a)), rng.integers(0, 4, len(b))
        plain = collections.Counter()
        for g, p, o in zip(*align._links(ids_a, ids_b, cut_a, cut_b)):
            plain[(int(g), int(p))] += int(o)
        with monkeypatch.context() as m:
            m.setattr(align, "WIDE", 3)
            wide = collections.Counter()
            for g, p, o in zip(*align._links(ids_a, ids_b, cut_a, cut_b)):
                wide[(int(g), int(p))] += int(o)
        assert plain == wide
    assert all(len(x) == 0 for x in align.align_ends(np.zeros(0, np.int64), np.zeros(0, np.int64)))
    long = np.arange(1, 100_001)
    assert len(align.align_ends(long, long)[0]) == 100_000


CONV = "conv_id long, turn long, role string, text string, depth string, node string"


def brute_trie(paths):
    """paths: conversation to its list of (role, text)."""
    members = collections.defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[: len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        ends = sorted(c for c in convs if len(paths[c]) == len(node))
        leaves = sum(not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below) for x in below)
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids), leaves, saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def trie_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def some_conversations(seed):
    rng = random.Random(seed)
    rows, turns = [], [("user", "hi"), ("assistant", "hello"), ("user", "né"), (None, "x"), ("user", None), ("", "long " * 9)]
    for c in rng.sample(range(0, 400), 60) + [100, 200, 300]:
        rows += [(c, t if t else None, *rng.choice(turns[: rng.choice([1, 2, 6])])) for t in range(rng.randrange(0, 14))]
    return rows


def ordered(rows):
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            by[c].append((t is not None, t or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), (role, text)))
    return {c: [x[-1] for x in sorted(v)] for c, v in by.items()}


@pytest.mark.parametrize(("seed", "most"), [(1, 200_000), (2, 40), (3, 1)])
def test_trie_against_brute_force(spark, seed, most):
    rows = some_conversations(seed)
    plain = ordered(rows)
    df = spark.createDataFrame([(*r, "c", "c") for r in rows], CONV).repartition(5)
    turns = prefix_trie.conversation_turns(df)
    assert trie_rows(prefix_trie.prefix_trie(turns, most)) == brute_trie(plain)
    built = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = plain.get(c - c % 100, [])[:h] + own[h:]
    assert trie_rows(prefix_trie.prefix_trie(prefix_trie.branched(turns), most)) == brute_trie(built)


def test_trie_of_copies_long_conversations_and_no_rows(spark):
    long = [(9, t, "user", f"turn {t % 7}") for t in range(700)]
    rows = [(c, t, "user", "same") for c in range(20, 80) for t in range(3)] + long + [(c, t, r, x) for c in (10, 11) for _, t, r, x in long[:640]] + [(11, 640, "user", "odd"), (None, 0, "user", "lost")]
    df = spark.createDataFrame([(*r, "c", "c") for r in rows], CONV)
    assert trie_rows(prefix_trie.prefix_trie(prefix_trie.conversation_turns(df))) == brute_trie(ordered(rows))
    assert prefix_trie.prefix_trie(prefix_trie.conversation_turns(df.limit(0))).count() == 0


def test_ids_of_one_end_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = spark.range(500).select(F.when(F.col("id") < 450, b"hot").otherwise(F.col("id").cast("string").cast("binary")).alias("node"), (F.col("id") * 13 % 500 - 200).alias("conv_id"))
    got = {bytes(r["node"]): r["ends_sha256"] for r in prefix_trie.end_digests(rows.repartition(4)).collect()}
    ids = sorted(i * 13 % 500 - 200 for i in range(450))
    assert len(got) == 51 and got[b"hot"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_fat_binary_search_and_splits():
    rng = random.Random(5)
    for low, high in ((0, 1), (0, 5), (4, 6), (4, 7), (7, 8), (8, 12)):
        assert prefix_trie.two_fattest(low, high) == max(range(low + 1, high + 1), key=lambda x: (x & -x, x))
    trie, kept = prefix_trie.ZFastTrie(), []
    for _ in range(400):
        turns = b"".join(bytes([rng.choice(b"ab")]) * prefix_trie.TURN for _ in range(rng.randrange(12)))
        kept.append(turns)
        node, until = trie.insert(turns, [1] * (len(turns) // prefix_trie.TURN))
        node.add(1, len(kept), until[-1], 0, 0, None)
    prefixes = {t[: d * prefix_trie.TURN] for t in kept for d in range(len(t) // prefix_trie.TURN + 1)}
    rows = list(trie.expand())
    assert len(rows) == len({r[0] for r in rows}) == len(prefixes)
    counts = {prefix_trie.prefix_digests(p)[-1]: sum(t[: len(p)] == p for t in kept) for p in prefixes}
    assert {r[0]: r[3] for r in rows} == counts


ITEM = "item_id long, text string, _item string, _w string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_contamination(texts, items, size=10, share=1.0, k=3):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - size, 0) + 1 if w else 0):
            windows[tuple(w[i : i + size])].add(None if item is None else str(item))
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for win, of in windows.items():
            n, width = len(win), min(k, len(win))
            m = n - width + 1
            need = -int(-(share * m - 1e-9) // 1)
            for s in range(len(w) - n + 1):
                if sum(tuple(w[s + i : s + i + width]) == win[i : i + width] for i in range(m)) >= max(need, 1):
                    hit |= set(range(s, s + n))
                    found |= of
        found.discard(None)
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def contaminated_texts(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Um", "zwölf", "x1", "and", "que", "été"]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(say(rng.choice([1, 2, 5, 10, 11, 30])))) for i in range(12)] + [(3, " ".join(say(14))), (None, " ".join(say(12))), (77, None), (78, " ,. "), (10, items_text := " ".join(say(25))), (9, items_text)]
    texts = [None, "", " .,", "the"]
    for _ in range(60):
        parts = say(rng.randrange(25))
        if rng.random() < 0.7:
            taken = words(rng.choice(items)[1])
            lo = rng.randrange(len(taken)) if taken else 0
            parts += taken[lo : lo + rng.choice([3, 10, 12, 30])]
            if rng.random() < 0.5 and parts:
                parts[rng.randrange(len(parts))] = "changed"
        texts.append(rng.choice([" ", ", ", "\n"]).join(parts + say(rng.randrange(9))))
    return texts + texts[10:14], items


@pytest.mark.parametrize(("share", "block"), [(1.0, 200_000), (1.0, 20), (0.6, 200_000), (0.8, 30)])
def test_decontamination_against_brute_force(spark, share, block):
    texts, items = contaminated_texts(int(share * 10))
    bench = spark.createDataFrame([(*x, "c", "c") for x in items], ITEM)
    got = decontaminate(docs(spark, texts), bench, containment=share, block=block)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert [tuple(r)[1:] for r in got.orderBy("doc_id").collect()] == brute_contamination(texts, items, share=share)


def test_decontamination_of_null_and_repeated_ids_long_texts_and_empty_tables(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    items = spark.createDataFrame([(1, passage, "c", "c")], ITEM)
    long = " ".join(["w0 w1 w2"] * 40_000 + [passage])
    got = decontaminate(docs(spark, [passage, passage, passage, long], [None, None, 5, 6]), items).collect()
    assert sorted((str(r["doc_id"]), r["n_hit"], r["n_items"]) for r in got) == [("5", 12, 1), ("6", 12, 1), ("None", 12, 1), ("None", 12, 1)]
    clean = decontaminate(docs(spark, [passage]), items.limit(0)).collect()
    assert [tuple(r) for r in clean] == [(0, 12, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
    assert decontaminate(docs(spark, []), items).count() == 0
    assert item_windows(items).count() == 3


def test_decontamination_has_no_python_and_no_shuffle_of_texts(spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k", "c", "c")], ITEM)
    plan = decontaminate(docs(spark, ["a b c d e f g h i j k"]), items)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapInPandas" not in plan
