from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from helio.llm import langid, toxicity
from helio.llm.minhash import near_dedup

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def _least(rows):
    return min(rows, key=lambda r: (r[0] is None, r[0] or 0))


def _shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def _expected(spark, rows, labels):
    """Rows that each stage keeps; the trained verdicts come from the operators on rows that are numbered apart."""
    frame = spark.createDataFrame(rows, KIND)

    def verdicts(rows, operator, model, good):
        numbered = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], KIND)
        return [rows[r["doc_id"]] for r in operator(numbered, model).where(good).collect()]

    known = frame.join(spark.createDataFrame(labels, "doc_id long, toxic int"), "doc_id")
    clean = verdicts(rows, toxicity.score, toxicity.train(known), "score < 0.7")
    spoken = verdicts(clean, langid.identify, langid.train(spark.createDataFrame(clean, KIND)), "lang_pred <> 'und' AND score >= 0.3")
    groups = {}
    for r in spoken:
        groups.setdefault((r[1] or "").lower(), []).append(r)
    single = [_least(g) for g in groups.values()]
    sets, group = [_shingles(r[1]) for r in single], list(range(len(single)))
    for i in range(len(single)):
        for j in range(i):
            if group[i] != group[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    unlike = [_least([r for r, g in zip(single, group, strict=True) if g == k]) for k in set(group)]
    return clean, spoken, single, unlike


def test_pipeline_against_brute_force(spark, tmp_path):
    word = {"en": "the house and the tree", "de": "das haus und der baum"}

    def row(i, lang, tail, nasty=False):
        text = " ".join([word[lang], "idiot" if nasty else "nice"] * 4 + [tail])
        return (i, text, lang, "web", len(text))

    rows = [row(i, "en" if i % 2 else "de", " ".join(f"t{i}x{k}" for k in range(24)), i % 3 == 0) for i in range(120)]
    labels = [(i, int(i % 3 == 0)) for i in range(120)]
    own = " ".join(f"u{k}" for k in range(60))
    rows += [
        row(None, "en", "alone " + own[:90]), row(None, "de", "other " + own[90:]), row(None, "en", "bad", True),  # without an id
        *[row(500, "en", own)] * 3, row(501, "en", own), row(501, "en", own + " more"), row(None, "en", own),  # a repeated row with copies
        row(600, "de", own), row(600, "de", own + " again"), row(600, "de", own + " and again"),  # one id on near copies
        row(700, "en", " ".join(f"v{k}" for k in range(24))), row(700, "en", " ".join(f"w{k}" for k in range(24)), True),  # clean and toxic
        row(800, "en", " ".join(f"y{k}" for k in range(24))), row(800, "de", " ".join(f"z{k}" for k in range(24))),  # one id on texts apart
        (900, "12 34", "en", "web", 5), (901, None, "en", "web", 0), (None, "", "en", "web", 0),
    ]
    extra = {c: F.lit("x") for c in ("toxic", "score", "kept", "_id", "node")}
    spark.createDataFrame(rows, KIND).withColumns(extra).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    # What brute force can choose freely among rows of one id (near copies of id 600) is compared by id.
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    expected = _expected(spark, rows, labels)
    for (name, stage), want in zip(corpus_pipeline.STAGES, expected, strict=False):
        docs = stage(spark, docs, str(tmp_path)).checkpoint()
        got = [tuple(r) for r in docs.collect()]
        pick = (lambda r: r[0]) if name == "near_dedup" else (lambda r: r[:2])
        assert Counter(map(pick, got)) == Counter(map(pick, want)), name
    assert {None, 500, 600, 700, 800} <= {r[0] for r in expected[-1]}
    pieces = [tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "length").collect()]
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert Counter(i for i, _ in pieces) == Counter(r["doc_id"] for r in docs.collect())
    assert sum(n for _, n in pieces) == sum(len(plain.encode(r["text"], add_special_tokens=False).ids) + 1 for r in docs.collect())


def test_pipeline_of_an_empty_table_and_one_long_text(spark, tmp_path):
    long = " ".join(f"the house {i} and the tree" for i in range(60_000))
    for name, rows in (("none", []), ("long", [(1, long, "en", "web", len(long)), (2, None, None, None, None)])):
        spark.createDataFrame(rows, KIND).write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / name / "labels.parquet"))
        out = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert {r["doc_id"] for r in out} <= {1} and len({r["piece"] for r in out}) == len(out)


def test_near_dedup_has_a_verdict_for_each_row(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(1, text), (1, text), (1, text + " x"), (2, text), (None, text), (3, "a b c d e f"), (3, "g h i j k l"), (None, "m n o p q r"), (None, "m n o p q r"), (4, ""), (4, None)]
    out = near_dedup(spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(0))).collect()
    assert len(out) == len(rows)
    kept = Counter((r["doc_id"], r["component_id"]) for r in out if r["kept"])
    assert kept == {(1, 1): 1, (3, 3): 2, (None, None): 1, (4, 4): 2}
