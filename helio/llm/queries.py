"""Registered queries of the corpus operators and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helio.llm import align, bpe, chat, langid, toxicity
from helio.llm.common import LOWER, UPPER
from helio.llm.decontaminate import decontaminate
from helio.llm.exact_dedup import exact_dedup
from helio.llm.license_scan import TEMPLATES, license_scan
from helio.llm.minhash import near_dedup
from helio.llm.packing import pack_documents
from helio.llm.prefix_trie import branched, conversation_turns, prefix_trie
from helio.llm.url_filter import rule_table, url_filter
from helio.llm.vectors import near_vectors


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = langid.train(docs.where(langid.fold(F.col("doc_id"), 4) != 2))
    out = langid.identify(docs, model)
    return out.select("doc_id", (langid.fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(langid.fold(F.col("doc_id"), 3) != 1)
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model)
    return out.select("doc_id", (langid.fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.bpe_round_trip(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as raw transcripts: each text gets a speaker marker in one of four styles by its conversation, every fifth none; roles are then recovered.

    The model learns from conversations whose crc32(conv_id as text) mod 4 is not 2.
    """
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    names = {"user": ("User: ", "Human: ", "Q: ", "customer> "), "assistant": ("Assistant: ", "AI: ", "A: ", "agent> "), "system": ("System: ", "Context: ", "Instructions: ", "system> ")}
    marker = F.lit("")
    for role, styles in names.items():
        for k, text in enumerate(styles):
            marker = F.when((F.col("role") == role) & (style == k), text).otherwise(marker)
    bare = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(5)) == 0
    raw = turns.withColumn("text", F.concat(F.when(bare, "").otherwise(marker), F.coalesce("text", F.lit(""))))
    rows = chat.transcript_rows(raw, carry=("role",))
    model = chat.count_model(rows.where(langid.fold(F.col("conv"), 4) != 2))
    found = chat.parse_transcripts(rows.drop("role"), model)
    return found.select(F.col("conv").alias("conv_id"), "turn_no", "role", "text", F.sha2("rendered", 256).alias("rendered_sha256"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_documents(spark, sf_dir)).drop("spans")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup(_documents(spark, sf_dir), width=4).drop("text_sha256")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))  # also of each row that shares that id


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir), keep="max")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"), rule_table(spark))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_documents(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(branched(conversation_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_packing": op2_packing,
    "op3_toxicity": op3_toxicity,
    "op4_bpe": op4_bpe,
    "op5_chat": op5_chat,
    "op6_license_scan": op6_license_scan,
    "op7_minhash": op7_minhash,
    "op8_vectors": op8_vectors,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_token_alignment": op11_token_alignment,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_decontamination": op13_decontamination,
}

_CLOSE = """reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)"""

ORACLES = {
    "op6_license_scan": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
tw AS (SELECT t, label, base, string_split(words, ' ') AS w FROM (VALUES {', '.join(str((i, *x)) for i, x in enumerate(TEMPLATES))}) v(t, label, base, words)),
tg AS (SELECT t, label, base, len(w) - 2 AS n, i AS tpos, w[i + 1] AS g0, w[i + 2] AS g1, w[i + 3] AS g2 FROM (SELECT *, unnest(range(len(w) - 2)) AS i FROM tw)),
one AS (SELECT rid, unnest(w) AS g0, generate_subscripts(w, 1) - 1 AS pos FROM d),
g AS (SELECT rid, pos, g0, lead(g0, 1) OVER o AS g1, lead(g0, 2) OVER o AS g2 FROM one WINDOW o AS (PARTITION BY rid ORDER BY pos)),
diag AS (SELECT rid, t, label, base, n, pos - tpos AS dg, list(DISTINCT tpos) AS votes FROM g JOIN tg USING (g0, g1, g2) GROUP BY ALL),
cuts AS (SELECT *, base AND len(votes) = n AS whole, CASE WHEN dg - lag(dg) OVER (PARTITION BY rid, t ORDER BY dg) <= 2 THEN 0 ELSE 1 END AS fresh FROM diag),
m AS (SELECT *, sum(fresh) OVER (PARTITION BY rid, t ORDER BY dg) AS span FROM cuts),
places AS (SELECT rid, t, span, n, tpos, min(dg + tpos) AS place FROM (SELECT *, unnest(votes) AS tpos FROM m) GROUP BY ALL),
held AS (SELECT *, coalesce(place > max(place) OVER (PARTITION BY rid, t, span ORDER BY tpos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS ok FROM places),
cover AS (SELECT rid, t, span, count(*) FILTER (ok) / any_value(n) AS cover FROM held GROUP BY ALL),
exact AS (SELECT rid, t, span, label, count(*) FILTER (whole) AS hits, min(dg) FILTER (whole) AS lo, max(dg) FILTER (whole) AS hi FROM m GROUP BY ALL),
s AS (SELECT * FROM cover JOIN exact USING (rid, t, span))
SELECT doc_id, len(w) AS n_words, CAST(coalesce(sum(hits), 0) AS BIGINT) AS n_base, min(lo) AS first_word, max(hi) AS last_word, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (hits > 0), '') AS base_labels,
 coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (hits > 0 OR cover >= 0.8), '') AS labels, coalesce(max(CASE WHEN hits > 0 THEN 1 ELSE cover END), 0) AS score FROM d LEFT JOIN s USING (rid) GROUP BY rid, doc_id, w""",
    "op7_minhash": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, hash(s) AS h, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
{_CLOSE},
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id, doc_id <= coalesce(b, doc_id) AS kept FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN least_of ON a = doc_id""",
    "op8_vectors": f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.98),
{_CLOSE},
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY 1), n AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id, vec_id <= coalesce(b, vec_id) AS kept FROM embeddings LEFT JOIN least_of ON least_of.a = vec_id LEFT JOIN n ON n.a = vec_id""",
    "op9_exact_dedup": f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g USING (norm)""",
    "op10_url_filter": f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host, regexp_extract(substring(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(verdict, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (SELECT p.page_id, r.verdict, rh || rp AS rule,
             row_number() OVER (PARTITION BY p.page_id ORDER BY length(rh || rp) DESC, length(rh) DESC, r.verdict DESC) AS rn
      FROM p JOIN r ON (p.host = rh OR ends_with(p.host, '.' || rh)) AND starts_with(p.path, rp))
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.page_id = m.page_id AND m.rn = 1""",
    "op12_prefix_trie": """
WITH c AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT conv_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
 lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(8), lambda z: CAST(0 AS BIGINT))), lambda x, z: xor(x >> 1, (x & 1) * CAST(3988292384 AS BIGINT)))), CAST(4294967295 AS BIGINT)) % 6 AS h FROM c),
t0 AS (SELECT conv_id, turn, coalesce(text, '') AS text, sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS k FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id, k, length(text) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) - 1 AS pos FROM t0),
r AS (SELECT conv_id, k, n, pos FROM t JOIN h USING (conv_id) WHERE pos >= h UNION ALL SELECT h.conv_id, k, n, pos FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 100 WHERE pos < h),
p AS (SELECT conv_id, n, row_number() OVER w AS depth, sha256(string_agg(k, '') OVER w) AS node FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
 UNION ALL SELECT conv_id, 0, 0, '' FROM c),
q AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM p),
nodes AS (SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, any_value(n) AS n, count(*) AS n_convs, min(conv_id) AS conv_id, sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM q GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY 1),
subtree AS (SELECT up.node, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * nodes.n) AS saved_tokens FROM nodes LEFT JOIN kids USING (node) JOIN p up ON up.conv_id = nodes.conv_id AND up.depth <= nodes.depth GROUP BY 1)
SELECT nodes.conv_id, nodes.depth, above.conv_id AS parent_conv_id, nodes.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN subtree USING (node) LEFT JOIN kids USING (node) LEFT JOIN nodes above ON above.node = nodes.parent""",
    "op13_decontamination": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT item, least(len(w), 10) AS n, w[i:i + 9] AS words FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
one AS (SELECT DISTINCT n, words FROM win),
pos AS (SELECT rid, n, i AS start, w[i:i + n - 1] AS words FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
occ AS (SELECT rid, start, n, words FROM pos JOIN one USING (n, words)),
hit AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(start, start + n)) AS place FROM occ) GROUP BY 1),
its AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, n, words FROM occ) JOIN win USING (n, words) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)""",
}
