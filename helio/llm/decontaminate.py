"""Benchmark decontamination by a prefix-filtered join of word shingles: DataFrame operations only.

A benchmark item is cut into windows of ``size`` consecutive words (an item of fewer is one window), a window into word
shingles. A first pass over the documents counts how often each of these shingles stands in them, which puts a window's
shingles in order of rarity. To contain a window, a document must hold one of its rarest shingles: the first of them, or
as many as the share that may differ allows. Only these prefix shingles are joined with the shingles of documents, at
places where the whole window has room before and behind (length and position), and each candidate is verified over
as many words as the window has. A window of which too few shingles occur anywhere is not looked for at all.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helio.llm.license_scan import words_of

#: Words in a shingle; a shorter window is one shingle.
K = 3


def item_windows(benchmark: DataFrame, size: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows: _win (words), _items (ids as text of the items that have it), _set (a digest of these). Items without words have none; a null id is no item."""
    words = benchmark.select(F.col(id_col).cast("string").alias("_item"), words_of(F.col(text_col)).alias("_w")).where(F.size("_w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_w") - (size - 1), F.lit(1)))
    each = words.select("_item", F.explode(F.transform(starts, lambda i: F.slice("_w", i, size))).alias("_win"))
    out = each.groupBy("_win").agg(F.array_sort(F.collect_set("_item")).alias("_items"))
    return out.withColumn("_set", F.md5(F.to_json("_items")))


def _hash(word, width: int) -> Column:
    """Of ``width`` words from ``word(0)`` on; null where one lacks."""
    words = [word(i) for i in range(width)]
    return F.when(words[-1].isNotNull(), F.xxhash64(F.lit(width), *words))


def _shingles(windows: DataFrame) -> DataFrame:
    """A row for each shingle of each window: _win, _set, _len, _m (shingles of the window), _at (its first word there, from 0), _width, _gram."""
    rows = windows.select("_win", "_set", F.size("_win").alias("_len")).withColumn("_width", F.least("_len", F.lit(K)))
    rows = rows.withColumn("_m", F.col("_len") - F.col("_width") + 1).withColumn("_at", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)))
    gram = F.coalesce(*[F.when(F.col("_width") == k, _hash(lambda i: F.get("_win", F.col("_at") + i), k)) for k in range(1, K + 1)])  # noqa: B023
    return rows.withColumn("_gram", gram)


def _places(docs: DataFrame, widths: list[int]) -> DataFrame:
    """A row for each word of each document (one with a null place for a document without words) and width: _row, _id, _n, _w, _pos, _gram."""
    rows = docs.select("_row", "_id", "_w", F.size("_w").alias("_n"), F.posexplode_outer("_w").alias("_pos", "_word"))
    grams = [_hash(lambda i: F.get("_w", F.col("_pos") + i) if i else F.col("_word"), k) for k in widths]
    return rows.withColumn("_gram", grams[0] if len(grams) == 1 else F.explode(F.array(*grams))).drop("_word")


def _contained(need: int | None) -> Column:
    """Whether the words at the candidate place are the window's, or at least ``_need`` of its shingles stand in their places there."""
    here = F.slice("_w", F.col("_pos") - F.col("_at") + 1, F.col("_len"))
    if need is None:
        return here == F.col("_win")
    same = F.zip_with(here, F.col("_win"), lambda x, y: x == y)
    whole = F.filter(F.sequence(F.lit(0), F.col("_m") - 1), lambda i: F.forall(F.slice(same, i + 1, F.col("_width")), lambda x: x))
    return F.size(whole) >= F.col("_need")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10, containment: float = 1.0, id_col: str = "doc_id", text_col: str = "text", block: int = 200_000) -> DataFrame:
    """One row per input row: ``id_col``, n_words, n_hit, n_items, items_sha256, contaminated.

    A window occurs where at least ``containment`` of its shingles (all: the very words) stand in a row; n_hit
    counts the words inside any occurrence, n_items the items with an occurring window, items_sha256 is of their ids,
    sorted as text and joined by commas. A null or empty text has no words. Repeated rows, also of null ids, come
    back as often as they are given; items of one id count once; without items nothing is contaminated; an
    empty table gives no rows, and other columns are ignored. A text's words have to fit in a task.

    Windows are broadcast in blocks of at most ``block`` pairs of window and item, each block against all documents, so
    a benchmark of any size is joined in bounded memory and texts are not shuffled.
    """
    windows = item_windows(benchmark, size)
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), words_of(F.col(text_col)).alias("_w"))
    grams = _shingles(windows)
    shape = grams.agg(F.collect_set("_width").alias("widths"), F.count(F.lit(1)).alias("n")).first()
    widths = sorted(shape["widths"]) or [K]
    pairs = windows.agg(F.sum(F.greatest(F.size("_items"), F.lit(1)) * F.size("_win")).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(max(pairs / size, shape["n"] / size) / block))
    places = _places(rows, widths)

    def part(df: DataFrame, k: int, by: str) -> DataFrame:
        return F.broadcast(df if blocks == 1 else df.where(F.pmod(F.xxhash64(by), F.lit(blocks)) == k))

    # First pass: how rare the windows' shingles are.
    counts = None
    for k in range(blocks):
        one = places.select("_gram").join(part(grams.select("_gram").distinct(), k, "_gram"), "_gram").groupBy("_gram").agg(F.count(F.lit(1)).alias("_freq"))
        counts = one if counts is None else counts.unionAll(one)
    need = F.ceil(F.lit(containment) * F.col("_m") - 1e-9).cast("int")
    rarity = Window.partitionBy("_win").orderBy("_freq", "_at")
    known = grams.join(counts, "_gram").withColumn("_need", F.greatest(need, F.lit(1)))  # the shingles that occur
    known = known.withColumns({"_rank": F.row_number().over(rarity), "_found": F.count(F.lit(1)).over(Window.partitionBy("_win"))})
    # Of the missing ones, which are the rarest, each takes one place of the prefix.
    prefix = known.where("_found >= _need AND _rank <= _found - _need + 1").drop("_rank", "_found", "_freq")
    # Second pass: candidates by the prefix alone, within bounds, verified word by word.
    room = (F.col("_pos") >= F.col("_at")) & (F.col("_pos") - F.col("_at") + F.col("_len") <= F.col("_n"))
    hits = None
    for k in range(blocks):
        right = part(prefix.withColumnRenamed("_gram", "_p"), k, "_win")
        one = places.join(right, (F.col("_gram") == F.col("_p")) & room & _contained(None if containment >= 1 else 1), "left")
        first = F.coalesce(F.col("_pos"), F.lit(0)) == 0 if k == 0 else F.lit(False)  # a row for each document goes along once
        one = one.where(F.col("_p").isNotNull() | first).select("_row", "_id", "_n", "_set", (F.col("_pos") - F.col("_at")).alias("_start"), (F.col("_pos") - F.col("_at") + F.col("_len")).alias("_end"))
        hits = one if hits is None else hits.unionAll(one)
    before = Window.partitionBy("_row").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("_end") - F.greatest(F.col("_start"), F.coalesce(F.max("_end").over(before), F.lit(0))), F.lit(0))
    each = hits.withColumn("_fresh", F.when(F.col("_start").isNotNull(), fresh).otherwise(0))
    found = each.groupBy("_row").agg(F.first("_id").alias("_id"), F.first("_n").alias("_n"), F.sum("_fresh").alias("_hit"), F.collect_set("_set").alias("_sets"))
    sets = windows.select("_set", "_items").distinct()
    listed = found.withColumn("_set", F.explode_outer("_sets")).join(F.broadcast(sets) if blocks == 1 else sets, "_set", "left")
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_set("_items"))))
    out = listed.groupBy("_row").agg(F.first("_id").alias(id_col), F.first("_n").cast("long").alias("n_words"), F.first("_hit").alias("n_hit"), items.alias("_i"))
    return out.select(id_col, "n_words", "n_hit", F.size("_i").cast("long").alias("n_items"), F.sha2(F.array_join("_i", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
