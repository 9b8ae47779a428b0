"""License scans by diagonal voting: DataFrame operations only.

All rolling word k-grams of a text join the k-grams of license templates by hash. Hits with the same
difference of text and template position lie on one diagonal; a diagonal that holds every k-gram of a
phrase is a verbatim place. Neighbouring diagonals (words put in or left out) are merged, and spans that
are verified to cover enough of a template, in its order, count as a looser match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helio.llm.common import ascii_lower

K = 3
#: label, base (verbatim places are counted), words; each at least K words. Sentences of public licences, of the notices
#: that they ask for, and the usual statements that a work is under them.
TEMPLATES = (
    ("mit", True, "under the mit license"),
    ("apache-2", True, "apache license version 2"),
    ("cc-by-nc", True, "cc by nc"),
    ("mit", False, "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", False, "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache-2", False, "licensed under the apache license version 2 0 the license you may not use this file"),
    ("apache-2", False, "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("bsd", False, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", False, "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", False, "licensed under the bsd license"),
    ("isc", False, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl", False, "under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", False, "this program is free software you can redistribute it and or modify it"),
    ("gpl", False, "licensed under the gnu general public license"),
    ("gpl", False, "released under the gnu general public license"),
    ("lgpl", False, "under the terms of the gnu lesser general public license"),
    ("lgpl", False, "licensed under the gnu lesser general public license"),
    ("agpl", False, "under the terms of the gnu affero general public license"),
    ("agpl", False, "licensed under the gnu affero general public license"),
    ("mpl-2", False, "subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2", False, "licensed under the mozilla public license version 2 0"),
    ("epl-2", False, "made available under the terms of the eclipse public license"),
    ("unlicense", False, "this is free and unencumbered software released into the public domain"),
    ("cc0", False, "cc0 1 0 universal public domain dedication"),
    ("cc-by-sa", False, "creative commons attribution share alike"),
    ("cc-by-sa", False, "creative commons attribution sharealike"),
    ("cc-by-nc", False, "creative commons attribution non commercial"),
    ("cc-by-nc", False, "creative commons attribution noncommercial"),
    ("cc-by", False, "licensed under a creative commons attribution license"),
)
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words: runs of ASCII letters and digits and of all other non-ASCII characters."""
    one = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD, " "))
    return F.when(one == "", F.array().cast("array<string>")).otherwise(F.split(one, " "))


def template_grams(spark: SparkSession, templates=TEMPLATES, k: int = K) -> DataFrame:
    """One row per template position: t, label, base, n_grams, tpos, g0..; as many rows as the templates have words."""
    rows = []
    for t, (label, base, text) in enumerate(templates):
        words = text.split()
        if len(words) < k:
            raise ValueError(f"template of fewer than {k} words: {text}")
        rows += [(t, label, base, len(words) - k + 1, i, *words[i : i + k]) for i in range(len(words) - k + 1)]
    names = ", ".join(f"g{i} string" for i in range(k))
    return spark.createDataFrame(rows, f"t int, label string, base boolean, n_grams int, tpos int, {names}").withColumn("gram", F.xxhash64(*[f"g{i}" for i in range(k)]))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, drift: int = 2, cover: float = 0.8) -> DataFrame:
    """One row per input row: ``id_col``, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Diagonals at most ``drift`` apart are merged; a merged span counts from ``cover`` of a template's k-grams,
    each taken once and in the template's order.
    spans: array of (label, start, coverage), looser ones included. score: the largest coverage, 0 without a hit.
    A null or empty text has no words and no labels. Repeated rows come back as often as they are given; an empty
    table gives no rows, and other columns are ignored. A text's words have to fit in a task, some times over.
    """
    spark = docs.sparkSession
    grams = template_grams(spark, templates)
    # A row with no gram goes along for each text; it carries the number of words, so one pass over the texts is enough.
    mark = spark.createDataFrame([(-1, None, False, 0, -1)], "t int, label string, base boolean, n_grams int, tpos int")
    grams = grams.unionByName(mark, allowMissingColumns=True).fillna({"gram": 0, **{f"g{i}": "" for i in range(K)}})
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_key"), words_of(F.col(text_col)).alias("_w"))
    rows = rows.withColumn("_n", F.size("_w"))
    # A slice for each place in a gram; the empty gram stands first, so a gram at array index i starts at word i - 1.
    shifted = [F.concat(F.array(F.lit("")), F.slice("_w", i + 1, F.greatest(F.col("_n"), F.lit(1)))).alias(f"g{i}") for i in range(K)]
    each = rows.select("_id", "_key", "_n", F.posexplode(F.arrays_zip(*shifted)).alias("_i", "_g"))
    each = each.select("_id", "_key", "_n", (F.col("_i") - 1).alias("_pos"), *[F.col(f"_g.g{i}").alias(f"d{i}") for i in range(K)])
    each = each.where(F.col(f"d{K - 1}").isNotNull()).withColumn("_hash", F.when(F.col("_pos") < 0, F.lit(0)).otherwise(F.xxhash64(*[f"d{i}" for i in range(K)])))
    same = F.col("_hash") == F.col("gram")
    for i in range(K):
        same &= F.col(f"d{i}") == F.col(f"g{i}")
    hits = each.join(F.broadcast(grams), same)
    # Copies of one row hit the same places, hence the distinct template positions; the mark counts the copies.
    diagonals = hits.groupBy("_id", "_key", "t", "label", "base", "n_grams", (F.col("_pos") - F.col("tpos")).alias("_diag")).agg(
        F.sort_array(F.collect_set("tpos")).alias("_at"), F.max("_n").alias("_n"), F.sum(F.when(F.col("t") < 0, 1)).alias("_copies"))
    order = Window.partitionBy("_id", "_key", "t").orderBy("_diag")
    new = F.coalesce((F.col("_diag") - F.lag("_diag").over(order) > drift).cast("int"), F.lit(1))
    merged = diagonals.withColumn("_new", new).withColumn("_span", F.sum("_new").over(order))
    # Spans are verified: each template position counts once, and only where it stands behind those before it.
    exact = F.col("base") & (F.size("_at") == F.col("n_grams"))
    each = merged.withColumn("_whole", exact).select("*", F.posexplode("_at").alias("_k", "_tpos"))
    exact = F.col("_whole") & (F.col("_k") == 0)  # a diagonal counts at its first position
    places = each.groupBy("_id", "_key", "t", "label", "n_grams", "_span", "_tpos").agg(
        F.min(F.col("_diag") + F.col("_tpos")).alias("_place"), F.min("_diag").alias("_start"), F.max("_n").alias("_n"), F.max("_copies").alias("_copies"),
        F.count_if(exact).alias("_exact"), F.min(F.when(exact, F.col("_diag"))).alias("_first"), F.max(F.when(exact, F.col("_diag"))).alias("_last"))
    before = Window.partitionBy("_id", "_key", "t", "_span").orderBy("_tpos").rowsBetween(Window.unboundedPreceding, -1)
    places = places.withColumn("_ordered", F.coalesce(F.col("_place") > F.max("_place").over(before), F.lit(True)))
    spans = places.groupBy("_id", "_key", "t", "label", "n_grams", "_span").agg(
        F.min("_start").alias("_start"), (F.count_if("_ordered") / F.greatest(F.first("n_grams"), F.lit(1))).alias("_cover"),
        F.max("_n").alias("_n"), F.max("_copies").alias("_copies"),
        F.sum("_exact").alias("_exact"), F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    found = (F.col("t") >= 0) & ((F.col("_cover") >= cover) | (F.col("_exact") > 0))
    out = spans.groupBy("_id", "_key").agg(
        F.max("_n").alias("n_words"), F.max("_copies").alias("_copies"), F.sum("_exact").alias("n_base"),
        F.min("_first").alias("first_word"), F.max("_last").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("_exact") > 0, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(found, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(F.col("t") >= 0, F.when(F.col("_exact") > 0, 1.0).otherwise(F.col("_cover")))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(found, F.struct("label", F.col("_start").alias("start"), F.col("_cover").alias("coverage"))))).alias("spans"))
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    longs = [F.col(c).cast("long").alias(c) for c in ("n_words", "n_base", "first_word", "last_word")]
    return out.select(F.col("_id").alias(id_col), *longs, "base_labels", "labels", "score", "spans")
