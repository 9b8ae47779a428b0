"""Exact dedup by content sort: DataFrame operations only.

Normalised texts are dealt by sampled range splitters and sorted externally, so equal texts become
neighbours; Spark's window compares neighbouring rows in full. The splitters are drawn over each text's first
characters and hash, so what is sampled to the driver stays small however long the texts are. Texts with more
rows than a task should take are salted over as many sorted ranges as they need; their least or largest
identifier comes from an aggregate that is combined before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helio.llm.common import ascii_lower


def hot_limit(rows: int, most: int = 10_000) -> int:
    """Rows of one text from which it is salted: ``most``, less for small tables, and so many that there are at most a million such texts."""
    return max(32, min(most, rows // 512), rows // 1_000_000)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256 and the columns ``carry``.

    Texts are equal when identical after lower-casing A-Z. ``keep``: ``min`` or ``max`` identifier stays.
    A null text counts as empty. A null id is kept only if its group has no other id. Of repeated rows with
    the same id and text exactly one is kept, the first by ``carry``. An empty table gives no rows; other
    columns are ignored.
    """
    best = {"min": F.min, "max": F.max}[keep]
    order = F.col("_id").asc_nulls_last() if keep == "min" else F.col("_id").desc_nulls_last()
    # With the text itself carried, the shuffle takes that and the normal form is made again behind it.
    whole = text_col in carry
    norm = lambda c: ascii_lower(F.coalesce(c, F.lit("")))
    rows = docs.select(F.col(id_col).alias("_id"), norm(F.col(text_col)).alias("_norm"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)])
    rows = rows.withColumns({"_h": F.xxhash64("_norm"), "_sha": F.sha2("_norm", 256)})
    limit = hot_limit(docs.count())
    # At most a million texts have more rows than the limit; here the SHA-256 stands for a text, in the sorted runs it is compared in full.
    counts = rows.groupBy("_sha").agg(best("_id").alias("_hot_keep"), F.count(F.lit(1)).alias("_hot_size")).where(F.col("_hot_size") > limit)
    rows = rows.join(F.broadcast(counts.withColumn("_salts", F.ceil(F.col("_hot_size") / limit))), "_sha", "left")
    # Rows that stay behind are spread at will; only rows with the identifier that stays must meet, as one of them is kept.
    spread = F.pmod(F.xxhash64("_id", F.monotonically_increasing_id()), F.col("_salts")) + 1
    salt = F.when(F.col("_salts").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_hot_keep")), spread).otherwise(F.lit(0).cast("long"))
    dealt = rows.withColumns({"_lead": F.substring("_norm", 1, 32), "_salt": salt})
    if whole:
        dealt = dealt.drop("_norm")
    dealt = dealt.repartitionByRange("_lead", "_h", "_salt")
    if whole:
        dealt = dealt.withColumn("_norm", norm(F.col(f"_c{carry.index(text_col)}")))
    run = Window.partitionBy("_lead", "_h", "_salt", "_norm").orderBy(order, *[F.col(f"_c{i}") for i, c in enumerate(carry) if c != text_col])
    all_ = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kept_columns = [f"_c{i}" for i in range(len(carry))]
    runs = dealt.select(
        "_id", "_sha", "_hot_keep", "_hot_size", *kept_columns, F.first("_id").over(all_).alias("_keep"), F.count(F.lit(1)).over(all_).alias("_size"), F.row_number().over(run).alias("_rn"),
    )
    out = runs.withColumn("_all_keep", F.when(F.col("_hot_size").isNull(), F.col("_keep")).otherwise(F.col("_hot_keep")))
    return out.select(
        F.col("_id").alias(id_col),
        F.col("_all_keep").alias("keep_id"),
        F.coalesce("_hot_size", "_size").alias("group_size"),
        ((F.col("_rn") == 1) & F.col("_id").eqNullSafe(F.col("_all_keep"))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
    )
