"""URL filters by host-suffix and path-prefix expressions: DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helio.llm.common import ascii_lower

RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """Rules as rows: verdict, rule_host, rule_path."""
    return spark.createDataFrame(list(rules), "verdict string, rule_host string, rule_path string")


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", broadcast_rules: int = 1_000_000) -> DataFrame:
    """One row per input row: ``id_col``, host, path, rule, verdict.

    The host stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path
    goes on to ``?``, ``#`` or the end; a null url or one without ``://`` gives two empty strings. A rule fits
    its host and all subdomains when the path starts with the rule's path. The longest rule (host and path
    together) wins; of equally long ones the one with the longer host, and then ``block`` before ``allow``.
    Without a rule the verdict is ``default``. Repeated rows and null ids come back as often as they are given;
    an empty table gives no rows, and other columns are ignored.

    Each url is expanded only into suffixes and prefixes of lengths that some rule has. The expressions join
    the rules on a short hash prefix alone; what shares it is confirmed by the full digest. Rules are broadcast up to ``broadcast_rules``.
    """
    rules = rules.select("verdict", ascii_lower(F.col("rule_host")).alias("_rh"), F.col("rule_path").alias("_rp")).where("_rh IS NOT NULL AND _rp IS NOT NULL").distinct()
    shape = rules.agg(F.collect_set(F.size(F.split("_rh", r"\."))).alias("h"), F.collect_set(F.char_length("_rp")).alias("p"), F.count(F.lit(1)).alias("n")).first()
    at = F.locate("://", F.col(url_col))
    rest = F.when(at > 0, F.substring(F.col(url_col), at + 3, F.char_length(url_col))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    rows = (
        pages.select(F.col(id_col).alias("_id"), host.alias("_h"), rest.alias("_rest"))
        .select("_id", ascii_lower(F.col("_h")).alias("host"), F.regexp_extract(F.expr("substring(_rest, char_length(_h) + 1)"), r"^[^?#]*", 0).alias("path"))
        .groupBy("_id", "host", "path").agg(F.count(F.lit(1)).alias("_n"))
    )
    if not shape["n"]:
        out = rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    else:
        # substring_index gives the whole host when it has fewer labels than asked for; array_distinct drops repeats.
        suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -k) for k in sorted(shape["h"])]))
        prefixes = F.array_distinct(F.array(*[F.substring("path", 1, k) for k in sorted(shape["p"])]))
        digest = lambda h, p: F.sha2(F.concat(h, F.lit("\n"), p), 256)  # noqa: E731  no host holds a line break before a rule's path
        keyed = rules.select("verdict", "_rh", "_rp", digest(F.col("_rh"), F.col("_rp")).alias("_full")).withColumn("_short", F.substring("_full", 1, 8))
        if shape["n"] <= broadcast_rules:
            keyed = F.broadcast(keyed)
        urls = rows.withColumn("_s", F.explode(suffixes)).withColumn("_p", F.explode(prefixes)).withColumn("_digest", digest(F.col("_s"), F.col("_p")))
        hit = urls.join(keyed, F.substring(F.col("_digest"), 1, 8) == F.col("_short"), "left")  # the prefix alone; the full digest confirms
        rank = F.when(F.col("_digest") == F.col("_full"), F.struct(
            (F.char_length("_rh") + F.char_length("_rp")).alias("len"), F.char_length("_rh").alias("host_len"),
            (F.col("verdict") == "block").alias("block"), F.concat("_rh", "_rp").alias("rule"), F.col("verdict").alias("verdict"),
        ))
        best = hit.groupBy("_id", "host", "path").agg(F.max(rank).alias("_best"), F.first("_n").alias("_n"))
        out = best.select("_id", "host", "path", "_n", F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return out.select(F.col("_id").alias(id_col), "host", "path", "rule", "verdict")
