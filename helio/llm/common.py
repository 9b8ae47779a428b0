"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from functools import reduce
from operator import or_
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helio.sources.shared import cut, shared_folder  # noqa: F401  the corpus operators take them from here

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that on all-ASCII text and is faster than ``translate``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def keep_rows(docs: DataFrame, kept: DataFrame, digest: Column, id_col: str = "doc_id") -> DataFrame:
    """Of the rows of ``docs`` with one id and one ``digest`` of their text as many as ``kept`` (``id_col``, text_sha256) has, all columns.

    ``kept`` has a row for each row to keep. Rows of one id and digest differ in other columns or in case at
    most; the first by all columns stay. A null id is an id like others here.
    """

    def tag(sha: Column) -> Column:
        return F.concat_ws(" ", F.coalesce(F.col(id_col).cast("string"), F.lit("")), sha)

    wanted = kept.groupBy(tag(F.col("text_sha256")).alias("_tag")).agg(F.count(F.lit(1)).alias("_n"))
    rows = docs.withColumn("_tag", tag(digest)).join(wanted, "_tag")
    rank = F.row_number().over(Window.partitionBy("_tag").orderBy(*docs.columns))
    return rows.withColumn("_rn", rank).where("_rn <= _n").select(*docs.columns)


def carried(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...]) -> tuple[DataFrame, dict[str, str], str]:
    """Rows for Python (id, _text, ``carry``), the column that holds each of ``carry``, and their part of a schema; the text goes over once."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"), *[F.col(c) for c in carry if c != text_col])
    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return rows, {c: "_text" if c == text_col else c for c in carry}, kinds


def fit_on_sample(rows: DataFrame, most: int, fit: Callable[[list, list], Any], labels: tuple | None = None) -> Any:
    """``fit(texts, labels)`` on a bounded sample, in one task, so that neither sample nor training weighs on the driver.

    ``rows``: h (64-bit hash of id and text), t (text), y (label). Rows of one hash and label count once, so that rows
    that are often repeated, with an id or without, do not swell the sample. It holds the ``most`` rows of least
    hash, of each of ``labels`` if given; all if there are fewer. A first pass estimates how many there are, the
    second brings only the share of the hash range that is needed, so the sample does not grow with the table.
    """
    places = 1 << 40
    groups = [F.lit(True)] if labels is None else [F.col("y") == v for v in labels]
    counts = rows.agg(*[F.approx_count_distinct(F.when(g, F.col("h")), 0.02).alias(f"n{i}") for i, g in enumerate(groups)]).first()
    near = F.pmod(F.col("h"), F.lit(places))
    kept = reduce(or_, [g & (near < int(min(1.0, 1.2 * most / max(n, 1)) * places)) for g, n in zip(groups, counts, strict=True)])

    def run(batches):
        found = [(h % places, t, y) for b in batches for h, t, y in zip(*(b.column(c).to_pylist() for c in ("h", "t", "y")), strict=True)]
        found.sort()
        sets = [found] if labels is None else [[x for x in found if x[2] == v] for v in labels]
        used = [x for one in sets for x in one[:most]]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit([t for _, t, _ in used], [y for _, _, y in used]))], pa.binary())], ["model"])

    row = rows.select("h", "t", "y").where(kept).dropDuplicates(["h", "y"]).coalesce(1).mapInArrow(run, "model binary").first()
    return pickle.loads(row["model"]) if row else fit([], [])
