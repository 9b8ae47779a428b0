"""The life of a trained model: stored pipeline, version row, importances of its own, forecasts that join its row."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helio.operators import dims, features
from helio.sources.nested import read_table
from helio.sources.stored import write_partitioned

_NAMES = [x.split()[0] for x in dims.MODEL_VERSION.split(", ")]


def register_model(spark: SparkSession, base: str, model, record: dict, importances: DataFrame, now: Column) -> int:
    """Store a fitted pipeline, its row of the version dimension and its ranked importances under ``base``; its key.

    ``record`` has columns of ``dims.MODEL_VERSION``; hyperparameters and performance_metrics may be dicts. A version that is stored
    again keeps its key and its time of creation. An active one makes the other versions of its name inactive. The dimension has a
    row for each model, so it is written as a whole, under a new name first.
    """
    table = read_table(spark, f"{base}/dim_model_version", ["model_version_key"])
    known = [r.asDict() for r in table.collect()] if table is not None else []
    own = next((r for r in known if r["model_version_id"] == record["model_version_id"]), None)
    key = own["model_version_key"] if own else max((r["model_version_key"] for r in known), default=0) + 1
    fields = {c: json.dumps(v, sort_keys=True) if isinstance(v, dict) else v for c, v in record.items()} | {"model_version_key": key}
    model.write().overwrite().save(f"{base}/models/{key}")
    features.store_importances(importances.withColumn("model_version_key", F.lit(key)), f"{base}/dim_feature_importance", now)
    others = [r | {"is_active": r["is_active"] and not (record.get("is_active") and r["model_name"] == record.get("model_name"))} for r in known if r is not own]
    kinds = f"{dims.MODEL_VERSION}, created_at timestamp, updated_at timestamp"
    kept = spark.createDataFrame([tuple(r[c] for c in (*_NAMES, "created_at", "updated_at")) for r in others], kinds)
    mine = dims.dim_model_version(spark, [fields]).withColumns({"created_at": F.coalesce(F.lit(own["created_at"] if own else None).cast("timestamp"), now), "updated_at": now})
    write_partitioned(kept.unionByName(mine).coalesce(1), f"{base}/dim_model_version", [], "overwrite")
    return key


def active_model(spark: SparkSession, base: str, name: str) -> tuple[PipelineModel, dict]:
    """The pipeline and the row of the active version of a model, loaded from ``base``; ValueError where there is none."""
    table = read_table(spark, f"{base}/dim_model_version", ["model_version_key"])
    row = None if table is None else table.where((F.col("model_name") == name) & F.col("is_active")).orderBy(F.desc("model_version_key")).first()
    if row is None:
        raise ValueError(f"no active version of {name}")
    return PipelineModel.load(f"{base}/models/{row['model_version_key']}"), row.asDict()


def leaf_means(model, rows: DataFrame, label: str) -> DataFrame:
    """A row for each leaf of a fitted single tree that ``rows`` reach: _leaf, n, prediction, mean_label."""
    tree = model.stages[-1].copy()
    tree.setLeafCol("_leaf")
    out = tree.transform(model.stages[0].transform(rows))
    return out.groupBy("_leaf").agg(F.count(F.lit(1)).alias("n"), F.first("prediction").alias("prediction"), F.avg(label).alias("mean_label"))


def stump(rows: DataFrame, columns: list[str], label: str, most_values: int = 1000) -> tuple[str, float, float, float] | None:
    """The best single split: feature, threshold (between two values), mean label at or under it and over it; None where no split helps.

    A tree of depth 1 with as many bins as a feature has values, so that every split between two values is tried. Features with more than
    ``most_values`` values raise, as their bins would be samples.
    """
    n = rows.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    if max(n) > most_values:
        raise ValueError(f"a feature has {max(n)} values, more than {most_values}")
    model = features.train_trees(rows, columns, label, "decision_tree", maxDepth=1, maxBins=max(2, max(n) + 1), minInstancesPerNode=1, minInfoGain=0.0)
    root = model.stages[-1]._java_obj.rootNode()
    if root.subtreeDepth() == 0:
        return None
    return columns[root.split().featureIndex()], float(root.split().threshold()), float(root.leftChild().prediction()), float(root.rightChild().prediction())
