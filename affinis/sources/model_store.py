"""Saving and reloading similarity models and recommendations.

A model is a table ``(item_i, item_j, sim, rank)``. Its folder is named by a
fingerprint of the input rows and the parameters, so a changed input or
parameter never meets an old model.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.operators.topk import ranked_map
from affinis.session import exists, publish, shared_dir

MODEL_SCHEMA = "item_i BIGINT, item_j BIGINT, sim DOUBLE, rank INT"


def fingerprint(rows: DataFrame, params: dict[str, Any]) -> str:
    """Digest of a table's content, in any row order, and of the parameters."""
    digest = F.xxhash64(*rows.columns).cast("decimal(38,0)")
    content = rows.agg(F.count(F.lit(1)), F.sum(digest), F.sum(F.abs(digest))).first()
    text = json.dumps([rows.columns, [str(v) for v in content], params], sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:32]


def save_table(df: DataFrame, path: str, by: str) -> None:
    """Write as parquet, ordered by ``by`` inside files so that lookups skip row groups."""
    df.sortWithinPartitions(by).write.mode("overwrite").parquet(path)


def save_map_json(model: DataFrame, path: str) -> None:
    """One JSON line per item, ``{"item_i": 7, "sims": {"9": 0.5, ...}}``, neighbours in rank order."""
    rows = ranked_map(model.withColumn("item_j", F.col("item_j").cast("string")), "item_i", "item_j", "sim", "sims")
    rows.write.mode("overwrite").json(path)


def load_map_json(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.schema("item_i BIGINT, sims MAP<STRING, DOUBLE>").json(path)
    pairs = lines.select("item_i", F.posexplode(F.map_entries("sims")).alias("_at", "_e"))
    return pairs.select(
        "item_i",
        F.col("_e.key").try_cast("bigint").alias("item_j"),
        F.col("_e.value").alias("sim"),
        (F.col("_at") + 1).alias("rank"),
    )


def save_single_key_json(model: DataFrame, path: str) -> None:
    """One text line per item, an object with the item as its only key: ``{"7": {"9": 0.5}}``."""
    key = F.col("item_i").cast("string")
    rows = ranked_map(model.withColumn("item_j", F.col("item_j").cast("string")), "item_i", "item_j", "sim", "sims")
    rows.select(F.to_json(F.create_map(key, F.col("sims"))).alias("value")).write.mode("overwrite").text(path)


def load_single_key_json(spark: SparkSession, path: str) -> DataFrame:
    parsed = spark.read.text(path).select(F.from_json("value", "MAP<STRING, MAP<STRING, DOUBLE>>").alias("_m"))
    items = parsed.select(F.explode("_m").alias("_i", "_sims"))
    pairs = items.select("_i", F.posexplode(F.map_entries("_sims")).alias("_at", "_e"))
    return pairs.select(
        F.col("_i").try_cast("bigint").alias("item_i"),
        F.col("_e.key").try_cast("bigint").alias("item_j"),
        F.col("_e.value").alias("sim"),
        (F.col("_at") + 1).alias("rank"),
    )


def compute_or_load(
    rows: DataFrame,
    model: str,
    version: int,
    params: dict[str, Any],
    build: Callable[[DataFrame], DataFrame],
    root: str | None = None,
) -> DataFrame:
    """The stored model for exactly these rows, name, version and parameters, built and stored if there is none.

    Raise ``version`` with every change of ``build``. A model is built in a folder
    of its own and published by one rename, which fails if the model is there by
    then. So a half-written model (a driver lost midway) is never taken for a
    finished one, and of two builders at once the later one reads what the first has published.
    """
    spark = rows.sparkSession
    key = fingerprint(rows, {"model": model, "version": version, "params": params})
    path = f"{root or shared_dir(spark)}/models/{key}"
    if not exists(spark, path):
        built = f"{root or shared_dir(spark)}/models-in-work/{key}-{uuid.uuid4().hex}"
        save_table(build(rows), built, "item_i")
        publish(spark, built, path)
    return spark.read.schema(MODEL_SCHEMA).parquet(path)
