"""Model registry: a folder per model with the pipeline and one manifest row."""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope.operators.models import algorithm

#: One path segment that is not hidden.
MODEL_NAME = re.compile(r"[^./][^/]*")

MANIFEST = (
    "name string, algorithm string, created_at string, hash_model string, "
    "feature_set array<string>, metrics map<string, map<string, double>>, "
    "hyperparameters map<string, string>, random_state long"
)


def save_model(
    model: PipelineModel, name: str, folder: str, metadata: Mapping | None = None
) -> dict:
    """Write pipeline and manifest; returns the manifest."""
    if not MODEL_NAME.fullmatch(name or ""):
        raise ValueError(f"invalid model name {name!r}")
    spark = SparkSession.active()
    path = f"{folder}/{name}/pipeline"
    model.write().overwrite().save(path)
    manifest = {
        "algorithm": algorithm(model),
        **dict(metadata or {}),
        "name": name,
        "created_at": dt.datetime.now(dt.UTC).isoformat(timespec="seconds"),
        "hash_model": _folder_digest(spark, path),
    }
    text = json.dumps(manifest, ensure_ascii=False, default=str)
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(
        f"{folder}/{name}/manifest"
    )
    return manifest


def _folder_digest(spark: SparkSession, path: str) -> str:
    """sha256 over the sorted digests of the files of a saved pipeline."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(
        F.sha2(F.concat_ws("", F.array_sort(F.collect_list(F.sha2("content", 256)))), 256)
    ).first()[0]


def load_model(spark: SparkSession, name: str, folder: str) -> tuple[PipelineModel, dict]:
    """Pipeline and manifest; either one missing raises."""
    try:
        manifest = spark.read.text(f"{folder}/{name}/manifest").first()
        spark.read.text(f"{folder}/{name}/pipeline/metadata")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no model {name!r} under {folder}") from error
    model = PipelineModel.load(f"{folder}/{name}/pipeline")
    if manifest is None:
        raise FileNotFoundError(f"no manifest of {name!r} under {folder}")
    return model, json.loads(manifest["value"])


def manifests(lines: DataFrame) -> DataFrame:
    """Typed manifest rows from a text column ``value``; broken ones are skipped."""
    parsed = lines.select(
        F.from_json("value", MANIFEST, {"mode": "PERMISSIVE"}).alias("m")
    )
    return parsed.select("m.*").filter(F.col("name").isNotNull())


def list_models(spark: SparkSession, folder: str) -> DataFrame:
    """All readable manifests under ``folder``, by name; none if it does not exist."""
    try:
        lines = spark.read.text(f"{folder}/*/manifest")
    except AnalysisException:
        lines = spark.createDataFrame([], "value string")
    return manifests(lines).orderBy("name")


def best_model(
    entries: DataFrame, metric: str, higher_is_better: bool = True, split: str = "val"
) -> DataFrame:
    """The entry with the best metric on a split; ties go to the first name; may be empty."""
    value = F.try_element_at(F.try_element_at("metrics", F.lit(split)), F.lit(metric))
    direction = F.desc("_value") if higher_is_better else F.asc("_value")
    return (
        entries.withColumn("_value", value)
        .filter(F.col("_value").isNotNull() & ~F.isnan("_value"))
        .orderBy(direction, "name")
        .limit(1)
        .withColumnRenamed("_value", "value")
    )


def facts(entry: DataFrame, threshold: float) -> DataFrame:
    """Facts of one entry to show beside its scores; at most one row."""
    return entry.select(
        F.col("name").alias("model"),
        "algorithm",
        F.lit(float(threshold)).alias("threshold"),
        F.size("feature_set").alias("n_features"),
        "metrics",
    ).limit(1)
