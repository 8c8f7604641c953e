"""Reading landed tables; writing tables, reports and manifests."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope.functions import fixed
from stayscope.functions.columns import label_column, require_columns
from stayscope.operators.contract import raw_schema


def read_raw_csv(
    spark: SparkSession, path: str, columns: Sequence[str] = fixed.RAW_COLUMNS
) -> DataFrame:
    """Every column as text under a declared schema; a missing path raises."""
    try:
        return (
            spark.read.schema(raw_schema(columns))
            .options(header=True, enforceSchema=False, mode="FAILFAST")
            .csv(path)
        )
    except AnalysisException as error:
        raise FileNotFoundError(f"no raw table at {path}") from error


def read_matrix(spark: SparkSession, path: str, target: str = fixed.TARGET) -> DataFrame:
    """Encoded matrix; a missing target column raises."""
    try:
        matrix = spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no matrix at {path}") from error
    require_columns(matrix, [target])
    return matrix


def read_split(spark: SparkSession, path: str, split: str, target: str = fixed.TARGET) -> DataFrame:
    """One split; the filter prunes the partition directories of the others."""
    if split not in ("train", "val", "test"):
        raise ValueError(f"unknown split {split!r}")
    return read_matrix(spark, path, target).filter(F.col("split") == split).drop("split")


def write_table(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def write_splits(df: DataFrame, path: str, split: str = "split") -> str:
    """One directory per split. A narrow write: rows stay in their tasks."""
    df.write.mode("overwrite").option("compression", "snappy").partitionBy(split).parquet(path)
    return path


def write_report(df: DataFrame, path: str) -> str:
    """Small result table as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_points(df: DataFrame, path: str) -> str:
    """Chart points, one row per distinct score, as CSV files with a header: a part per task."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json_record(spark: SparkSession, record: Mapping, path: str) -> str:
    """One JSON document (metrics, manifest) as a one-line text table."""
    text = json.dumps(record, ensure_ascii=False, default=str)
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return path


def read_json_record(spark: SparkSession, path: str) -> dict:
    try:
        return json.loads(spark.read.text(path).first()["value"])
    except AnalysisException as error:
        raise FileNotFoundError(f"no record at {path}") from error


def split_manifest(
    df: DataFrame, target: str, features: Sequence[str], seed: int, split: str = "split",
    include_derived: bool = True, inputs: Sequence[str] = (),
) -> dict:
    """Time, sizes and rates of the splits, seed, input and feature names, and whether derived
    columns are among them: one small aggregate."""
    rows = (
        df.groupBy(split)
        .agg(F.count("*").alias("n"), F.sum(label_column(df, target)).alias("pos"))
        .collect()
    )
    total = sum(r["n"] for r in rows)
    return {
        "created_at": dt.datetime.now(dt.UTC).isoformat(timespec="seconds"),
        "random_seed": seed,
        "include_derived": include_derived,
        "input_columns": list(inputs),
        "n_features_out": len(features),
        "target_col": target,
        "target_positive_rate_global": sum(r["pos"] for r in rows) / total if total else None,
        "splits": {
            r[split]: {"n_rows": r["n"], "positive_rate": r["pos"] / r["n"]} for r in rows
        },
        "feature_names": list(features),
    }


def write_selection(
    ranked: DataFrame,
    table: DataFrame,
    top: DataFrame,
    folder: str,
    k: int,
    meta: Mapping | None = None,
) -> dict[str, str]:
    """Score, rank and consensus tables as CSV, and a manifest with the top features."""
    paths = {
        "scores": write_report(ranked.select("method", "feature", "score"), f"{folder}/scores"),
        "ranks": write_report(ranked.select("method", "feature", "rank"), f"{folder}/ranks"),
        "consensus": write_report(table, f"{folder}/consensus"),
    }
    record = {
        "k": k,
        "top_k_features": [r["feature"] for r in top.select("feature").collect()],
        "meta": dict(meta or {}),
    }
    paths["manifest"] = write_json_record(ranked.sparkSession, record, f"{folder}/manifest")
    return paths


def write_audit(
    groups: DataFrame, summary: DataFrame, folder: str, model: str, threshold: float, split: str = "test"
) -> dict[str, str]:
    """Group table as CSV; summary with the limits it was judged by, the split, its rows and the
    group sizes as JSON."""
    rows = [r.asDict() for r in summary.collect()]  # one per audited attribute
    sizes: dict[str, dict[str, int]] = {}
    for r in groups.select("attribute", "group", "n").collect():  # one per group
        sizes.setdefault(r["attribute"], {})[r["group"]] = r["n"]
    record = {
        "model": model,
        "threshold": threshold,
        "split": split,
        "n_rows": sum(next(iter(sizes.values())).values()) if sizes else 0,
        "group_sizes": sizes,
        "limits": {
            "disparate_impact_min": fixed.IMPACT_RATIO_MIN,
            "demographic_parity_max": fixed.PARITY_GAP_MAX,
            "equalized_odds_max": fixed.ODDS_GAP_MAX,
            "ece_max": fixed.CALIBRATION_MAX,
        },
        "attributes": {r["attribute"]: r for r in rows},
        "all_within_thresholds": all(r["within_thresholds"] for r in rows),
    }
    return {
        "groups": write_report(groups, f"{folder}/groups"),
        "summary": write_json_record(groups.sparkSession, record, f"{folder}/summary"),
    }
