"""Decisions on scored rows and the batch summary."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.functions import columns as C
from stayscope.functions import fixed
from stayscope.operators import models
from stayscope.operators.contract import (
    check_threshold,
    require_rows,
    scoring_contract,
    separate,
)
from stayscope.operators.prepare import derive_features, scoring_rows


def resolve_threshold(
    manifest_value: float | None = None,
    override: float | None = None,
    setting: float | None = None,
) -> float:
    """Argument, then setting, then the tuned value of the manifest, then 0.5."""
    for value in (override, setting):
        if value is not None:
            return check_threshold(value)
    return float(manifest_value) if manifest_value is not None else fixed.DEFAULT_THRESHOLD


def predictions(scored: DataFrame, threshold: float, key: str = fixed.KEY) -> DataFrame:
    """Key, rounded probability, decision, label and band.

    Decision and band use the unrounded probability.
    """
    p = F.col("p")
    return scored.select(
        key,
        F.round(p, 6).alias("probability"),
        C.decision(p, threshold).alias("prediction"),
        C.decision_label(p, threshold).alias("label"),
        C.risk_band(p, threshold).alias("risk_band"),
    )


def batch_summary(predicted: DataFrame) -> DataFrame:
    """Rows, predicted positives, their rate, and the mean rounded probability."""
    return predicted.agg(
        F.count("*").alias("n_customers"),
        F.coalesce(F.sum("prediction"), F.lit(0)).alias("n_predicted_churn"),
        F.round(F.avg("prediction"), 6).alias("churn_rate_predicted"),
        F.round(F.avg("probability"), 6).alias("mean_probability"),
    )


def score_accounts(rows: DataFrame, pipeline: PipelineModel) -> DataFrame:
    """Contract rows → (key, p): derived features, encoding and model, all narrow.

    ``pipeline`` is the scoring pipeline of :mod:`stayscope.plans.training`; it
    works on batch and streaming frames alike. Columns outside the scoring
    contract, such as a known target, are not read.
    """
    known = [c for c in rows.columns if c in fixed.RAW_COLUMNS and c != fixed.TARGET]
    derived = derive_features(scoring_rows(rows.select(*known)))
    out = pipeline.transform(derived)
    return out.select(fixed.KEY, models.positive_probability(out).alias("p"))


def score_batch(rows: DataFrame, pipeline: PipelineModel, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(predictions of the valid rows, quarantined rows) of a batch that must not be empty."""
    valid, bad = separate(scoring_rows(require_rows(rows)), scoring_contract())
    return predictions(score_accounts(valid, pipeline), threshold), bad


def with_facts(predicted: DataFrame, facts: DataFrame) -> DataFrame:
    """Add the columns of the one-row ``facts`` table to every prediction."""
    row = facts.select(F.struct("*").alias("f")).scalar()
    return predicted.select("*", *[row.getField(c).alias(c) for c in facts.columns])
