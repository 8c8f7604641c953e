"""Calibration error and subgroup audit of a score frame (y, p, attributes)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.functions import fixed
from stayscope.functions.columns import ratio as _ratio
from stayscope.functions.columns import require_columns, uniform_bin
from stayscope.operators.evaluate import checked
from stayscope.session import cut_lineage

GROUP_METRICS = ("selection_rate", "tpr", "fpr", "precision")


def _bin_sums(scores: DataFrame, by: Sequence[str], threshold: float, n_bins: int) -> DataFrame:
    """Additive counts per (by, probability bin); everything else follows from them. Missing scores raise."""
    scores = checked(scores)
    hit, pos = (F.col("p") >= threshold).cast("long"), F.col("y").cast("long")
    return scores.groupBy(*by, uniform_bin(F.col("p"), n_bins).alias("bin")).agg(
        F.count("*").alias("n"),
        F.sum(pos).alias("positives"),
        F.sum(hit).alias("selected"),
        F.sum(hit * pos).alias("hits"),
        F.sum(F.col("p").cast("double")).alias("p_sum"),
    )


_SUMS = ("n", "positives", "selected", "hits", "p_sum")


def _bin_gap() -> Column:
    """|sum of labels − sum of probabilities| of a bin: n times the mean gap."""
    return F.abs(F.col("positives") - F.col("p_sum"))


def calibration_error(
    scores: DataFrame, keys: Sequence[str] = (), n_bins: int = 10
) -> DataFrame:
    """Expected calibration error over equal-width bins: (keys, n, ece)."""
    return (
        _bin_sums(scores, keys, 0.5, n_bins)
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("_n"),
            _ratio(F.sum(_bin_gap()), F.sum("n")).alias("ece"),
        )
        .select(*keys, F.col("_n").alias("n"), "ece")
    )


def group_metrics(
    scores: DataFrame,
    attributes: Sequence[str] = tuple(fixed.SENSITIVE),
    threshold: float = fixed.DEFAULT_THRESHOLD,
    n_bins: int = 10,
) -> DataFrame:
    """Metrics per (attribute, group) of several attributes in one pass.

    Rows are summed per attribute combination and bin before the attributes are
    unpivoted, so the rows themselves are never multiplied. Rates with a zero
    denominator are null; a missing attribute value is a group of its own.
    """
    require_columns(scores, list(attributes))
    names = [f"_a{i}" for i in range(len(attributes))]
    narrow = scores.select(
        "y",
        "p",
        *[
            F.coalesce(F.col(f"`{a}`").cast("string"), F.lit("missing")).alias(n)
            for a, n in zip(attributes, names, strict=True)
        ],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(a).alias("attribute"), F.col(n).alias("group"))
            for a, n in zip(attributes, names, strict=True)
        ]
    )
    bins = (
        _bin_sums(narrow, names, threshold, n_bins)
        .select("bin", *_SUMS, F.inline(pairs))
        .groupBy("attribute", "group", "bin")
        .agg(*[F.sum(c).alias(c) for c in _SUMS])
    )
    n, pos, sel, hits = (F.sum(c) for c in ("n", "positives", "selected", "hits"))
    return (
        bins.groupBy("attribute", "group")
        .agg(
            n.alias("_n"),
            _ratio(pos, n).alias("prevalence"),
            _ratio(sel, n).alias("selection_rate"),
            _ratio(hits, pos).alias("tpr"),
            _ratio(sel - hits, n - pos).alias("fpr"),
            _ratio(hits, sel).alias("precision"),
            _ratio(F.sum(_bin_gap()), n).alias("ece"),
        )
        .withColumnRenamed("_n", "n")
        .orderBy("attribute", "group")
    )


def fairness_summary(groups: DataFrame) -> DataFrame:
    """Disparity indicators and verdicts per attribute; groups without a column ``n`` have no sizes."""
    n = F.col("n") if "n" in groups.columns else F.lit(None).cast("long")

    def gap(column: str) -> Column:
        return F.max(column) - F.min(column)

    impact, parity, odds, worst = (
        F.col(c)
        for c in (
            "disparate_impact",
            "demographic_parity_diff",
            "equalized_odds_diff",
            "max_ece",
        )
    )

    def verdict(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    return (
        groups.groupBy("attribute")
        .agg(
            F.count("*").alias("n_groups"),
            F.min(n).alias("n_smallest"),
            F.max(n).alias("n_largest"),
            _ratio(F.min("selection_rate"), F.max("selection_rate")).alias("disparate_impact"),
            gap("selection_rate").alias("demographic_parity_diff"),
            F.greatest(gap("tpr"), gap("fpr")).alias("equalized_odds_diff"),
            F.max("ece").alias("max_ece"),
        )
        .select(
            "*",
            verdict(impact >= fixed.IMPACT_RATIO_MIN).alias("disparate_impact_ok"),
            verdict(parity < fixed.PARITY_GAP_MAX).alias("demographic_parity_ok"),
            verdict(odds < fixed.ODDS_GAP_MAX).alias("equalized_odds_ok"),
            verdict(worst < fixed.CALIBRATION_MAX).alias("max_ece_ok"),
        )
        .withColumn(
            "within_thresholds",
            F.col("disparate_impact_ok")
            & F.col("demographic_parity_ok")
            & F.col("equalized_odds_ok")
            & F.col("max_ece_ok"),
        )
    )


def group_chart(groups: DataFrame) -> DataFrame:
    """Group rates in long form: (attribute, group, metric, value)."""
    return groups.unpivot(["attribute", "group"], list(GROUP_METRICS), "metric", "value")


def attach_sensitive(
    scores: DataFrame,
    accounts: DataFrame,
    key: str = fixed.KEY,
    attributes: Sequence[str] = tuple(fixed.SENSITIVE),
    label: Column | None = None,
) -> DataFrame:
    """Join sensitive columns to scored rows by key; any mismatch raises.

    Every scored row must find one account, and if ``label`` (an expression
    over ``accounts``) is given, the labels must agree. The join is run once and stored;
    the check and the result read it.
    """
    require_columns(accounts, [key, *attributes])
    right = accounts.select(
        F.col(key).alias("_key"),
        *attributes,
        (label if label is not None else F.lit(None)).cast("int").alias("_label"),
        F.lit(True).alias("_found"),
    )
    joined = cut_lineage(scores.drop(*attributes).join(right, scores[key] == F.col("_key"), "left"))
    unmatched = F.col("_found").isNull()
    wrong = F.coalesce(F.col("_label") != F.col("y"), F.lit(False))
    counts = joined.agg(
        F.count_if(unmatched).alias("unmatched"),
        F.count_if(wrong).alias("wrong"),
        F.count("*").alias("rows"),
    ).first()
    if counts["unmatched"] or counts["wrong"]:
        raise ValueError(
            f"{counts['unmatched']} scored rows without account, "
            f"{counts['wrong']} with a different label"
        )
    if counts["rows"] != scores.count():
        raise ValueError(f"accounts repeat {key} values")
    return joined.drop("_key", "_label", "_found")
