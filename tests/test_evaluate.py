import numpy as np
import pytest
from pyspark.sql import functions as F

from stayscope.functions import fixed
from stayscope.operators import evaluate, scoring


def brute(y, p, t):
    """Metrics row by row, straight from their definitions."""
    order = np.argsort(-p, kind="stable")
    y_s, p_s = y[order], p[order]
    ends = np.append(np.flatnonzero(np.diff(p_s)), len(p_s) - 1)
    tp, n = np.cumsum(y_s)[ends], ends + 1
    recall = tp / y.sum()
    ap = np.sum(np.diff(np.append(0, recall)) * tp / n)
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean((pos[:, None] > neg).astype(float) + 0.5 * (pos[:, None] == neg))
    hat = p >= t
    hit = (hat & (y == 1)).sum()
    precision = hit / hat.sum() if hat.sum() else 0.0
    rec = hit / y.sum()
    f1 = 2 * precision * rec / (precision + rec) if precision + rec else 0.0
    return {
        "pr_auc": ap, "roc_auc": auc, "brier": np.mean((p - y) ** 2), "precision": precision,
        "recall": rec, "f1": f1, "accuracy": np.mean(hat == (y == 1)),
        "positive_rate": hat.mean(), "base_rate": y.mean(),
    }


@pytest.mark.parametrize("t", [0.05, 0.4, 0.41, 0.99])
def test_bundle_equals_brute_force(scores, t):
    pdf = scores.toPandas()
    for r in evaluate.binary_metrics(scores, t, ["group"]).collect():
        g = pdf[pdf["group"] == r["group"]]
        for name, value in brute(g["y"].to_numpy(), g["p"].to_numpy(), t).items():
            assert r[name] == pytest.approx(value, abs=1e-12), name


def test_lift_takes_the_mean_over_tie_orders(spark):
    # Ten rows, the top one of which is tied with a second: half of it is positive.
    rows = [(1, 0.9), (0, 0.9)] + [(0, 0.1)] * 7 + [(1, 0.1)]
    df = spark.createDataFrame(rows, "y int, p double")
    assert evaluate.binary_metrics(df).first()["lift_at_10"] == pytest.approx(0.5 / 0.2)
    constant = spark.range(30).select((F.col("id") % 3 == 0).cast("int").alias("y"), F.lit(0.3).alias("p"))
    row = evaluate.binary_metrics(constant).first()
    assert row["lift_at_10"] == pytest.approx(1.0) and row["roc_auc"] == pytest.approx(0.5)


def test_one_class_only(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.7)], "y int, p double")
    row = evaluate.binary_metrics(df).first()
    assert (row["pr_auc"], row["roc_auc"], row["lift_at_10"], row["recall"]) == (0.0, None, 0.0, 0.0)


@pytest.mark.parametrize("grid", [fixed.THRESHOLD_GRID, [0.1, 0.4, 0.75]])
def test_sweep_equals_single_thresholds(scores, grid):
    pdf = scores.toPandas()
    rows = evaluate.threshold_sweep(scores, grid, ["group"]).collect()
    assert len(rows) == 2 * len(grid)
    for r in rows:
        g = pdf[pdf["group"] == r["group"]]
        expected = brute(g["y"].to_numpy(), g["p"].to_numpy(), r["threshold"])
        for name in evaluate.SWEEP_METRICS:
            assert r[name] == pytest.approx(expected[name], abs=1e-12), (name, r["threshold"])


def test_scores_on_every_grid_point(spark):
    """p equal to a threshold reaches it, whatever binary rounding does."""
    df = spark.createDataFrame([(i % 2, i / 100) for i in range(101)], "y int, p double")
    for r in evaluate.threshold_sweep(df).collect():
        assert round(r["positive_rate"] * 101) == 101 - round(r["threshold"] * 100)


def test_best_threshold_is_the_smallest_on_ties(spark):
    sweep = spark.createDataFrame(
        [(0.1, 0.5), (0.2, 0.7), (0.3, 0.7)], "threshold double, f1 double"
    )
    row = evaluate.optimal_threshold(sweep).first()
    assert (row["threshold"], row["score"]) == (0.2, 0.7)
    with pytest.raises(ValueError):
        evaluate.optimal_threshold(sweep, "auc")


def test_confusion_has_all_cells(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8)], "y int, p double")
    cells = {(r["y"], r["predicted"]): r["n"] for r in evaluate.confusion(df).collect()}
    assert cells == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 2}


@pytest.mark.parametrize("keys", [[], ["group"]])
def test_calibration(scores, keys):
    pdf = scores.toPandas()
    rows = evaluate.calibration(scores, 10, keys).collect()
    parts = {None: pdf} if not keys else dict(list(pdf.groupby("group")))
    for key, part in parts.items():
        p = part["p"].to_numpy()
        bins = np.searchsorted(np.quantile(p, np.linspace(0, 1, 11))[1:-1], p)
        mine = {r["bin"]: r for r in rows if not keys or r["group"] == key}
        assert sorted(mine) == sorted(set(bins))
        for b, r in mine.items():
            assert r["n"] == (bins == b).sum()
            assert r["observed_rate"] == pytest.approx(part["y"].to_numpy()[bins == b].mean())


def test_curve_points(scores):
    pr = evaluate.pr_points(scores).collect()
    end = [r for r in pr if r["threshold"] is None]
    assert [(r["recall"], r["precision"]) for r in end] == [(0.0, 1.0)]
    assert max(r["recall"] for r in pr) == 1.0
    roc = evaluate.roc_points(scores, ["group"]).collect()
    assert sum(r["threshold"] is None for r in roc) == 2
    assert max(r["fpr"] for r in roc) == max(r["tpr"] for r in roc) == 1.0


def test_top_importance(spark):
    df = spark.createDataFrame([("a", 0.1), ("b", None), ("c", 0.4)], "feature string, importance double")
    assert [r["feature"] for r in evaluate.top_importance(df, 2).collect()] == ["c", "a"]


def test_predictions_and_summary(spark):
    df = spark.createDataFrame([("a", 0.5800004), ("b", 0.5799996), ("c", 0.1)], "customerID string, p double")
    rows = {r["customerID"]: r for r in scoring.predictions(df, 0.58).collect()}
    assert rows["a"]["prediction"] == 1 and rows["a"]["label"] == "churn"
    # Rounds up to the threshold, but is decided on the unrounded value.
    assert rows["b"]["probability"] == 0.58 and rows["b"]["prediction"] == 0
    assert [rows[k]["risk_band"] for k in "abc"] == ["high", "medium", "low"]
    row = scoring.batch_summary(scoring.predictions(df, 0.58)).first()
    assert (row["n_customers"], row["n_predicted_churn"]) == (3, 1)
    assert scoring.batch_summary(scoring.predictions(df.limit(0), 0.5)).first()["n_customers"] == 0


def test_threshold_resolution():
    assert scoring.resolve_threshold(0.58, 0.3, 0.4) == 0.3
    assert scoring.resolve_threshold(0.58, None, 0.4) == 0.4
    assert scoring.resolve_threshold(0.58) == 0.58
    assert scoring.resolve_threshold() == 0.5
    with pytest.raises(ValueError):
        scoring.resolve_threshold(0.58, 1.5)
