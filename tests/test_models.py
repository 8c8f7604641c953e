import numpy as np
import hashlib
import pytest
from pyspark.sql import functions as F

from stayscope.operators import evaluate, models, ranking
from stayscope.operators.split import stratified_split
from stayscope.plans import training

FEATURES = ["info_0", "info_1", "info_2", "noise_0", "noise_1"]


@pytest.fixture(scope="module")
def matrix(spark):
    """400 rows whose label follows three informative columns."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 5))
    y = (x[:, :3] @ [1.5, -1.2, 0.8] + rng.normal(scale=0.5, size=400) > 0).astype(int)
    rows = [(f"k{i:03d}", int(t), *map(float, v)) for i, (t, v) in enumerate(zip(y, x, strict=True))]
    schema = "customerID string, Churn int, " + ", ".join(f"{f} double" for f in FEATURES)
    return stratified_split(spark.createDataFrame(rows, schema), "customerID", "Churn").cache()


def test_catalogue():
    assert len(models.CATALOGUE) == 8 and len(models.BASELINES) == 4
    with pytest.raises(ValueError, match="unknown models"):
        models.check_names(["dummy_prior", "other"])


def test_balanced_weights(matrix):
    counts = {r["label"]: r for r in models.class_weights(matrix, "Churn").collect()}
    assert sum(r["n"] * r["weight"] for r in counts.values()) == pytest.approx(400)
    assert counts[0]["n"] * counts[0]["weight"] == pytest.approx(200)


def test_constant_models(matrix):
    rate = matrix.agg(F.avg("Churn")).first()[0]
    for name, expected in (("dummy_prior", {rate}), ("dummy_most_frequent", {float(rate > 0.5)})):
        got = models.constant_score(matrix, name, "customerID", "Churn")
        assert {r["p"] for r in got.collect()} == expected
    drawn = models.constant_score(matrix, "dummy_stratified", "customerID", "Churn")
    assert drawn.agg(F.avg("p")).first()[0] == pytest.approx(rate, abs=0.1)


@pytest.mark.parametrize(
    ("name", "options"),
    [("logreg_balanced", {}), ("logreg_l1", {}), ("random_forest", {"trees": 10, "max_depth": 5}),
     ("hist_gb", {"rounds": 5}), ("lightgbm", {"rounds": 5})],
)
def test_learned_models_separate(matrix, name, options):
    model = models.fit(name, matrix, FEATURES, "Churn", **options)
    scored = models.score(model, matrix, ["customerID", "Churn"]).withColumnRenamed("Churn", "y")
    row = evaluate.binary_metrics(scored).first()
    assert row["roc_auc"] > 0.85
    assert scored.filter(~F.col("p").between(0, 1)).count() == 0
    top = models.importance(model, FEATURES).orderBy(F.desc("importance")).first()
    assert top["feature"].startswith("info")


def test_decision_scores_without_probabilities(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame(
        [(Vectors.dense([1.0, -1.0]),), (Vectors.dense([-3.0, 3.0]),)], ["rawPrediction"]
    )
    assert [r[0] for r in df.select(models.positive_probability(df)).collect()] == [0.0, 1.0]
    flat = df.limit(1)
    assert flat.select(models.positive_probability(flat)).first()[0] == 0.5


def test_ranking_scores(matrix, spark):
    mi = {r["feature"]: r["score"] for r in ranking.mutual_information(matrix, FEATURES, "Churn").collect()}
    assert min(mi.values()) >= 0 and min(mi["info_0"], mi["info_1"]) > max(mi["noise_0"], mi["noise_1"])
    positive = matrix.select("Churn", *[(F.abs(f) + (F.col("Churn") * int(f == "info_0"))).alias(f) for f in FEATURES])
    chi = {r["feature"]: r["score"] for r in ranking.chi2_scores(positive, FEATURES, "Churn").collect()}
    assert max(chi, key=chi.get) == "info_0"
    assert {r["score"] for r in ranking.chi2_scores(matrix, ["info_0"], "Churn").collect()} == {None}
    l1 = {r["feature"]: r["score"] for r in ranking.l1_importance(matrix, FEATURES, "Churn").collect()}
    assert l1["info_0"] > l1["info_2"] > max(l1["noise_0"], l1["noise_1"])


def test_permutation_importance(matrix):
    got = {
        r["feature"]: r["score"]
        for r in ranking.permutation_importance(
            matrix, FEATURES, "Churn", "customerID", trees=10, repeats=2, max_depth=5
        ).collect()
    }
    assert set(got) == set(FEATURES)
    assert got["info_0"] > max(got["noise_0"], got["noise_1"])


@pytest.mark.parametrize("digits", [0, 1, 4])
def test_donors_are_the_next_rows_of_one_global_order(spark, monkeypatch, digits):
    """However many ranges there are: a cycle over all rows, so every multiset is kept."""
    monkeypatch.setattr(ranking, "RANGE_DIGITS", digits)
    rows = spark.createDataFrame([(f"k{i}", 0, [float(i)]) for i in range(60)], "key string, y int, own array<double>")
    got = {r["own"][0]: r["donor"][0] for r in ranking.with_donors(rows, 5).collect()}
    order = sorted(range(60), key=lambda i: hashlib.md5(f"5:k{i}".encode()).hexdigest())
    assert got == {float(a): float(b) for a, b in zip(order, [*order[1:], order[0]], strict=True)}


def test_fits_that_stop_early_are_told(matrix, monkeypatch):
    monkeypatch.setattr(models, "MAX_ITERATIONS", 1)
    with pytest.warns(UserWarning, match="did not converge"):
        models.fit("logreg_balanced", matrix, FEATURES, "Churn")


def test_consensus_rules(spark):
    scores = spark.createDataFrame(
        [("a", f"f{i}", float(5 - i)) for i in range(6)]
        + [("b", f"f{i}", v) for i, v in enumerate([3.0, 2.0, 5.0, 4.0, 1.0, None])]
        + [("c", f"f{i}", 1.0) for i in range(6)],
        "method string, feature string, score double",
    )
    ranked, table, top = ranking.consensus(scores, 3, [f"f{i}" for i in range(6)])
    rank = {(r["method"], r["feature"]): r for r in ranked.collect()}
    assert rank[("a", "f0")]["rank"] == 1
    assert rank[("b", "f5")]["rank"] == 6 and rank[("b", "f5")]["norm_score"] is None
    assert rank[("c", "f3")]["rank"] == 1 and rank[("c", "f3")]["norm_score"] == 0.0
    order = [r["feature"] for r in table.collect()]
    assert [r["feature"] for r in top.collect()] == order[:3]
    assert order[0] in {"f0", "f2"}
    assert ranking.wide(ranked, "rank", ["a", "b"]).count() == 6
    with pytest.raises(ValueError):
        ranking.consensus(scores.limit(0))


def test_selection_prefers_information(matrix):
    _, table, top = ranking.select_features(
        matrix, FEATURES, "Churn", "customerID", 3, trees=10, repeats=1, max_depth=5
    )
    assert {r["feature"] for r in top.collect()} == {"info_0", "info_1", "info_2"}
    assert table.count() == 5


def test_training_run(matrix, tmp_path):
    result = training.train_models(
        matrix, FEATURES, names=["dummy_prior", "logreg_l1"], folds=3,
        registry_folder=str(tmp_path / "models"), report_folder=str(tmp_path / "reports"),
    )
    rows = result.summary.collect()
    assert result.best == "logreg_l1" == rows[0]["model"]
    assert rows[0]["val_pr_auc"] > rows[1]["val_pr_auc"]
    assert rows[0]["cv_roc_auc_mean"] > 0.85 and rows[1]["cv_roc_auc_mean"] == pytest.approx(0.5)
    assert result.sweep.count() == 2 * 91
    assert {p.name for p in (tmp_path / "reports").iterdir()} >= {"summary", "cv", "threshold_sweep"}
    with pytest.raises(KeyError):
        training.train_models(matrix, FEATURES, feature_subset=["absent"])
