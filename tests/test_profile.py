import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stayscope.operators import association, profile
from stayscope.operators.prepare import derive_features
from stayscope.plans.explore import explore


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(
        {
            "x": rng.normal(size=300).round(1),
            "y": rng.integers(0, 5, 300).astype(float),
            "c": rng.choice(["u", "v", "w"], 300),
            "t": rng.choice(["Yes", "No"], 300, p=[0.3, 0.7]),
        }
    )
    pdf.loc[::17, "x"] = None
    pdf.loc[::23, "c"] = None
    df = spark.createDataFrame(
        pdf.astype(object).where(pdf.notna(), None), "x double, y double, c string, t string"
    ).cache()
    return df, pdf


def test_numeric_summary_equals_pandas(table):
    df, pdf = table
    for r in profile.numeric_summary(df, ["x", "y"]).collect():
        s = pdf[r["variable"]].dropna()
        assert (r["count"], r["missing"]) == (len(s), 300 - len(s))
        expected = [s.mean(), s.std(), s.min(), s.max(), s.skew(), s.kurtosis(), s.quantile(0.05),
                    s.median(), s.quantile(0.95)]
        got = [r[c] for c in ("mean", "std", "min", "max", "skew", "kurtosis", "p05", "p50", "p95")]
        np.testing.assert_allclose(got, expected, rtol=1e-9)


def test_short_columns_have_no_shape(spark):
    flat = spark.range(9).select(F.lit(2.5).alias("k"))
    row = profile.numeric_summary(flat, ["k"]).first()
    assert (row["std"], row["skew"], row["kurtosis"]) == (0.0, 0.0, 0.0)
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    rows = {r["variable"]: r for r in profile.numeric_summary(df).collect()}
    assert rows["a"]["std"] is not None and rows["a"]["skew"] is None
    assert rows["b"]["count"] == 0 and rows["b"]["mean"] is None and rows["b"]["p50"] is None


def test_categorical_summary(table):
    df, pdf = table
    row = profile.categorical_summary(df, ["c"]).first()
    counts = pdf["c"].value_counts()
    assert row["n_unique"] == 3 and row["missing"] == pdf["c"].isna().sum()
    assert row["top_freq"] == pytest.approx(counts.iloc[0] / 300)
    assert counts[row["top"]] == counts.iloc[0]


def test_quality(spark, typed):
    row = profile.quality_report(typed.unionByName(typed.limit(2))).first()
    assert (row["n_rows"], row["n_cols"], row["n_duplicates"]) == (8, 21, 2)
    columns = {r["variable"]: r for r in profile.column_quality(typed).collect()}
    assert columns["TotalCharges"]["missing"] == 1 and not columns["TotalCharges"]["is_constant"]
    assert columns["SeniorCitizen"]["is_constant"] and not columns["gender"]["is_constant"]
    assert [tuple(r) for r in profile.missing_counts(typed).collect()] == [("TotalCharges", 1)]
    one = spark.createDataFrame([("No", None)], "Churn string, n int")
    assert math.isinf(profile.quality_report(one).first()["imbalance_ratio"])
    assert all(r["is_constant"] for r in profile.column_quality(one).collect())


def test_row_digest_keeps_boundaries(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "-"), ("-", None)], "x string, y string")
    assert profile.quality_report(df, "x", "a").first()["n_duplicates"] == 0


def test_group_rates_keep_missing(table):
    df, pdf = table
    rows = profile.rate_by_category(df, "c", "t", 100).collect()
    assert sum(r["count"] for r in rows) == 300 and None in {r["category"] for r in rows}
    assert [r["churn_rate"] for r in rows] == sorted((r["churn_rate"] for r in rows), reverse=True)
    assert all(r["is_reliable"] == (r["count"] >= 100) for r in rows)
    (base,) = {r["base_rate"] for r in profile.rate_chart(df, "c", "t").collect()}
    assert base == pytest.approx((pdf["t"] == "Yes").mean())
    assert sum(r["pct"] for r in profile.target_distribution(df, "t").collect()) == pytest.approx(1)


@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_correlation_equals_pandas(table, method):
    df, pdf = table
    expected = pdf[["x", "y"]].corr("pearson")
    if method == "spearman":
        both = pdf[["x", "y"]].dropna().rank()
        expected = both.corr()
    for r in association.correlation(df, ["x", "y"], method).collect():
        if r["i"] == r["j"]:
            assert r["correlation"] == pytest.approx(1.0)
        else:
            assert r["correlation"] == pytest.approx(
                expected.loc[r["variable_a"], r["variable_b"]], abs=1e-12
            )


def test_kendall_equals_pair_count(table):
    df, pdf = table
    both = pdf[["x", "y"]].dropna().to_numpy()
    dx = np.sign(both[:, None, 0] - both[None, :, 0])
    dy = np.sign(both[:, None, 1] - both[None, :, 1])
    expected = (dx * dy).sum() / math.sqrt((dx != 0).sum() * (dy != 0).sum())
    got = {
        (r["i"], r["j"]): r["correlation"]
        for r in association.correlation(df, ["x", "y"], "kendall").collect()
    }
    assert got[(0, 1)] == got[(1, 0)] == pytest.approx(expected, abs=1e-12)
    assert got[(0, 0)] == pytest.approx(1.0)


def test_constant_column_has_no_correlation(spark):
    df = spark.range(5).select(F.col("id").cast("double").alias("a"), F.lit(1.0).alias("b"))
    for method in association.METHODS:
        pairs = association.correlation(df, ["a", "b"], method).collect()
        assert {r["correlation"] for r in pairs if r["i"] != r["j"]} == {None}
    with pytest.raises(ValueError):
        association.correlation(df, ["a"], "cosine")


def test_cramers_v_bounds(spark):
    df = spark.range(200).select(
        F.when(F.col("id") % 2 == 0, "Yes").otherwise("No").alias("t"),
        (F.col("id") % 2).cast("string").alias("same"),
        (F.floor(F.col("id") / 2) % 2).cast("string").alias("unrelated"),
        F.lit("k").alias("flat"),
    )
    got = {
        r["variable"]: r["cramers_v"]
        for r in association.cramers_v(df, ["same", "unrelated", "flat"], "t").collect()
    }
    assert got["same"] == pytest.approx(1.0)
    assert got["unrelated"] == 0.0 and got["flat"] == 0.0


def test_histogram_and_box(table):
    df, pdf = table
    bars = profile.histogram(df, "x", "t", 30).collect()
    assert len(bars) == 60 and sum(r["count"] for r in bars) == pdf["x"].notna().sum()
    width = bars[0]["bin_end"] - bars[0]["bin_start"]
    for cls in ("Yes", "No"):
        assert sum(r["density"] * width for r in bars if r["class"] == cls) == pytest.approx(1)
    for r in profile.box_plot(df, "x", "t").collect():
        s = pdf[pdf["t"] == r["class"]]["x"].dropna()
        assert r["median"] == pytest.approx(s.median()) and r["n"] == len(s)
        assert r["whisker_low"] <= r["q1"] <= r["q3"] <= r["whisker_high"]


def test_exploration_writes_every_table(spark, typed, tmp_path):
    report = explore(derive_features(typed), str(tmp_path))
    assert len(report) == 13
    for name in report:
        assert spark.read.option("header", True).csv(f"{tmp_path}/{name}").columns
