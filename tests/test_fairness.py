import pytest
from pyspark.sql import functions as F

from stayscope.operators import fairness


def frame(spark, y, p, g):
    return spark.createDataFrame(list(zip(y, p, g, strict=True)), "y int, p double, g string")


@pytest.mark.parametrize(
    ("counts", "expected"),
    [
        # (score, positives, negatives): the gap of a bin is |rate - score|, weighted by its rows
        ([(0.25, 1, 3)], 0.0),
        ([(0.15, 4, 1)], 0.65),
        ([(0.05, 0, 6), (0.65, 3, 1)], (6 * 0.05 + 4 * 0.10) / 10),
        ([(0.35, 1, 1), (0.75, 1, 2), (0.95, 5, 0)], (2 * 0.15 + 3 * (0.75 - 1 / 3) + 5 * 0.05) / 10),
    ],
)
def test_calibration_error(spark, counts, expected):
    rows = [(y, p) for p, pos, neg in counts for y in [1] * pos + [0] * neg]
    df = frame(spark, [y for y, _ in rows], [p for _, p in rows], ["only"] * len(rows))
    assert fairness.calibration_error(df).first()["ece"] == pytest.approx(expected)


def test_bin_edge_goes_up(spark):
    """3 · 0.1 is above 0.3, so a score of 0.3 stays in the third bin."""
    df = frame(spark, [1, 0], [0.3, 0.29], ["A", "A"])
    assert fairness.calibration_error(df).first()["ece"] == pytest.approx(abs(1 - 0.59) / 2)


def uneven(spark):
    """Three groups of 5, 3 and 2 rows; with 0.6 as the threshold the hits are 3, 1 and 0."""
    rows = [
        (1, 0.71, "north"), (1, 0.62, "north"), (0, 0.6, "north"), (0, 0.33, "north"), (1, 0.12, "north"),
        (0, 0.88, "south"), (1, 0.41, "south"), (0, 0.05, "south"),
        (0, 0.22, "west"), (0, 0.59, "west"),
    ]
    return spark.createDataFrame(rows, "y int, p double, g string")


def test_rates_of_uneven_groups(spark):
    rows = {r["group"]: r for r in fairness.group_metrics(uneven(spark), ["g"], 0.6).collect()}
    names = ("n", "prevalence", "selection_rate", "tpr", "fpr", "precision")
    expected = {
        "north": (5, 3 / 5, 3 / 5, 2 / 3, 1 / 2, 2 / 3),
        "south": (3, 1 / 3, 1 / 3, 0.0, 1 / 2, 0.0),
        "west": (2, 0.0, 0.0, None, 0.0, None),
    }
    for group, values in expected.items():
        for name, value in zip(names, values, strict=True):
            assert rows[group][name] == (None if value is None else pytest.approx(value)), (group, name)


def test_summary_of_uneven_groups(spark):
    row = fairness.fairness_summary(fairness.group_metrics(uneven(spark), ["g"], 0.6)).first()
    assert row["disparate_impact"] == 0.0 and not row["disparate_impact_ok"]
    assert row["demographic_parity_diff"] == pytest.approx(3 / 5)
    assert row["equalized_odds_diff"] == pytest.approx(2 / 3)  # the tpr gap is wider than that of fpr
    assert not row["within_thresholds"]


def test_summary_of_like_groups(spark):
    """Groups of 4, 8 and 12 rows, all at 0.75 and three in four positive."""
    rows = [(y, 0.75, g) for g, times in (("x", 1), ("y", 2), ("z", 3)) for y in [1, 1, 1, 0] * times]
    df = frame(spark, *map(list, zip(*rows, strict=True)))
    row = fairness.fairness_summary(fairness.group_metrics(df, ["g"], 0.75)).first()
    assert row["disparate_impact"] == 1.0 and row["disparate_impact_ok"]
    assert row["demographic_parity_diff"] == row["equalized_odds_diff"] == 0.0
    assert row["max_ece"] == pytest.approx(0.0) and row["within_thresholds"]


def test_odds_skip_rates_that_are_missing(spark):
    groups = spark.createDataFrame(
        [("g", "x", 0.4, 0.81, None, 0.02), ("g", "y", 0.4, None, 0.11, 0.02), ("g", "z", 0.4, 0.84, 0.18, 0.02)],
        "attribute string, `group` string, selection_rate double, tpr double, fpr double, ece double",
    )
    row = fairness.fairness_summary(groups).first()
    assert row["equalized_odds_diff"] == pytest.approx(0.07) and row["equalized_odds_ok"]


def test_nobody_selected_fails(spark):
    df = frame(spark, [1, 0] * 2, [0.1] * 4, "AABB")
    row = fairness.fairness_summary(fairness.group_metrics(df, ["g"], 0.5)).first()
    assert row["disparate_impact"] is None and not row["disparate_impact_ok"]


def test_several_attributes_and_missing_values(spark, scores):
    df = scores.withColumn("other", F.when(F.col("id") % 5 > 0, F.col("id") % 5))
    rows = fairness.group_metrics(df, ["group", "other"], 0.4).collect()
    assert {r["attribute"] for r in rows} == {"group", "other"}
    assert "missing" in {r["group"] for r in rows}
    for a in ("group", "other"):
        assert sum(r["n"] for r in rows if r["attribute"] == a) == 400
    assert fairness.group_chart(fairness.group_metrics(df, ["group"], 0.4)).count() == 8
    with pytest.raises(KeyError):
        fairness.group_metrics(df, ["absent"], 0.4)


def test_sensitive_columns_by_key(spark):
    scores = spark.createDataFrame([("a", 1, 0.5), ("b", 0, 0.2)], "k string, y int, p double")
    people = spark.createDataFrame([("b", "F", 0), ("a", "M", 1)], "k string, s string, t int")
    out = fairness.attach_sensitive(scores, people, "k", ["s"], F.col("t"))
    assert {(r["k"], r["s"]) for r in out.collect()} == {("a", "M"), ("b", "F")}
    with pytest.raises(ValueError, match="without account"):
        fairness.attach_sensitive(scores, people.limit(1), "k", ["s"])
    with pytest.raises(ValueError, match="different label"):
        fairness.attach_sensitive(scores, people, "k", ["s"], 1 - F.col("t"))
    with pytest.raises(ValueError, match="repeat"):
        fairness.attach_sensitive(scores, people.unionByName(people), "k", ["s"])
