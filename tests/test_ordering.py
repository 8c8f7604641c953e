"""Ordering by ranges must equal numpy and one window over all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayscope.operators import ordering


@pytest.fixture(scope="module")
def values(spark):
    """3000 rows in two groups; a third of all rows hold one value, some are missing."""
    key = F.col("id")
    v = (
        F.when(key % 3 == 0, F.lit(5.0))
        .when(key % 50 == 1, F.lit(None))
        .when(key % 50 == 2, F.lit(float("nan")))
        .otherwise(F.pmod(F.xxhash64(key), F.lit(100_000)) / 777.0)
    )
    return spark.range(3000).select(
        v.alias("v"), (key * 2.5).alias("w"), F.when(key % 7 == 0, "a").otherwise("b").alias("g")
    ).cache()


@pytest.mark.parametrize("ranges", [None, 2, 16])
def test_percentiles_equal_numpy(values, ranges):
    probabilities = [0.0, 0.05, 0.31, 0.5, 0.95, 1.0]
    got = {
        (r["g"], r["variable"]): r
        for r in ordering.exact_percentiles(
            values, ["v", "w"], probabilities, ["g"], ranges=ranges
        ).collect()
    }
    pdf = values.toPandas()
    for g in ("a", "b"):
        for c in ("v", "w"):
            data = pdf[pdf["g"] == g][c].dropna().to_numpy()
            assert got[(g, c)]["n"] == len(data)
            np.testing.assert_allclose(
                got[(g, c)]["q"], np.quantile(data, probabilities), rtol=1e-12
            )


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("keys", [[], ["g"]])
def test_running_sums_agree(values, keys, descending):
    table = (
        values.filter(F.col("v").isNotNull() & ~F.isnan("v"))
        .groupBy(*keys, "v")
        .agg(F.count("*").alias("n"))
    )

    got = sorted(map(tuple, ordering.running_sums(table, "v", ["n"], keys, descending, ranges=12).collect()))
    rows = sorted(table.collect(), key=lambda r: r["v"], reverse=descending)
    total, seen, expected = {}, {}, []
    for r in rows:
        total[tuple(r[k] for k in keys)] = total.get(tuple(r[k] for k in keys), 0) + r["n"]
    for r in rows:
        key = tuple(r[k] for k in keys)
        seen[key] = seen.get(key, 0) + r["n"]
        expected.append((*r, seen[key], total[key]))
    assert got == sorted(expected)


def test_any_bounds_give_the_same_result(values, monkeypatch):
    table = values.groupBy("w").agg(F.count("*").alias("n"))
    expected = sorted(map(tuple, ordering.running_sums(table, "w", ["n"]).collect()))
    monkeypatch.setattr(
        ordering, "range_bounds", lambda *a, **k: [[-np.inf, 1.0, 7.0, 4000.0, np.inf]]
    )
    got = sorted(map(tuple, ordering.running_sums(table, "w", ["n"]).collect()))
    assert got == expected


def test_percentiles_with_infinite_and_missing_values(spark):
    rows = [("a", 1.0, None), ("a", 3.5, None), ("a", float("inf"), float("nan")), ("b", float("-inf"), None), ("b", 2.0, 4.0)]
    df = spark.createDataFrame(rows, "g string, v double, w double")
    got = {(r["g"], r["variable"]): r for r in ordering.exact_percentiles(df, ["v", "w"], [0.25, 0.75, 1.0], ["g"]).collect()}
    assert got["a", "v"]["n"] == 3 and got["a", "v"]["q"] == [2.25, float("inf"), float("inf")]
    assert got["a", "w"]["n"] == 0 and got["a", "w"]["q"] == [None] * 3
    assert got["b", "w"]["q"] == [4.0] * 3
    assert got["b", "v"]["q"][0] == float("-inf") and got["b", "v"]["q"][2] == 2.0
    none = ordering.exact_percentiles(df.filter("g = 'z'"), ["v"], [0.5]).collect()
    assert [(r["n"], r["q"]) for r in none] == [(0, [None])]


def test_all_rows_of_one_value(spark):
    df = spark.range(500).select(F.lit(7.0).alias("v"))
    assert ordering.exact_percentiles(df, ["v"], [0.0, 0.4, 1.0]).first()["q"] == [7.0] * 3

