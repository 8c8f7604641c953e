"""Feature ranking on an encoded matrix: four scores and their consensus.

Scores are long tables (method, feature, score) so that several methods union.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayscope.functions.columns import count_below, order_hash
from stayscope.functions.columns import ratio as _ratio
from stayscope.operators import models
from stayscope.operators.evaluate import average_precision, curve
from stayscope.operators.ordering import exact_percentiles


def mutual_information(
    matrix: DataFrame,
    features: Sequence[str],
    target: str,
    discrete: Sequence[str] = (),
    bins: int = 10,
) -> DataFrame:
    """Plug-in mutual information (nats) of each feature with the target.

    Discrete features use their own values; the others quantile bins, right
    closed. Equal edges merge, so a heavily repeated value gets its own bin.
    """
    continuous = [f for f in features if f not in set(discrete)]
    edges: dict[str, list[float]] = {}
    if continuous:
        inner = [i / bins for i in range(1, bins)]
        edges = {
            r["variable"]: [e for e in r["q"] if e is not None]
            for r in exact_percentiles(matrix, continuous, inner).collect()
        }

    def bin_of(feature: str):
        value = F.col(f"`{feature}`").cast("double")
        if feature in edges:
            return F.when(
                value.isNotNull(),
                count_below(value, [F.lit(e) for e in edges[feature]]).cast("double"),
            )
        return value

    pairs = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), bin_of(f).alias("bin"))
            for f in features
        ]
    )
    cells = (
        matrix.select(F.col(target).cast("int").alias("y"), F.inline(pairs))
        .filter(F.col("bin").isNotNull())
        .groupBy("feature", "bin", "y")
        .agg(F.count("*").alias("n"))
    )
    per_bin = cells.groupBy("feature", "bin").agg(F.sum("n").alias("n_bin"))
    per_class = cells.groupBy("feature", "y").agg(F.sum("n").alias("n_class"))
    total = per_class.groupBy("feature").agg(F.sum("n_class").alias("n_all"))
    share = F.col("n") / F.col("n_all")
    independent = F.col("n_bin").cast("double") * F.col("n_class") / F.col("n_all")
    return (
        cells.join(per_bin, ["feature", "bin"])
        .join(per_class, ["feature", "y"])
        .join(total, "feature")
        .groupBy("feature")
        .agg(F.greatest(F.sum(share * F.ln(F.col("n") / independent)), F.lit(0.0)).alias("score"))
        .select(F.lit("mutual_info").alias("method"), "feature", "score")
    )


def chi2_scores(matrix: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Chi-square of class sums for features without negative values, else null.

    One aggregate by class over all columns; only its few rows are unpivoted.
    """
    columns = [F.col(f"`{f}`").cast("double") for f in features]
    per_class = matrix.groupBy(F.col(target).cast("int").alias("y")).agg(
        F.count("*").alias("rows"),
        *[F.sum(c).alias(f"s{i}") for i, c in enumerate(columns)],
        *[F.min(c).alias(f"m{i}") for i, c in enumerate(columns)],
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"), F.col(f"s{i}").alias("seen"), F.col(f"m{i}").alias("low")
            )
            for i, f in enumerate(features)
        ]
    )
    long = per_class.select("rows", F.inline(cells))
    totals = long.groupBy("feature").agg(
        F.sum("rows").alias("all_rows"), F.sum("seen").alias("all_seen"), F.min("low").alias("lowest")
    )
    expected = F.col("rows") / F.col("all_rows") * F.col("all_seen")
    gap = F.col("seen") - expected
    return (
        long.join(totals, "feature")
        .groupBy("feature")
        .agg(F.sum(_ratio(gap * gap, expected)).alias("score"), F.first("lowest").alias("lowest"))
        .select(
            F.lit("chi2").alias("method"),
            "feature",
            F.when(F.col("lowest") >= 0, F.col("score")).alias("score"),
        )
    )


def l1_importance(
    matrix: DataFrame, features: Sequence[str], target: str, c: float = 0.5
) -> DataFrame:
    """Absolute coefficients of a balanced L1 logistic model."""
    fitted = models.fit("logreg_l1", matrix, features, target, c=c)
    return models.importance(fitted, features).select(
        F.lit("l1_logreg").alias("method"), "feature", F.col("importance").alias("score")
    )


#: Hexadecimal digits of the hash order by which rows are put into ranges: 65,536 of them.
RANGE_DIGITS = 4


def with_donors(rows: DataFrame, seed: int) -> DataFrame:
    """Add ``donor``: ``own`` of the next row in the hash order of ``key`` over all rows, the last
    taking the first's.

    Rows are ordered inside ranges of the hash; the last row of a range takes the first of the
    next range that has rows, from a table of one row per range.
    """
    marked = rows.withColumn("mark", order_hash(seed, F.col("key")))
    ranged = marked.withColumn("range", F.substring("mark", 1, RANGE_DIGITS))
    firsts = ranged.groupBy("range").agg(F.min(F.struct("mark", "key", "own"))["own"].alias("first"))
    line = W.orderBy("range")
    after = F.coalesce(F.lead("first").over(line), F.first("first").over(line.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    following = firsts.select("range", after.alias("after"))
    inside = W.partitionBy("range").orderBy("mark", "key")
    inner = ranged.withColumn("donor", F.lead("own").over(inside))
    return inner.join(following, "range").withColumn("donor", F.coalesce("donor", "after")).drop("mark", "range", "after")


def permutation_importance(
    matrix: DataFrame,
    features: Sequence[str],
    target: str,
    key: str,
    trees: int = 200,
    repeats: int = 10,
    max_depth: int = 12,
    seed: int = 42,
) -> DataFrame:
    """Mean drop of average precision when one feature is permuted.

    Per repeat every row takes the feature values of another row: the next one
    in a hash order of all rows, the last taking the first. That is
    one shuffle per repeat for all features together, and each feature keeps
    its exact multiset of values.
    """
    fitted = models.fit(
        "random_forest", matrix, features, target, seed=seed, trees=trees, max_depth=max_depth,
        min_leaf=1,
    )
    columns = [F.col(f"`{f}`").cast("double") for f in features]
    rows = matrix.select(
        F.col(key).alias("key"), F.col(target).cast("int").alias("y"),
        F.array(*columns).alias("own"),
    )
    base = models.score(fitted, rows.select("key", "y", array_to_vector("own").alias("features")))
    base_ap = curve(base).agg(average_precision().alias("ap")).first()["ap"]
    both = reduce(
        DataFrame.unionByName,
        [with_donors(rows, seed + 1 + r).select(F.lit(r).alias("repeat"), "y", "own", "donor") for r in range(repeats)],
    )
    names = F.array(*[F.lit(f) for f in features])
    swapped = F.concat(
        F.expr("slice(own, 1, at)"),
        F.array(F.get("donor", F.col("at"))),
        F.expr("slice(own, at + 2, size(own))"),
    )
    permuted = both.select("repeat", "y", "own", "donor", F.posexplode(names).alias("at", "feature")).select(
        "repeat", "y", "feature", array_to_vector(swapped).alias("features")
    )
    scored = models.score(fitted, permuted)
    return (
        curve(scored, ["repeat", "feature"])
        .groupBy("repeat", "feature")
        .agg(average_precision().alias("ap"))
        .groupBy("feature")
        .agg((F.lit(base_ap) - F.avg("ap")).alias("score"))
        .select(F.lit("permutation_rf").alias("method"), "feature", "score")
    )


def consensus(
    scores: DataFrame, k: int = 20, feature_order: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scores with rank and vote, consensus table, top k).

    Ranks take the smallest position on ties, and missing scores come last but
    still get a rank. Votes count ranks up to k; ties in votes go to the mean
    min-max score, then to the feature order. Sizes are features × methods.
    """
    methods = scores.select("method").distinct()
    if methods.isEmpty():
        raise ValueError("no scores to combine")
    if feature_order is None:
        names = scores.select("feature").distinct()
        listed = names.select(
            "feature", F.row_number().over(W.orderBy("feature")).alias("position")
        ).select(F.array_sort(F.collect_list(F.struct("position", "feature"))).alias("f"))
        order = listed.select("f").scalar()
    else:
        order = F.array(
            *[
                F.struct(F.lit(i + 1).alias("position"), F.lit(f).alias("feature"))
                for i, f in enumerate(feature_order)
            ]
        )
    grid = methods.select("method", F.inline(order))
    full = grid.join(scores, ["method", "feature"], "left").withColumn(
        "score", F.when(~F.isnan("score"), F.col("score"))
    )
    whole = W.partitionBy("method")
    low, high = F.min("score").over(whole), F.max("score").over(whole)
    ranked = full.select(
        "method",
        "feature",
        "position",
        "score",
        F.rank().over(whole.orderBy(F.desc_nulls_last("score"))).alias("rank"),
        F.when(high == low, F.col("score") * 0.0)
        .otherwise(_ratio(F.col("score") - low, high - low))
        .alias("norm_score"),
    ).withColumn("vote", (F.col("rank") <= k).cast("int"))
    table = (
        ranked.groupBy("feature", "position")
        .agg(F.sum("vote").alias("votes"), F.avg("norm_score").alias("mean_norm_score"))
        .orderBy(F.desc("votes"), F.desc_nulls_last("mean_norm_score"), "position")
        .drop("position")
    )
    top = (
        ranked.groupBy("feature", "position")
        .agg(F.sum("vote").alias("votes"), F.avg("norm_score").alias("mean_norm_score"))
        .orderBy(F.desc("votes"), F.desc_nulls_last("mean_norm_score"), "position")
        .limit(k)
        .select("feature", "votes", "mean_norm_score")
    )
    return ranked.drop("position"), table, top


def wide(ranked: DataFrame, value: str, methods: Sequence[str]) -> DataFrame:
    """One column per method of ``score`` or ``rank``."""
    return ranked.groupBy("feature").agg(
        *[F.max(F.when(F.col("method") == m, F.col(value))).alias(m) for m in methods]
    )


def select_features(
    matrix: DataFrame,
    features: Sequence[str],
    target: str,
    key: str,
    k: int = 20,
    discrete: Sequence[str] = (),
    trees: int = 200,
    repeats: int = 10,
    max_depth: int = 12,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All four methods on the training matrix, then :func:`consensus`."""
    cached = matrix.select(key, target, *[f"`{f}`" for f in features]).persist()
    try:
        scores = reduce(
            DataFrame.unionByName,
            [
                mutual_information(cached, features, target, discrete),
                chi2_scores(cached, features, target),
                l1_importance(cached, features, target),
                permutation_importance(
                    cached, features, target, key, trees, repeats, max_depth, seed
                ),
            ],
        ).collect()  # features × methods numbers
    finally:
        cached.unpersist()
    table = matrix.sparkSession.createDataFrame(scores, "method string, feature string, score double")
    return consensus(table, k, features)

