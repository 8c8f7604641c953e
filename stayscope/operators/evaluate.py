"""Evaluation of scores: one frame with a 0/1 label ``y`` and a probability ``p``.

``keys`` (model, split, fold, …) evaluates many score sets in the same jobs.
Everything that depends on order reads :func:`curve`, the table of distinct
probabilities, so ties and constant scores are single rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.functions import fixed
from stayscope.functions.columns import count_below
from stayscope.functions.columns import ratio as _ratio
from stayscope.operators.ordering import exact_percentiles, match_keys, running_sums

SWEEP_METRICS = ("precision", "recall", "f1", "accuracy", "positive_rate")


def present(p: Column) -> Column:
    """The probability; a missing or NaN one raises, since metrics over part of the rows would mislead."""
    return F.when(p.isNull() | F.isnan(p.cast("double")), F.raise_error("a score is null or NaN")).otherwise(p)


def checked(scores: DataFrame) -> DataFrame:
    return scores.withColumn("p", present(F.col("p")))


def curve(scores: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct probabilities, highest first: tp, n, running and total sums."""
    distinct = checked(scores).groupBy(*keys, "p").agg(
        F.sum(F.col("y").cast("long")).alias("tp"), F.count("*").alias("n")
    )
    return running_sums(distinct, "p", ["tp", "n"], keys, descending=True)


def average_precision() -> Column:
    """Step sum of precision over recall gains; 0 without positives. Aggregate over curve()."""
    gain = _ratio(F.col("tp"), F.col("tot_tp")) * F.col("cum_tp") / F.col("cum_n")
    return F.coalesce(F.sum(gain), F.lit(0.0))


def roc_auc() -> Column:
    """Area under ROC with ties counted half; null with one class. Aggregate over curve()."""
    negatives = (F.col("n") - F.col("tp")).cast("double")
    above = F.col("cum_tp") - F.col("tp") / 2.0
    weight = F.col("tot_tp").cast("double") * (F.col("tot_n") - F.col("tot_tp"))
    return F.sum(_ratio(negatives * above, weight))


def lift(fraction: float = fixed.TOP_FRACTION) -> Column:
    """Precision in the top fraction over the base rate. Aggregate over curve().

    The top holds round-half-even(n·fraction) rows, at least one. If it ends
    inside a group of equal scores, the group counts by its own positive rate:
    the mean over all orders of the tied rows, so no arbitrary order leaks in.
    """
    size, hits = top_hits(fraction)
    base = F.sum("tp") / F.sum("n")
    return F.when(base <= 0, F.lit(0.0)).otherwise(_ratio(hits / size, base))


def top_hits(fraction: float) -> tuple[Column, Column]:
    """Rows of the top fraction and the positives among them (see :func:`lift`)."""
    size = F.greatest(F.bround(F.col("tot_n") * fraction, 0), F.lit(1.0))
    taken = F.greatest(
        F.lit(0.0), F.least(size - (F.col("cum_n") - F.col("n")), F.col("n").cast("double"))
    )
    return F.max(size), F.sum(F.col("tp") * taken / F.col("n"))


def binary_metrics(
    scores: DataFrame,
    threshold: float | str = fixed.DEFAULT_THRESHOLD,
    keys: Sequence[str] = (),
    fraction: float = fixed.TOP_FRACTION,
) -> DataFrame:
    """All metrics at a threshold: one row per ``keys``, one ordering pass.

    ``threshold`` is a number or the name of a per-key column of ``scores``.
    """
    by = list(keys)
    if isinstance(threshold, str):
        by = [*by, threshold]
    t = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    p, tp, n = F.col("p"), F.col("tp"), F.col("n")
    hit = p >= t
    true_pos = F.coalesce(F.sum(F.when(hit, tp)), F.lit(0))
    flagged = F.coalesce(F.sum(F.when(hit, n)), F.lit(0))
    positives, rows = F.sum(tp), F.sum(n)
    precision, recall, f1, accuracy = _rates(true_pos, flagged, positives, rows)
    return (
        curve(scores, by)
        .groupBy(*by)
        .agg(
            average_precision().alias("pr_auc"),
            roc_auc().alias("roc_auc"),
            (F.sum(tp * (1 - p) * (1 - p) + (n - tp) * p * p) / rows).alias("brier"),
            f1.alias("f1"),
            precision.alias("precision"),
            recall.alias("recall"),
            accuracy.alias("accuracy"),
            (flagged / rows).alias("positive_rate"),
            (positives / rows).alias("base_rate"),
            lift(fraction).alias("lift_at_10"),
            *([] if isinstance(threshold, str) else [t.alias("threshold")]),
        )
    )


def _rates(true_pos: Column, flagged: Column, positives: Column, rows: Column):
    def zero(value: Column) -> Column:
        return F.coalesce(value, F.lit(0.0))

    precision = zero(_ratio(true_pos, flagged))
    recall = zero(_ratio(true_pos, positives))
    f1 = zero(_ratio(true_pos * 2, flagged + positives))
    accuracy = _ratio(rows - positives - flagged + true_pos * 2, rows)
    return precision, recall, f1, accuracy


def threshold_sweep(
    scores: DataFrame,
    thresholds: Sequence[float] = tuple(fixed.THRESHOLD_GRID),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Metrics at every threshold, from one pass over the rows.

    A row falls to the number of thresholds it reaches; sums over the few bins
    give the counts at each threshold.
    """
    grid = sorted({float(t) for t in thresholds})
    by = list(keys)
    bins = checked(scores).groupBy(*by, _grid_bin(F.col("p"), grid).alias("bin")).agg(
        F.count("*").alias("n"), F.sum(F.col("y").cast("long")).alias("tp")
    )
    # At most len(thresholds) + 1 bins per key; the sums at a threshold run over that list.
    listed = bins.groupBy(*by).agg(
        F.collect_list(F.struct("bin", "n", "tp")).alias("_bins"),
        F.sum("tp").alias("_pos"),
        F.sum("n").alias("_rows"),
    )

    def reached(field: str) -> Column:
        return F.expr(
            f"aggregate(_bins, 0L, (a, x) -> a + if(x.bin >= bin, x.{field}, 0L))"
        )

    counted = listed.select(
        *by, "_pos", "_rows", "_bins",
        F.explode(F.sequence(F.lit(1), F.lit(len(grid)))).alias("bin"),
    ).select(*by, "_pos", "_rows", "bin", reached("tp").alias("_hit"), reached("n").alias("_flag"))
    hit, flag, pos, rows = (F.col(c) for c in ("_hit", "_flag", "_pos", "_rows"))
    precision, recall, f1, accuracy = _rates(hit, flag, pos, rows)
    return counted.select(
        *by,
        F.get(F.array(*[F.lit(t) for t in grid]), F.col("bin") - 1).alias("threshold"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        accuracy.alias("accuracy"),
        _ratio(flag, rows).alias("positive_rate"),
    )


def _grid_bin(p: Column, grid: list[float]) -> Column:
    """Number of thresholds at or below p: a guess from the step, put right by comparing."""
    if len(grid) < 3 or max(abs(b - a - 0.01) for a, b in zip(grid, grid[1:], strict=False)) > 1e-9:
        return count_below(p, [F.lit(t) for t in grid], inclusive=True)
    values = F.array(*[F.lit(t) for t in grid])
    guess = F.greatest(
        F.lit(0), F.least(F.floor((p - grid[0]) * 100 + 1).cast("int"), F.lit(len(grid)))
    )
    # Rounding can put the guess one step off on either side of an edge.
    down = (guess > 0) & (F.get(values, guess - 1) > p)
    up = (guess < len(grid)) & (F.get(values, guess) <= p)
    return F.when(down, guess - 1).when(up, guess + 1).otherwise(guess)


def optimal_threshold(
    sweep: DataFrame, metric: str = "f1", keys: Sequence[str] = ()
) -> DataFrame:
    """Best threshold per key; the smallest wins a tie. Unknown metrics raise."""
    if metric not in SWEEP_METRICS:
        raise ValueError(f"unknown metric {metric!r}, use one of {list(SWEEP_METRICS)}")
    best = F.max_by(
        F.struct("threshold", F.col(metric).alias("score")),
        F.struct(F.col(metric), -F.col("threshold")),
    )
    return (
        sweep.groupBy(*keys)
        .agg(best.alias("_b"))
        .select(*keys, F.lit(metric).alias("metric"), "_b.threshold", "_b.score")
    )


def confusion(
    scores: DataFrame, threshold: float = fixed.DEFAULT_THRESHOLD, keys: Sequence[str] = ()
) -> DataFrame:
    """All four (y, predicted) cells, zeros included."""
    hit, pos = F.col("p") >= threshold, F.col("y") == 1
    cells = [(0, 0, ~pos & ~hit), (0, 1, ~pos & hit), (1, 0, pos & ~hit), (1, 1, pos & hit)]
    counted = checked(scores).groupBy(*keys).agg(
        *[F.count_if(c).alias(f"n{a}{b}") for a, b, c in cells]
    )
    return counted.select(
        *keys,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("y"), F.lit(b).alias("predicted"),
                        F.col(f"n{a}{b}").alias("n"),
                    )
                    for a, b, _ in cells
                ]
            )
        ),
    )


def calibration(
    scores: DataFrame, n_bins: int = 10, keys: Sequence[str] = ()
) -> DataFrame:
    """Observed rate against mean probability in quantile bins; empty bins absent."""
    scores = checked(scores)
    inner = [i / n_bins for i in range(1, n_bins)]
    edges = exact_percentiles(scores, ["p"], inner, keys).select(*keys, "q")
    if keys:
        binned = match_keys(scores, edges, keys)
        edge = [F.get("q", F.lit(i)) for i in range(len(inner))]
    else:
        binned = scores
        q = edges.select("q").scalar()
        edge = [F.get(q, F.lit(i)) for i in range(len(inner))]
    return (
        binned.groupBy(*keys, count_below(F.col("p"), edge).alias("bin"))
        .agg(
            F.count("*").alias("n"),
            F.avg("p").alias("mean_predicted"),
            F.avg("y").alias("observed_rate"),
        )
    )


def pr_points(scores: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Precision/recall at every distinct score, the (0, 1) end point, the base-rate line."""
    base = _ratio(F.col("tot_tp"), F.col("tot_n"))
    points = curve(scores, keys).select(
        *keys,
        F.col("p").alias("threshold"),
        _ratio(F.col("cum_tp"), F.col("cum_n")).alias("precision"),
        _ratio(F.col("cum_tp"), F.col("tot_tp")).alias("recall"),
        base.alias("base_rate"),
    )
    return points.unionByName(_end_point(points, keys, precision=1.0, recall=0.0))


def roc_points(scores: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """False and true positive rates at every distinct score, and the (0, 0) point."""
    negatives = F.col("tot_n") - F.col("tot_tp")
    points = curve(scores, keys).select(
        *keys,
        F.col("p").alias("threshold"),
        _ratio(F.col("cum_n") - F.col("cum_tp"), negatives).alias("fpr"),
        _ratio(F.col("cum_tp"), F.col("tot_tp")).alias("tpr"),
    )
    return points.unionByName(_end_point(points, keys, fpr=0.0, tpr=0.0))


def _end_point(points: DataFrame, keys: Sequence[str], **values: float) -> DataFrame:
    """One extra row per key with the given values and no threshold."""
    rest = [c for c in points.columns if c not in keys and c not in values and c != "threshold"]
    grouped = points.groupBy(*keys).agg(
        F.count("*").alias("_n"), *[F.first(c).alias(c) for c in rest]
    )
    return grouped.filter(F.col("_n") > 0).select(
        *keys,
        F.lit(None).cast("double").alias("threshold"),
        *[F.lit(v).alias(c) for c, v in values.items()],
        *rest,
    )


def top_importance(importance: DataFrame, n: int = 20) -> DataFrame:
    """Features with the highest importance, missing ones dropped."""
    return (
        importance.filter(F.col("importance").isNotNull())
        .orderBy(F.desc("importance"), "feature")
        .limit(n)
    )
