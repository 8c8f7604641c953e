"""Watching a model in use: drift of features and scores, retrospective quality, campaign value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayscope.functions import fixed
from stayscope.functions.columns import count_below, lenient_number, ratio, require_columns
from stayscope.operators import evaluate
from stayscope.operators.asof import last_before
from stayscope.operators.ordering import exact_percentiles, match_keys, running_sums

# --- fixed values: limits of the monitoring plan ---------------------------
PSI_LIMITS = {"watch": 0.10, "investigate": 0.20, "retrain": 0.25}
DAILY_SHIFT_MAX = 0.05
RANKING_DROP_MAX = 0.10
BRIER_MAX = 0.19
CAPTURE, CAPTURE_BASE_MAX = 0.5, 0.20

# --- fixed values: assumptions of the campaign -----------------------------
UPLIFT, CONTACT_COST, MONTHLY_REVENUE, MONTHS_KEPT = 0.12, 8.0, 65.0, 6.0

#: Share that stands for an empty bin in the stability index.
FLOOR = 1e-4

#: Probabilities are counted by this many digits, so that counts of any two runs can be added.
DIGITS = 6


# --- stability of features -------------------------------------------------
def _bins(df: DataFrame, edges: dict[str, list[float]], categorical: Sequence[str]) -> DataFrame:
    """Rows per (feature, bin): numeric bins by number, levels by name, missing values apart."""

    def place(feature: str) -> Column:
        value = lenient_number(F.col(f"`{feature}`"))
        number = count_below(value, [F.lit(e) for e in edges[feature]], inclusive=True)
        return F.when(value.isNull(), "missing").otherwise(F.concat(F.lit("bin "), number.cast("string")))

    def level(feature: str) -> Column:
        return F.coalesce(F.concat(F.lit("level "), F.col(f"`{feature}`").cast("string")), F.lit("missing"))

    pairs = [F.struct(F.lit(f).alias("feature"), place(f).alias("bin")) for f in edges]
    pairs += [F.struct(F.lit(f).alias("feature"), level(f).alias("bin")) for f in categorical]
    counted = df.select(F.inline(F.array(*pairs))).groupBy("feature", "bin").agg(F.count("*").alias("n"))
    whole = W.partitionBy("feature")
    return counted.withColumn("share", ratio(F.col("n"), F.sum("n").over(whole)))


def reference_histogram(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), n_bins: int = 10
) -> DataFrame:
    """Histogram of the population a model was fitted on: (feature, bin, n, share, edges).

    Numeric edges are the distinct exact quantiles of that population; they travel with
    the table, so that a later population is counted in the same bins. Levels have no edges.
    """
    require_columns(df, [*numeric, *categorical])
    edges: dict[str, list[float]] = {}
    if numeric:
        inner = [i / n_bins for i in range(1, n_bins)]
        plain = df.select(*[lenient_number(F.col(f"`{c}`")).alias(c) for c in numeric])
        found = {r["variable"]: r["q"] for r in exact_percentiles(plain, numeric, inner).collect()}  # one row per feature
        edges = {c: sorted({q for q in found[c] if q is not None}) for c in numeric}
    known = F.create_map(*[x for c, own in edges.items() for x in (F.lit(c), F.array(*[F.lit(e) for e in own]).cast("array<double>"))])
    own = F.try_element_at(known, F.col("feature")) if edges else F.lit(None).cast("array<double>")
    return _bins(df, edges, categorical).withColumn("edges", own)


def population_stability(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Stability index per feature of a stored reference: (feature, psi, n_bins, status).

    Both sides meet by a full outer join on (feature, bin), so unseen levels and bins left
    empty count, with ``FLOOR`` as their share on the side that lacks them.
    """
    features = reference.groupBy("feature").agg(F.first("edges").alias("edges")).collect()  # one row per feature
    edges = {r["feature"]: list(r["edges"]) for r in features if r["edges"] is not None}
    categorical = [r["feature"] for r in features if r["edges"] is None]
    require_columns(current, [*edges, *categorical])
    now = _bins(current, edges, categorical).select("feature", "bin", F.col("share").alias("_now"))
    met = reference.select("feature", "bin", F.col("share").alias("_then")).join(now, ["feature", "bin"], "full_outer")
    then, new = (F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(FLOOR)) for c in ("_then", "_now"))
    index = met.groupBy("feature").agg(F.sum((new - then) * F.log(new / then)).alias("psi"), F.count("*").alias("n_bins"))
    status = F.lit("stable")
    for name, limit in PSI_LIMITS.items():
        status = F.when(F.col("psi") > limit, name).otherwise(status)
    return index.withColumn("status", status)


# --- scores by day ---------------------------------------------------------
def daily_counts(scored: DataFrame, time: str, p: str = "p") -> DataFrame:
    """Rows per day and probability of ``DIGITS`` digits: counts of any parts of the rows can be added."""
    checked = evaluate.present(F.col(p))
    return scored.groupBy(F.to_date(time).alias("day"), F.round(checked, DIGITS).alias("probability")).agg(F.count("*").alias("n"))


def daily_distribution(counts: DataFrame) -> DataFrame:
    """Per day: n, mean, nine deciles, the mean of the seven days before, and whether the day is off.

    ``counts`` has (day, probability, n) and may hold a pair several times. A decile is
    the least probability that so many rows do not exceed. Rows without a day are a day of their
    own, without neighbours; a day without rows in the week before is never off.
    """
    merged = counts.groupBy("day", "probability").agg(F.sum("n").alias("n"))
    placed = running_sums(merged, "probability", ["n"], ["day"])
    reached = [F.min(F.when(F.col("cum_n") * 10 >= F.col("tot_n") * k, F.col("probability"))) for k in range(1, 10)]
    whole = F.round(F.col("probability") * 10**DIGITS).cast("long") * F.col("n")
    days = placed.groupBy("day").agg(
        F.sum("n").alias("n"), F.sum(whole).alias("_sum"), F.array(*reached).alias("deciles"),
    )
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    week = W.orderBy(number).rangeBetween(-7, -1)  # one row per day
    before = F.when(F.col("day").isNotNull(), ratio(F.sum("_sum").over(week), F.sum("n").over(week) * 10**DIGITS))
    mean = ratio(F.col("_sum"), F.col("n") * 10**DIGITS)
    return days.select("day", "n", mean.alias("mean"), "deciles", before.alias("week_mean")).withColumn(
        "shifted", F.coalesce(F.abs(F.col("mean") - F.col("week_mean")) > DAILY_SHIFT_MAX, F.lit(False))
    )


# --- what came of the predictions ------------------------------------------
def retrospective(
    predictions: DataFrame,
    outcomes: DataFrame,
    reference_pr_auc: float,
    key: str = fixed.KEY,
    predicted_at: str = "predicted_at",
    observed_at: str = "observed_at",
) -> DataFrame:
    """Per month of the outcomes: ranking and calibration of the last predictions made before them.

    ``predictions`` has (key, time, p), ``outcomes`` (key, time, y). Outcomes without an
    earlier prediction are counted, not judged. ``ranking_alert``: average precision more than
    ``RANKING_DROP_MAX`` below that of the manifest; ``calibration_alert``: Brier above ``BRIER_MAX``.
    """
    met = last_before(outcomes.drop("p"), predictions, key, observed_at, predicted_at, ["p"]).select(
        F.trunc(F.col(observed_at), "month").alias("month"), F.col("y").cast("int").alias("y"), "p",
    )
    sizes = met.groupBy("month").agg(F.count("*").alias("n_outcomes"), F.count("p").alias("n_judged"))
    judged = evaluate.binary_metrics(met.filter(F.col("p").isNotNull()), keys=["month"]).select("month", "pr_auc", "brier")
    drop = 1 - F.col("pr_auc") / F.lit(float(reference_pr_auc))
    return match_keys(sizes, judged, ["month"], "left").select(
        "month", "n_outcomes", "n_judged", "pr_auc", "brier", drop.alias("pr_auc_drop"),
        F.coalesce(drop > RANKING_DROP_MAX, F.lit(False)).alias("ranking_alert"),
        F.coalesce(F.col("brier") > BRIER_MAX, F.lit(False)).alias("calibration_alert"),
    )


# --- business criteria -----------------------------------------------------
def base_for_capture(scores: DataFrame, capture: float = CAPTURE, keys: Sequence[str] = ()) -> DataFrame:
    """Least share of the base, highest scores first, that holds ``capture`` of the positives.

    Equal scores are taken together. Without positives the share is null and not within the limit.
    """
    enough = F.col("cum_tp") >= F.col("tot_tp") * capture
    share = F.min(F.when(enough & (F.col("tot_tp") > 0), ratio(F.col("cum_n"), F.col("tot_n"))))
    out = evaluate.curve(scores, keys).groupBy(*keys).agg(share.alias("base_share"))
    return out.withColumn("within_limit", F.coalesce(F.col("base_share") <= CAPTURE_BASE_MAX, F.lit(False)))


def campaign_return(
    scores: DataFrame,
    keys: Sequence[str] = (),
    fraction: float = fixed.TOP_FRACTION,
    uplift: float = UPLIFT,
    cost: float = CONTACT_COST,
    revenue: float = MONTHLY_REVENUE,
    months: float = MONTHS_KEPT,
) -> DataFrame:
    """Value of contacting the top fraction: contacted, captured (expected among ties), kept, revenue
    kept, cost, net saving and return on cost."""
    size, hits = evaluate.top_hits(fraction)
    top = evaluate.curve(scores, keys).groupBy(*keys).agg(size.alias("n_contacted"), hits.alias("n_captured"))
    kept = F.col("n_captured") * uplift
    value, spent = F.col("n_kept") * revenue * months, F.col("n_contacted") * cost
    valued = top.withColumn("n_kept", kept).withColumn("revenue_kept", value).withColumn("campaign_cost", spent)
    net = F.col("revenue_kept") - F.col("campaign_cost")
    return valued.withColumn("net_saving", net).withColumn("roi", ratio(F.col("net_saving"), F.col("campaign_cost")))


# --- outliers --------------------------------------------------------------
def fit_outlier_bounds(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Bounds of the interquartile rule per column: (column, q1, q3, low, high)."""
    plain = df.select(*[lenient_number(F.col(f"`{c}`")).alias(c) for c in columns])
    q1, q3 = F.get("q", F.lit(0)), F.get("q", F.lit(1))
    return exact_percentiles(plain, columns, [0.25, 0.75]).select(
        F.col("variable").alias("column"), q1.alias("q1"), q3.alias("q3"),
        (q1 - (q3 - q1) * reach).alias("low"), (q3 + (q3 - q1) * reach).alias("high"),
    )
