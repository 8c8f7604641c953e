"""Monitoring, as-of joins and recalibration against plain computations."""

import datetime as dt
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from stayscope.operators import contract, evaluate, fairness, monitor, prepare, profile, recalibrate
from stayscope.operators.asof import last_before
from stayscope.streaming.monitor import run_daily_counts, stored_daily_counts


def day(n):
    return dt.datetime(2024, 3, 1) + dt.timedelta(days=n)


# --- as-of join --------------------------------------------------------------
def test_last_fact_before_each_event(spark):
    """One key on most rows, several ranges, ties in time, missing keys and times."""
    rng = random.Random(1)
    keys = ["hot"] * 6 + ["a", "b", None]
    facts = [(rng.choice(keys), day(rng.randrange(40)) if rng.random() < 0.95 else None, rng.random()) for _ in range(300)]
    events = [(i, rng.choice(keys), day(rng.randrange(40)) if rng.random() < 0.95 else None, -1.0) for i in range(300)]
    left = spark.createDataFrame(events, "id long, k string, at timestamp, p double").repartition(5)
    right = spark.createDataFrame(facts, "k string, since timestamp, p double").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.id: r.p for r in last_before(left, right, "k", "at", "since", ["p"]).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 300
    for i, k, at, _ in events:
        before = [(t, p) for key, t, p in facts if key is not None and key == k and t is not None and at is not None and t < at]
        assert got[i] == (max(before)[1] if before else None)


def test_as_of_makes_no_pairs(spark):
    left = spark.createDataFrame([(1, "a", day(1))], "id long, k string, at timestamp")
    joined = last_before(left, left.select("k", F.col("at").alias("t"), F.col("id").alias("v")), "k", "at", "t", ["v"])
    assert [tuple(r) for r in joined.select("id", "v").collect()] == [(1, None)]
    assert last_before(left.limit(0), left.select("k", F.col("at").alias("t"), F.col("id").alias("v")), "k", "at", "t", ["v"]).count() == 0


# --- stability ---------------------------------------------------------------
def test_stability_counts_unseen_levels_empty_bins_and_missing_values(spark, tmp_path):
    fitted = [(float(i), "x" if i % 2 else "y") for i in range(100)]
    new = [(float(i % 20), "z" if i % 4 == 0 else "x") for i in range(79)] + [(None, None)]
    reference = monitor.reference_histogram(spark.createDataFrame(fitted, "v double, c string"), ["v"], ["c"])
    reference.write.parquet(str(tmp_path / "histogram"))
    got = {r.feature: r for r in monitor.population_stability(
        spark.read.parquet(str(tmp_path / "histogram")), spark.createDataFrame(new, "v double, c string")).collect()}

    def index(a, b):
        out = 0
        for k in {*a, *b}:
            e, x = (max(s.get(k, 0) / sum(s.values()), monitor.FLOOR) for s in (a, b))
            out += (x - e) * math.log(x / e)
        return out

    edges = np.quantile([v for v, _ in fitted], np.arange(1, 10) / 10)

    def counts(values):
        out = {}
        for v in values:
            out[v] = out.get(v, 0) + 1
        return out

    def bin_of(v):
        return None if v is None else int((edges <= v).sum())

    assert got["v"].psi == pytest.approx(index(counts(bin_of(v) for v, _ in fitted), counts(bin_of(v) for v, _ in new)))
    assert got["c"].psi == pytest.approx(index(counts(c for _, c in fitted), counts(c for _, c in new)))
    assert got["c"].n_bins == 4 and got["v"].status == "retrain"


@pytest.mark.parametrize(("share", "status"), [(50, "stable"), (67, "watch"), (73, "investigate"), (76, "retrain")])
def test_stability_limits(spark, share, status):
    fitted = spark.createDataFrame([("x" if i < 50 else "y",) for i in range(100)], "c string")
    new = spark.createDataFrame([("x" if i < share else "y",) for i in range(100)], "c string")
    assert monitor.population_stability(monitor.reference_histogram(fitted, [], ["c"]), new).first().status == status


# --- scores by day -----------------------------------------------------------
def scores_by_day():
    rng = random.Random(4)
    rows = [(day(d), round(rng.random(), 3)) for d in (0, 1, 2, 5, 9, 30) for _ in range(30)]
    return rows + [(day(3), 0.9)] * 5 + [(None, 0.5)]


def test_daily_distribution(spark):
    rows = scores_by_day()
    frame = spark.createDataFrame(rows, "at timestamp, p double")
    counts = monitor.daily_counts(frame, "at")
    halves = monitor.daily_counts(frame.filter("p < 0.5"), "at").unionByName(monitor.daily_counts(frame.filter("p >= 0.5"), "at"))
    got = sorted(monitor.daily_distribution(counts).collect(), key=lambda r: str(r.day))
    assert sorted(monitor.daily_distribution(halves).collect(), key=lambda r: str(r.day)) == got
    by_day = {}
    for at, p in rows:
        by_day.setdefault(at and at.date(), []).append(p)
    assert {r.day for r in got} == set(by_day)
    for r in got:
        own = sorted(by_day[r.day])
        assert r.n == len(own) and r.mean == pytest.approx(np.mean(own))
        assert r.deciles == [own[math.ceil(len(own) * k / 10) - 1] for k in range(1, 10)]
        week = [p for d, ps in by_day.items() if d and r.day and 1 <= (r.day - d).days <= 7 for p in ps]
        assert r.week_mean == (pytest.approx(np.mean(week)) if week else None)
        assert r.shifted == bool(week and abs(np.mean(own) - np.mean(week)) > 0.05)


def test_stream_and_batch_agree_and_rows_beyond_the_watermark_are_dropped(spark, tmp_path):
    def land(rows, name):
        spark.createDataFrame(rows, "scored_at timestamp, p double").coalesce(1).write.parquet(str(tmp_path / "landed" / name))

    def run():
        arrivals = spark.readStream.schema("scored_at timestamp, p double").option("recursiveFileLookup", True).parquet(str(tmp_path / "landed"))
        query = run_daily_counts(arrivals, str(tmp_path / "counts"), str(tmp_path / "progress"), late="2 days")
        query.awaitTermination()
        assert query.exception() is None

    first = [(day(d), p / 10) for d in (0, 1) for p in range(10)]
    land(first, "one")
    run()
    land([(day(5), 0.5)], "two")
    run()
    in_time, too_late = [(day(4), 0.25), (day(5), 0.5)], [(day(1), 0.3), (day(0), 0.7)]
    land(in_time + too_late, "three")
    run()
    got = {(r.day, r.probability): r.n for r in stored_daily_counts(spark, str(tmp_path / "counts")).collect()}
    kept = spark.createDataFrame(first + [(day(5), 0.5)] + in_time, "scored_at timestamp, p double")
    assert got == {(r.day, r.probability): r.n for r in monitor.daily_counts(kept, "scored_at").collect()}


# --- retrospective quality ---------------------------------------------------
def test_retrospective_alerts(spark):
    predictions = spark.createDataFrame([("a", day(0), 0.9), ("a", day(10), 0.2), ("b", day(0), 0.1), ("c", day(50), 0.5)], "k string, t timestamp, p double")
    outcomes = spark.createDataFrame(
        [("a", day(5), 1), ("b", day(6), 0), ("c", day(7), 1), ("a", day(40), 1), ("b", day(41), 0)], "k string, at timestamp, y int")
    got = {str(r.month): r for r in monitor.retrospective(predictions, outcomes, 1.0, "k", "t", "at").collect()}
    march, april = got["2024-03-01"], got["2024-04-01"]
    assert (march.n_outcomes, march.n_judged, march.pr_auc, march.ranking_alert, march.calibration_alert) == (3, 2, 1.0, False, False)
    assert march.brier == pytest.approx(0.01) and april.brier == pytest.approx((0.64 + 0.01) / 2)
    assert april.calibration_alert and not april.ranking_alert


# --- recalibration -----------------------------------------------------------
def plain_isotonic(points):
    blocks = []
    for p in sorted({p for p, _ in points}):
        own = [y for q, y in points if q == p]
        blocks.append([p, p, sum(own), len(own)])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][3] >= blocks[-1][2] / blocks[-1][3]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    return [tuple(b) for b in blocks]


@pytest.mark.parametrize("limit", [1_000, 0])
@pytest.mark.parametrize("shape", ["rising", "falling", "constant"])
def test_isotonic_blocks_equal_a_plain_fit(spark, monkeypatch, limit, shape):
    rng = random.Random(len(shape))
    chance = {"rising": lambda p: p * p, "falling": lambda p: 1 - p, "constant": lambda p: 0.4}[shape]
    points = [(p, int(rng.random() < chance(p))) for p in (round(rng.random(), 2) for _ in range(400))]
    frame = spark.createDataFrame(points, "p double, y int")
    if limit == 0:  # ranges only: the blocks left never fit one task
        monkeypatch.setattr(recalibrate, "BLOCKS", 0)
    got = sorted((r.low, r.high, r.tp, r.n) for r in recalibrate.isotonic_blocks(frame).collect())
    assert got == plain_isotonic(points)


def test_recalibration_is_stored_as_a_stage_and_lowers_the_brier_score(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, p, int(rng.random() < p * p)) for i, p in enumerate(rng.random() for _ in range(2_000))]
    frame = spark.createDataFrame(rows, "id int, p double, y int")
    PipelineModel([recalibrate.fit_recalibration(frame.filter("id % 2 = 0"))]).write().save(str(tmp_path / "model"))
    val = PipelineModel.load(str(tmp_path / "model")).transform(frame.filter("id % 2 = 1"))
    raw = evaluate.binary_metrics(val).first()
    better = evaluate.binary_metrics(val.select("y", F.col("calibrated").alias("p"))).first()
    assert better.brier < raw.brier - 0.01


def test_pooling_keeps_equal_rates_together():
    assert recalibrate.pool(np.array([1, 1, 0, 2]), np.array([2, 2, 1, 2])).tolist() == [0, 3]
    empty = list(recalibrate._pooled([pa.RecordBatch.from_arrays([pa.array([], pa.float64())] * 2 + [pa.array([], pa.int64())] * 2, names=list("abcd"))]))
    assert empty == []


# --- business criteria -------------------------------------------------------
def test_capture_and_campaign(spark):
    rows = [(i / 100, 1 if i >= 80 or i < 10 else 0) for i in range(100)]
    scores = spark.createDataFrame(rows, "p double, y int")
    got = monitor.base_for_capture(scores).first()
    assert (got.base_share, got.within_limit) == (0.15, True)
    none = monitor.base_for_capture(scores.withColumn("y", F.lit(0))).first()
    assert (none.base_share, none.within_limit) == (None, False)
    money = monitor.campaign_return(scores).first()
    assert (money.n_contacted, money.n_captured, money.campaign_cost) == (10, 10, 80)
    assert money.net_saving == pytest.approx(10 * 0.12 * 65 * 6 - 80) and money.roi == pytest.approx(money.net_saving / 80)


def test_outlier_rules_from_a_stored_table(spark, tmp_path):
    values = [float(v) for v in [*range(1, 21), 500, -300]] + [None]
    frame = spark.createDataFrame([(str(i), v, None) for i, v in enumerate(values)], "k string, v double, w double")
    monitor.fit_outlier_bounds(frame, ["v", "w"]).write.parquet(str(tmp_path / "bounds"))
    rules = contract.fitted_ranges(spark.read.parquet(str(tmp_path / "bounds")))
    assert [r.column for r in rules] == ["v"]
    broken = contract.row_violations(frame, contract.Contract("k", {}, tuple(rules))).collect()
    assert sorted(r.value for r in broken) == ["-300.0", "500.0"] and {r.rule for r in broken} == {"outlier"}


def test_missing_flags(spark):
    frame = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "v double, c string")
    rows = prepare.with_missing_flags(frame, ["v", "c"]).select("was_v_missing", "was_c_missing").collect()
    assert [tuple(r) for r in rows] == [(0, 0), (1, 1), (1, 0)]
    with pytest.raises(KeyError):
        prepare.with_missing_flags(frame, ["x"])


# --- digests -----------------------------------------------------------------
def test_table_digest_is_one_for_any_order_and_counts_copies(spark):
    rows = [(i % 50, f"text {i % 50}", None if i % 7 else 0.5) for i in range(400)]
    frame = spark.createDataFrame(rows, "a int, b string, c double")
    whole = profile.table_digest(frame).first()
    assert whole.n_rows == 400 and len(whole.digest) == 32
    assert profile.table_digest(frame.repartition(7).orderBy(F.desc("b"))).first() == whole
    parts = [int(profile.table_digest(frame.filter(f"a % 2 = {k}")).first().digest, 16) for k in (0, 1)]
    assert sum(parts) % 2**128 == int(whole.digest, 16)
    assert profile.table_digest(frame.distinct()).first().digest != whole.digest
    assert tuple(profile.table_digest(frame.limit(0)).first()) == (0, "0" * 32)


# --- missing scores ----------------------------------------------------------
@pytest.mark.parametrize("score", [None, float("nan")])
@pytest.mark.parametrize("measure", [
    evaluate.binary_metrics, evaluate.threshold_sweep, evaluate.confusion, evaluate.calibration, fairness.calibration_error,
    lambda s: fairness.group_metrics(s, ["g"]), lambda s: monitor.daily_counts(s.withColumn("t", F.current_date()), "t"),
    recalibrate.isotonic_blocks, evaluate.roc_points,
])
def test_missing_scores_raise_everywhere(spark, score, measure):
    scores = spark.createDataFrame([(0.9, 1, "a"), (0.1, 0, "a"), (score, 1, "b")], "p double, y int, g string")
    with pytest.raises(Exception, match="a score is null or NaN"):
        measure(scores).collect()
