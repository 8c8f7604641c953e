"""Registered queries of monitoring, recalibration and business criteria over the order tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope.functions import fixed
from stayscope.operators import contract, evaluate, monitor, prepare, profile, recalibrate
from stayscope.plans.registered import Query, smooth_scores, snapshot_scores, tidy, typed_accounts
from stayscope.plans.snapshot import read_table
from stayscope.session import fresh_path
from stayscope.sources import tables
from stayscope.streaming import monitor as streaming

QUERIES: dict[str, Query] = {}

#: Average precision that a manifest would promise for the order scores.
PROMISED_PR_AUC = 0.28


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def order_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as a scoring event: customer, time and a closed-form probability."""
    p = F.round(1 / (1 + F.exp(1.5 - F.col("o_totalprice") / 200000.0)), 6)
    return read_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").alias("scored_at"), p.alias("p")
    )


@register
def feature_stability(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with paperless billing against the stored histogram of those without."""
    accounts = typed_accounts(spark, folder)
    fitted = accounts.filter(F.col("PaperlessBilling") == "No")
    histogram = monitor.reference_histogram(fitted, fixed.NUMERIC, ["Contract", "InternetService", "PaymentMethod"])
    stored = spark.read.parquet(tables.write_table(histogram, fresh_path(spark, "reference")))
    return tidy(monitor.population_stability(stored, accounts.filter(F.col("PaperlessBilling") == "Yes")))


def _shown(days: DataFrame) -> DataFrame:
    return tidy(days.select(
        F.col("day").cast("string").alias("day"), "n", "mean", *[F.get("deciles", F.lit(k)).alias(f"d{k + 1}") for k in range(9)], "week_mean", "shifted",
    ))


@register
def daily_scores(spark: SparkSession, folder: str) -> DataFrame:
    counts = monitor.daily_counts(order_scores(spark, folder), "scored_at")
    return _shown(monitor.daily_distribution(counts))


@register
def streamed_daily_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The same days from a stream over the orders, landed in the order of their dates."""
    work = fresh_path(spark, "daily")
    scores = order_scores(spark, folder)
    scores.repartitionByRange("scored_at").sortWithinPartitions("scored_at").write.parquet(f"{work}/landed")
    arrivals = spark.readStream.schema(scores.schema).parquet(f"{work}/landed")
    query = streaming.run_daily_counts(arrivals, f"{work}/counts", f"{work}/progress")
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return _shown(monitor.daily_distribution(streaming.stored_daily_counts(spark, f"{work}/counts")))


@register
def retrospective_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Returns of order lines judged by the customer's last order score before shipping."""
    scores = order_scores(spark, folder)
    lines = read_table(spark, folder, "lineitem").join(
        scores.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    outcomes = lines.select("o_custkey", F.col("l_shipdate").alias("observed_at"), (F.col("l_returnflag") == "R").cast("int").alias("y"))
    predictions = scores.select("o_custkey", F.col("scored_at").alias("predicted_at"), "p")
    months = monitor.retrospective(predictions, outcomes, PROMISED_PR_AUC, "o_custkey")
    return tidy(months.withColumn("month", F.col("month").cast("string")))


@register
def isotonic_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(recalibrate.isotonic_blocks(snapshot_scores(spark, folder)))


@register
def recalibrated_brier(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted on the customers with even keys, stored and reloaded as a pipeline, judged on the others."""
    scores = smooth_scores(spark, folder)
    even = F.col("c_custkey") % 2 == 0
    path = fresh_path(spark, "isotonic")
    PipelineModel([recalibrate.fit_recalibration(scores.filter(even))]).write().save(path)
    rest = PipelineModel.load(path).transform(scores.filter(~even))
    parts = rest.select(F.lit("raw").alias("score"), "y", "p").unionByName(
        rest.select(F.lit("calibrated").alias("score"), "y", F.col(recalibrate.CALIBRATED).alias("p"))
    )
    return tidy(evaluate.binary_metrics(parts, keys=["score"]).select("score", "brier", "pr_auc", "base_rate"))


@register
def capture_base(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(monitor.base_for_capture(smooth_scores(spark, folder), keys=["region"]))


@register
def campaign_value(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(monitor.campaign_return(smooth_scores(spark, folder), ["region"]), 4)


@register
def outlier_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Charges outside the interquartile bounds, by rules fitted, stored and read again."""
    accounts = typed_accounts(spark, folder)
    columns = ["MonthlyCharges", "TotalCharges"]
    path = tables.write_table(monitor.fit_outlier_bounds(accounts, columns), fresh_path(spark, "bounds"))
    bounds = spark.read.parquet(path)
    rules = contract.Contract(fixed.KEY, dict(accounts.dtypes), tuple(contract.fitted_ranges(bounds)))
    broken = contract.row_violations(spark.read.parquet(tables.write_table(accounts, fresh_path(spark, "interim"))), rules)
    counts = broken.groupBy("rule", "column").agg(F.count("*").alias("n"))
    return tidy(bounds.join(counts, "column", "left").select("column", "low", "high", F.coalesce("n", F.lit(0)).alias("n_outside")), 4)


@register
def missing_flags(spark: SparkSession, folder: str) -> DataFrame:
    flagged = prepare.with_missing_flags(typed_accounts(spark, folder), ["TotalCharges", "Partner"])
    return tidy(flagged.groupBy("Contract", "was_TotalCharges_missing", "was_Partner_missing").agg(F.count("*").alias("n")))


@register
def data_digest(spark: SparkSession, folder: str) -> DataFrame:
    """Summary of the documents with the digest and size of the data."""
    return tidy(profile.dataset_summary(read_table(spark, folder, "documents"), "lang", "en", "n_chars"), 4)
