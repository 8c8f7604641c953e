"""Daily counts of scores from a stream: event time, a watermark, and state per day and probability."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stayscope.operators import evaluate
from stayscope.operators.monitor import DIGITS


def run_daily_counts(
    scored: DataFrame, output: str, checkpoint: str, time: str = "scored_at", p: str = "p", late: str = "2 days"
) -> StreamingQuery:
    """Start a query that keeps rows per day and probability of ``DIGITS`` digits.

    A day takes late rows until it lies more than ``late`` before the newest day seen by an
    earlier micro-batch; later ones are dropped and the day's state goes. Every micro-batch writes the
    new totals of the pairs it touched to its own folder, replacing what a failed try left.
    """
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    counts = (
        scored.select(
            F.date_trunc("day", F.col(time).cast("timestamp")).alias("_day"),
            F.round(evaluate.present(F.col(p)), DIGITS).alias("probability"),
        )
        .withWatermark("_day", late)
        .groupBy("_day", "probability")
        .agg(F.count("*").alias("n"))
        .select(F.to_date("_day").alias("day"), "probability", "n")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/run={run}/batch={batch_id}")

    return (
        counts.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stored_daily_counts(spark: SparkSession, output: str) -> DataFrame:
    """Counts of all runs: within a run the newest total of a pair, which is its greatest."""
    stored = spark.read.schema("day date, probability double, n long, run string, batch long").parquet(output)
    newest = stored.groupBy("run", "day", "probability").agg(F.max("n").alias("n"))
    return newest.groupBy("day", "probability").agg(F.sum("n").alias("n"))
