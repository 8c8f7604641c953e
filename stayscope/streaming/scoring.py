"""Scoring of arriving customers: stateless, so no watermark is needed."""

from __future__ import annotations

import hashlib

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stayscope.operators.contract import scoring_contract, separate
from stayscope.operators.prepare import scoring_rows
from stayscope.operators.scoring import predictions, score_accounts


def read_arrivals(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1000):
    """Stream of contract rows from landed Parquet files."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    )


def score_stream(arrivals: DataFrame, pipeline: PipelineModel, threshold: float) -> DataFrame:
    """Prediction records of the valid rows of a batch or a stream."""
    valid, _ = separate(scoring_rows(arrivals), scoring_contract())
    return predictions(score_accounts(valid, pipeline), threshold)


def quarantine(arrivals: DataFrame) -> DataFrame:
    """Rows that break the scoring contract, with the rules they break."""
    return separate(scoring_rows(arrivals), scoring_contract())[1]


def run_scoring(
    arrivals: DataFrame,
    pipeline: PipelineModel,
    threshold: float,
    output: str,
    checkpoint: str,
) -> StreamingQuery:
    """Start one query that writes predictions and quarantine, each once per batch.

    Every micro-batch overwrites its own ``run=<checkpoint>/batch=<id>`` folder, so
    a batch repeated after a failure replaces its output instead of adding to it,
    and a run with a new checkpoint leaves the output of earlier ones alone.
    """
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = scoring_rows(batch).persist()  # read once for both outputs
        try:
            valid, bad = separate(rows, scoring_contract())
            scored = predictions(score_accounts(valid, pipeline), threshold)
            scored.write.mode("overwrite").parquet(f"{output}/predictions/run={run}/batch={batch_id}")
            bad.select("customerID", F.explode("violations").alias("v")).select(
                "customerID", "v.rule", "v.column", "v.value"
            ).write.mode("overwrite").parquet(f"{output}/quarantine/run={run}/batch={batch_id}")
        finally:
            rows.unpersist()

    return (
        arrivals.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
