"""Isotonic recalibration: adjacent violators pooled by ranges, blocks merged at their borders."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.operators import evaluate
from stayscope.operators.ordering import default_ranges
from stayscope.session import cut_lineage

#: Blocks that one task may pool; more are pooled in ranges again, of this many at least.
BLOCKS, LEAST = 200_000, 4

#: Digits of the probabilities that are calibrated: at most a million and one different ones.
DIGITS = 6

CALIBRATED = "calibrated"


def pool(tp: np.ndarray, n: np.ndarray) -> np.ndarray:
    """First row of every block of equal fitted rate, for rows in ascending order."""
    first, positives, rows = [], [], []
    for k, (a, b) in enumerate(zip(tp.tolist(), n.tolist(), strict=True)):
        start = k
        # a block joins the one before unless its rate is greater
        while first and positives[-1] * b >= a * rows[-1]:
            a, b = a + positives.pop(), b + rows.pop()
            start = first.pop()
        first.append(start)
        positives.append(a)
        rows.append(b)
    return np.array(first, np.int64)


def _pooled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a sorted partition."""
    table = pa.Table.from_batches(list(batches)) if batches else None
    if table is None or not table.num_rows:
        return
    low, high, tp, n = (table.column(i).to_numpy() for i in range(4))
    first = pool(tp, n)
    last = np.append(first[1:], len(low)) - 1
    yield pa.RecordBatch.from_arrays(
        [pa.array(low[first]), pa.array(high[last]), pa.array(np.add.reduceat(tp, first)), pa.array(np.add.reduceat(n, first))],
        names=["low", "high", "tp", "n"],
    )


def isotonic_blocks(scores: DataFrame) -> DataFrame:
    """Blocks of the isotonic fit of ``y`` on ``p``: (low, high, tp, n, rate), rates strictly rising.

    Rows are first counted per probability. Ranges of probabilities are pooled on
    their own; pooling blocks again gives the fit of the whole, so rounds over other
    ranges follow until no range ends above the start of the next, or until the blocks left fit one task.
    """
    p = F.round(evaluate.present(F.col("p")), DIGITS)
    counted = scores.groupBy(p.alias("low")).agg(F.sum(F.col("y").cast("long")).alias("tp"), F.count("*").alias("n"))
    blocks = cut_lineage(counted.select("low", F.col("low").alias("high"), "tp", "n"))
    ranges = default_ranges(scores)
    while True:
        n = blocks.count()
        few = n <= BLOCKS
        parts = 1 if few else max(1, min(ranges, n // LEAST))  # several blocks to every range, or none would meet
        ordered = blocks.repartitionByRange(parts, "low").sortWithinPartitions("low")
        pooled = ordered.mapInArrow(_pooled, "low double, high double, tp long, n long")
        blocks = cut_lineage(pooled.withColumn("_range", F.spark_partition_id()))
        if parts == 1 or _rising(blocks):
            return blocks.select("low", "high", "tp", "n", (F.col("tp") / F.col("n")).alias("rate"))
        blocks = blocks.drop("_range")
        ranges = ranges - 1 if ranges % 2 == 0 else ranges + 1  # other borders


def _rising(blocks: DataFrame) -> bool:
    """Whether every range starts above the end of the range before: two rows per range."""
    rate = F.col("tp") / F.col("n")
    ends = blocks.groupBy("_range").agg(F.min_by(rate, "low").alias("first"), F.max_by(rate, "low").alias("last")).orderBy("_range").collect()
    return all(a["last"] < b["first"] for a, b in zip(ends, ends[1:], strict=False))


def fit_recalibration(scores: DataFrame) -> IsotonicRegressionModel:
    """A pipeline stage that adds ``calibrated`` to scores ``p``: linear between the ends of the blocks.

    The stage holds two numbers per block. Fit on rows the model was not fitted on.
    """
    ends = isotonic_blocks(scores).select(
        F.explode(F.array_distinct(F.array("low", "high"))).alias("p"), F.col("rate").alias("y"), F.col("n").cast("double").alias("n"),
    )
    return IsotonicRegression(featuresCol="p", labelCol="y", weightCol="n", predictionCol=CALIBRATED).fit(ends)
