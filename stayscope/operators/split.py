"""Exact stratified splits and folds without ordering the table.

Rows are ranked inside their class by a hash of seed and key. A split is then
a handful of cut points on that order. Counting rows per hash prefix finds the
prefixes the cuts fall into; only those rows are ordered, and every row gets
its split by comparing its own hash with the cuts: a narrow projection.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayscope.functions.columns import label_column, order_hash, require_columns


@dataclass(frozen=True)
class Cuts:
    """Per class: ascending (hash, key) positions ending each part but the last."""

    key: str
    target: str
    seed: int
    parts: tuple[str, ...]
    positions: dict[int, tuple]

    def part_of(self, df: DataFrame) -> Column:
        """Name of the part a row of ``df`` belongs to."""
        label, key = label_column(df, self.target), F.col(self.key)
        rank = order_hash(self.seed, key)
        chosen = F.lit(None).cast("string")
        for value, cuts in self.positions.items():
            part = F.lit(self.parts[-1])
            for name, cut in reversed(list(zip(self.parts, cuts, strict=False))):
                if cut is not None:
                    last_hash, last_key = cut
                    inside = (rank < last_hash) | ((rank == last_hash) & (key <= F.lit(last_key)))
                    part = F.when(inside, F.lit(name)).otherwise(part)
            chosen = F.when(label == value, part).otherwise(chosen)
        return chosen


def stratified_split(
    df: DataFrame,
    key: str,
    target: str,
    test_size: float = 0.15,
    val_size: float = 0.15,
    seed: int = 42,
    column: str = "split",
    prefix: int = 4,
) -> DataFrame:
    """Add ``column`` with train / val / test, exact sizes, equal class shares."""
    require_columns(df, [key, target])
    check_fractions(test_size, val_size)
    cuts = split_cuts(df, key, target, test_size, val_size, seed, prefix)
    return df.withColumn(column, cuts.part_of(df))


def check_fractions(test_size: float, val_size: float) -> None:
    if not (0 < test_size < 1 and 0 < val_size < 1 and test_size + val_size < 1):
        raise ValueError(
            f"split sizes must be positive with a sum below 1, got {test_size} and {val_size}"
        )


def split_cuts(
    df: DataFrame,
    key: str,
    target: str,
    test_size: float = 0.15,
    val_size: float = 0.15,
    seed: int = 42,
    prefix: int = 4,
) -> Cuts:
    counts = class_counts(df, target)
    n = sum(counts.values())
    n_test = math.ceil(n * test_size)
    kept = allocate(counts, n - n_test)
    n_val = math.ceil((n - n_test) * (val_size / (1.0 - test_size)))
    train = allocate(kept, n - n_test - n_val)
    ends = {c: [counts[c] - kept[c], counts[c] - train[c]] for c in counts}
    return _locate(df, key, target, seed, ("test", "val", "train"), ends, prefix)


def fold_cuts(
    df: DataFrame, key: str, target: str, k: int = 5, seed: int = 42, prefix: int = 4
) -> Cuts:
    """Stratified folds ``"0"`` … ``"k-1"``; class counts differ by at most one."""
    if k < 2:
        raise ValueError("at least two folds are needed")
    ends = {
        c: [sum(n // k + (j < n % k) for j in range(i + 1)) for i in range(k - 1)]
        for c, n in class_counts(df, target).items()
    }
    return _locate(df, key, target, seed, tuple(str(i) for i in range(k)), ends, prefix)


def class_counts(df: DataFrame, target: str) -> dict[int, int]:
    """Rows per class of a 0/1 (or few-valued) label: a handful of numbers."""
    rows = (
        df.groupBy(label_column(df, target).alias("label"))
        .agg(F.count("*").alias("n"))
        .orderBy("label")
        .collect()
    )
    if any(r["label"] is None for r in rows):
        raise ValueError(f"column {target} has missing labels")
    return {r["label"]: r["n"] for r in rows}


def allocate(counts: dict[int, int], wanted: int) -> dict[int, int]:
    """Share ``wanted`` rows over classes: floors, then largest remainders."""
    total = sum(counts.values())
    exact = {c: n / total * wanted for c, n in counts.items()}
    given = {c: math.floor(x) for c, x in exact.items()}
    by_remainder = sorted(counts, key=lambda c: (given[c] - exact[c], c))
    for c in by_remainder[: wanted - sum(given.values())]:
        given[c] += 1
    return given


def _locate(
    df: DataFrame,
    key: str,
    target: str,
    seed: int,
    parts: tuple[str, ...],
    ends: dict[int, Sequence[int]],
    prefix: int,
) -> Cuts:
    """Find the (hash, key) of the row at each wanted rank of each class."""
    spark = df.sparkSession
    rank = order_hash(seed, F.col(key))
    rows = df.select(
        label_column(df, target).alias("label"), rank.alias("hash"), F.col(key).alias("key")
    ).withColumn("head", F.substring("hash", 1, prefix))
    wanted = spark.createDataFrame(
        [(c, i, e) for c, cuts in ends.items() for i, e in enumerate(cuts) if e > 0],
        "label int, cut int, rank long",
    )
    # At most 16^prefix rows per class.
    by_head = W.partitionBy("label").orderBy("head").rowsBetween(W.unboundedPreceding, 0)
    heads = (
        rows.groupBy("label", "head")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(by_head) - F.col("n"))
    )
    holding = heads.join(wanted, "label").filter(
        (F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n"))
    )
    needed = holding.groupBy("label", "head", "before").agg(
        F.collect_list(F.struct("cut", "rank")).alias("cuts")
    )
    inside = W.partitionBy("label", "head").orderBy("hash", "key")
    found = (
        rows.join(needed, ["label", "head"])
        .withColumn("position", F.col("before") + F.row_number().over(inside))
        .select("label", "hash", "key", "position", F.inline("cuts"))
        .filter(F.col("position") == F.col("rank"))
        .select("label", "cut", "hash", "key")
        .collect()
    )
    at = {(r["label"], r["cut"]): (r["hash"], r["key"]) for r in found}
    positions = {
        c: tuple(at.get((c, i)) for i in range(len(cuts))) for c, cuts in ends.items()
    }
    return Cuts(key, target, seed, parts, positions)
