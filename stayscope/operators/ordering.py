"""Exact global order at scale: running sums and percentiles without one big task.

Both start from a range sketch: a bounded list of approximate quantiles of the
ordering column. Rows fall into the ranges; one small aggregate per range gives
the offset at which the range starts; only the rest is ordered, inside each
range. The sketch steers balance only, never the result: any list of bounds
gives the same numbers, also when a lost executor's task is run again. There is
one path for inputs of every size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayscope.functions.columns import no_nan
from stayscope.session import cut_lineage

_ALL = "_all"
_RANGE = "_range"


def range_bounds(df: DataFrame, columns: Sequence[str], ranges: int | None = None) -> list[list]:
    """Split points of each numeric column into about equal row counts.

    One aggregate over ``df``; at most ``ranges`` numbers per column come back.
    The sketch of a task stays below a few hundred kilobytes per column.
    """
    ranges = ranges or default_ranges(df)
    grid = [i / ranges for i in range(1, ranges)]
    row = df.agg(
        *[
            F.percentile_approx(F.col(f"`{c}`").cast("double"), grid, 5 * ranges).alias(f"b{i}")
            for i, c in enumerate(columns)
        ]
    ).first()
    found = [sorted({b for b in (row[f"b{i}"] or ()) if math.isfinite(b)}) for i in range(len(columns))]
    return [[-math.inf, *(points or [0.0]), math.inf] for points in found]


def default_ranges(df: DataFrame) -> int:
    """One range per shuffle partition: the setting that sizes all other tasks too."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8)


def with_ranges(df: DataFrame, columns: Sequence[str], outputs: Sequence[str], bounds) -> DataFrame:
    """Add the range number of each column (values must be doubles)."""
    return Bucketizer(
        inputCols=list(columns),
        outputCols=list(outputs),
        splitsArray=bounds,
        handleInvalid="keep",
    ).transform(df)


def running_sums(
    table: DataFrame,
    order_by: str,
    sums: Sequence[str],
    keys: Sequence[str] = (),
    descending: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``cum_<s>`` (inclusive) and ``tot_<s>`` for every measure in ``sums``.

    ``table`` must hold one row per (keys, ``order_by``), i.e. already be
    aggregated, so a value shared by a third of all rows is a single row here.
    """
    by = list(keys) or [_ALL]
    base = table if keys else table.withColumn(_ALL, F.lit(0))

    def direction(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    bounds = range_bounds(table, [order_by], ranges)
    ranged = with_ranges(
        base.withColumn("_v", F.col(order_by).cast("double")), ["_v"], [_RANGE], bounds
    ).drop("_v")
    starts = _range_starts(ranged, by, sums, direction(_RANGE))
    inner = (
        W.partitionBy(*by, _RANGE)
        .orderBy(direction(order_by))
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    out = match_keys(ranged, starts, [*by, _RANGE]).select(
        *[c for c in ranged.columns if c != _RANGE],
        *[(F.col(f"_start_{s}") + F.sum(s).over(inner)).alias(f"cum_{s}") for s in sums],
        *[f"tot_{s}" for s in sums],
    )
    return out if keys else out.drop(_ALL)


def _range_starts(
    ranged: DataFrame, by: list[str], sums: Sequence[str], order: Column, with_size: bool = False
) -> DataFrame:
    """Per key and range: sum of all earlier ranges, and the key's total."""
    whole = W.partitionBy(*by)
    running = whole.orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    per_range = ranged.groupBy(*by, _RANGE).agg(*[F.sum(s).alias(s) for s in sums])
    return per_range.select(
        *by,
        _RANGE,
        *[(F.sum(s).over(running) - F.col(s)).alias(f"_start_{s}") for s in sums],
        *[F.sum(s).over(whole).alias(f"tot_{s}") for s in sums],
        *([F.col(sums[0]).alias("_in_range")] if with_size else []),
    )


def match_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"):
    """Null-safe equi-join on ``keys``, keeping one copy of them.

    No broadcast hint: Spark broadcasts a side only if its measured size is
    under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    renamed = right.select(
        *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)],
        *[f"`{c}`" for c in right.columns if c not in keys],
    )
    condition = F.lit(True)
    for i, k in enumerate(keys):
        condition = condition & left[f"`{k}`"].eqNullSafe(renamed[f"_k{i}"])
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_k{i}" for i in range(len(keys))])


def exact_percentiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    keys: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Exact interpolated percentiles: one row (keys, variable, n, q: array).

    Missing values and NaN are skipped. ``q`` follows ``probabilities``; a key's
    column without values gives n = 0 and null entries. Rows are counted per
    value before anything is ordered or joined.
    """
    probabilities = [float(p) for p in probabilities]
    wide = df.select(
        *[f"`{k}`" for k in keys],
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("variable"), no_nan(F.col(f"`{c}`").cast("double")).alias("value")) for c in columns
        ])),
    )
    by = [*keys, "variable"]
    # the input is read once: all that follows reads the counts per value
    counted = cut_lineage(wide.groupBy(*by, "value").agg(F.count("*").alias("_copies")))
    held = counted.filter(F.col("value").isNotNull())
    names = [f"_c{i}" for i in range(len(columns))]
    apart = held.select(*[F.when(F.col("variable") == c, F.col("value")).alias(n) for c, n in zip(columns, names, strict=True)])
    bounds = range_bounds(apart, names, ranges)
    edges = dict(zip(columns, bounds, strict=True))
    place = F.lit(None).cast("double")
    ranged = held.withColumns({n: F.when(F.col("variable") == c, F.col("value")) for c, n in zip(columns, names, strict=True)})
    ranged = with_ranges(ranged, names, [f"_r{i}" for i in range(len(columns))], [edges[c] for c in columns])
    for i, c in enumerate(columns):
        place = F.when(F.col("variable") == c, F.col(f"_r{i}")).otherwise(place)
    counts = ranged.select(*by, place.alias(_RANGE), "value", "_copies")
    starts = _range_starts(
        counts.withColumnRenamed("_copies", "n"), by, ["n"], F.col(_RANGE).asc(), with_size=True
    )

    # Only ranges that hold a wanted position are ordered.
    position = [F.lit(p) * (F.col("tot_n") - 1) for p in probabilities]
    lower = [F.floor(x) for x in position]
    upper = [F.ceil(x) for x in position]

    def within(target: Column, start: Column, size: Column) -> Column:
        return (target >= start) & (target < start + size)

    needed = F.lit(False)
    for target in [*lower, *upper]:
        needed = needed | within(target, F.col("_start_n"), F.col("_in_range"))
    values = match_keys(counts, starts.filter(needed), [*by, _RANGE])
    running = (
        W.partitionBy(*by, _RANGE)
        .orderBy("value")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    placed = values.withColumn(
        "_from", F.col("_start_n") + F.sum("_copies").over(running) - F.col("_copies")
    )

    def value_at(target: Column) -> Column:
        return F.max(F.when(within(target, F.col("_from"), F.col("_copies")), F.col("value")))

    picked = placed.groupBy(*by).agg(
        F.first("tot_n").alias("tot_n"),
        *[value_at(t).alias(f"_lo{i}") for i, t in enumerate(lower)],
        *[value_at(t).alias(f"_hi{i}") for i, t in enumerate(upper)],
    )

    def between(i: int) -> Column:
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        weighted = (upper[i] - position[i]) * low + (position[i] - lower[i]) * high
        return F.when(low == high, low).otherwise(weighted)

    found = picked.select(*by, F.array(*[between(i) for i in range(len(probabilities))]).alias("q"))
    none = F.array(*[F.lit(None).cast("double") for _ in probabilities])
    valued = F.when(F.col("value").isNotNull(), F.col("_copies")).otherwise(0)
    every = counted.groupBy(*by).agg(F.sum(valued).alias("n"))
    if not keys:  # columns of an empty table have a row too
        named = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("variable"))
        every = named.join(every, "variable", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return match_keys(every, found, by, "left").select(*by, "n", F.coalesce("q", none).alias("q"))
