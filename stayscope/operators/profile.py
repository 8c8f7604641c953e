"""Profiling: quality report, summaries, group rates, chart data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.functions import fixed
from stayscope.functions.columns import is_missing, label_column, lenient_number, no_nan
from stayscope.functions.columns import ratio as _ratio
from stayscope.operators.ordering import exact_percentiles, match_keys

PERCENTILES = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in _NUMERIC or t.startswith("decimal")]


def text_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t == "string"]


def _row_digest(df: DataFrame) -> Column:
    """256-bit digest of a row; each value carries its length, so it is unambiguous."""
    parts = []
    for c, kind in df.dtypes:
        value = F.col(f"`{c}`")
        if kind in ("float", "double"):
            value = value + F.lit(0).cast(kind)  # -0.0 equals 0.0
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


#: 16-bit lanes of a table digest, the lowest last; the sum of a lane stays exact for 2**47 rows.
LANES = 8


def table_digest(df: DataFrame) -> DataFrame:
    """One row: ``n_rows`` and ``digest``, the sum of the row digests modulo 2**128 in hexadecimal.

    Rows are a multiset: neither their order nor their partitions matter, copies count,
    and digests of parts can be added. Columns count in their order, not by name. An empty table has digest zero.
    """
    code = F.hex("_row")
    lanes = [F.conv(F.substring(code, 4 * k + 1, 4), 16, 10).cast("long").alias(f"l{k}") for k in range(LANES)]
    summed = df.select(_row_digest(df).alias("_row")).select(*lanes).agg(
        F.count("*").alias("n_rows"), *[F.coalesce(F.sum(f"l{k}"), F.lit(0)).alias(f"l{k}") for k in range(LANES)]
    )
    carry = F.lit(0).cast("long")
    digits = []
    for k in range(LANES - 1, -1, -1):
        total = F.col(f"l{k}") + carry
        digits.insert(0, F.lpad(F.lower(F.hex(F.pmod(total, F.lit(1 << 16)))), 4, "0"))
        carry = F.shiftright(total, 16)
    return summed.select("n_rows", F.concat(*digits).alias("digest"))


def dataset_summary(
    df: DataFrame, target: str = fixed.TARGET, positive: str = "Yes", total: str = "TotalCharges"
) -> DataFrame:
    """One row: rows, columns, positive rate (4 decimals), missing totals, digest of the data and
    size of its text (bytes of all values written as text)."""
    hit = F.coalesce(F.col(target) == positive, F.lit(False))
    size = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)).cast("long") for c in df.columns])
    counted = df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_cols"),
        F.round(F.avg(hit.cast("int")), 4).alias("target_pos_rate"),
        F.count_if(is_missing(df, total)).alias("n_missing_total"),
        F.coalesce(F.sum(size), F.lit(0)).alias("n_bytes"),
    )
    return counted.crossJoin(table_digest(df).select("digest"))  # one row each


def quality_report(df: DataFrame, target: str = fixed.TARGET, positive: str = "Yes") -> DataFrame:
    """One row: rows, columns, surplus copies, positive rate, imbalance ratio.

    Copies are counted on row digests, so the shuffle carries 32 bytes per
    distinct row instead of whole rows.
    """
    hit = F.coalesce(F.col(target).cast("string") == positive, F.lit(False))
    rate = F.avg("_hit")
    return (
        df.select(_row_digest(df).alias("_digest"), hit.cast("int").alias("_hit"))
        .groupBy("_digest")
        .agg(F.count("*").alias("_n"), F.sum("_hit").alias("_hits"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_rows"),
            F.lit(len(df.columns)).cast("long").alias("n_cols"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("n_duplicates"),
            _ratio(F.sum("_hits"), F.sum("_n")).alias("target_positive_rate"),
        )
        .withColumn("imbalance_ratio", imbalance_ratio(F.col("target_positive_rate")))
    )


def imbalance_ratio(rate: Column) -> Column:
    """Negatives per positive; infinite when one class is absent."""
    return F.when((rate == 0.0) | (rate == 1.0), F.lit(float("inf"))).otherwise(
        _ratio(F.lit(1.0) - rate, rate)
    )


def column_quality(df: DataFrame) -> DataFrame:
    """One row per column: (variable, missing, is_constant), from one aggregate.

    A column is constant if it holds at most one distinct value, null counting
    as a value; minimum and maximum tell that without counting distinct values.
    """
    cells = []
    for i, (c, kind) in enumerate(df.dtypes):
        missing = is_missing(df, c)
        value = F.when(~missing, F.col(f"`{c}`"))
        n_missing = F.count_if(missing)
        constant = (n_missing == F.count("*")) | (
            (n_missing == 0) & F.coalesce(F.min(value) == F.max(value), F.lit(False))
        )
        cells.append(
            F.struct(
                F.lit(c).alias("variable"),
                n_missing.alias("missing"),
                constant.alias("is_constant"),
            ).alias(f"s{i}")
        )
    return df.agg(*cells).select(F.inline(F.array(*[f"s{i}" for i in range(len(cells))])))


def missing_counts(df: DataFrame) -> DataFrame:
    """Columns with missing values only, fewest first."""
    return (
        column_quality(df)
        .filter(F.col("missing") > 0)
        .select("variable", "missing")
        .orderBy("missing", "variable")
    )


def numeric_summary(
    df: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Per column: count, missing, mean, std, min, max, skew, kurtosis, percentiles.

    Skew and kurtosis are the bias-corrected sample forms; they and the standard
    deviation are null when there are too few values. Moments of all columns
    come from one aggregate without unpivoting.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    values = df.select(*[lenient_number(F.col(f"`{c}`")).alias(c) for c in columns])
    moments = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`")
        n = F.count(v).cast("double")
        g1, g2 = no_nan(F.skewness(v)), no_nan(F.kurtosis(v))
        skew = g1 * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
        kurt = (
            (n - 1)
            / F.nullif((n - 2) * (n - 3), F.lit(0.0))
            * ((n + 1) * g2 + 6)
        )
        # A column of equal values has no spread: both corrected forms are 0 there.
        flat = F.min(v) == F.max(v)
        moments.append(
            F.struct(
                F.lit(c).alias("variable"),
                F.count(v).alias("count"),
                (F.count("*") - F.count(v)).alias("missing"),
                F.avg(v).alias("mean"),
                F.when(F.count(v) > 1, F.stddev_samp(v)).alias("std"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
                F.when(F.count(v) > 2, F.when(flat, 0.0).otherwise(skew)).alias("skew"),
                F.when(F.count(v) > 3, F.when(flat, 0.0).otherwise(kurt)).alias("kurtosis"),
            ).alias(f"s{i}")
        )
    table = values.agg(*moments).select(
        F.inline(F.array(*[f"s{i}" for i in range(len(columns))]))
    )
    quantiles = exact_percentiles(values, columns, list(PERCENTILES.values())).select(
        "variable", *[F.get("q", F.lit(i)).alias(p) for i, p in enumerate(PERCENTILES)]
    )
    return table.join(quantiles, "variable", "left")


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, value, n), nulls kept; combined before the shuffle."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    long = text.unpivot([], [f"`{c}`" for c in columns], "variable", "value")
    return long.groupBy("variable", "value").agg(F.count("*").alias("n"))


def categorical_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: n_unique, missing, top value (ties: smallest), share of all rows."""
    columns = list(columns) if columns is not None else text_columns(df)
    present = F.col("value").isNotNull()
    top = F.min_by("value", F.when(present, F.struct(-F.col("n"), F.col("value"))))
    return (
        _value_counts(df, columns)
        .groupBy("variable")
        .agg(
            F.count_if(present).alias("n_unique"),
            F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("missing"),
            F.coalesce(top, F.lit("")).alias("top"),
            _ratio(F.max(F.when(present, F.col("n"))), F.sum("n")).alias("top_freq"),
        )
    )


def target_distribution(df: DataFrame, target: str = fixed.TARGET) -> DataFrame:
    """Count and share of every target value, missing included."""
    counts = df.groupBy(F.col(target).cast("string").alias(target)).agg(
        F.count("*").alias("count")
    )
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(target, "count", _ratio(F.col("count"), total).alias("pct")).orderBy(
        F.desc("count"), target
    )


def rate_by_category(
    df: DataFrame, column: str, target: str = fixed.TARGET, min_count: int = 30
) -> DataFrame:
    """Positive rate per category (missing is one), highest first."""
    return (
        _category_sums(df, column, target)
        .select(
            "category",
            "count",
            _ratio(F.col("positives"), F.col("count")).alias("churn_rate"),
            (F.col("count") >= min_count).alias("is_reliable"),
        )
        .orderBy(F.desc("churn_rate"), "category")
    )


def _category_sums(df: DataFrame, column: str, target: str) -> DataFrame:
    return (
        df.select(F.col(column).cast("string").alias("category"), label_column(df, target).alias("_y"))
        .groupBy("category")
        .agg(F.count("*").alias("count"), F.sum("_y").alias("positives"))
    )


def rate_chart(df: DataFrame, column: str, target: str = fixed.TARGET) -> DataFrame:
    """Group rates beside the base rate of all rows, highest first.

    The base rate is a scalar over the grouped sums, not a window that would
    bring every category to one task.
    """
    sums = _category_sums(df, column, target)
    base = sums.agg(_ratio(F.sum("positives"), F.sum("count"))).scalar()
    return sums.select(
        "category",
        "count",
        _ratio(F.col("positives"), F.col("count")).alias("churn_rate"),
        base.alias("base_rate"),
    ).orderBy(F.desc("churn_rate"), "category")


def histogram(
    df: DataFrame, column: str, target: str = fixed.TARGET, bins: int = 30
) -> DataFrame:
    """Equal-width bins with the density inside each class; empty bins kept.

    Rows with a missing value or class are left out.
    """
    rows = df.select(
        F.col(target).cast("string").alias("class"),
        no_nan(F.col(column).cast("double")).alias("_v"),
    ).dropna()
    span = rows.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi"))).scalar()
    low, high = span.getField("lo"), span.getField("hi")
    # One shared value gets a unit-wide window around it.
    start = F.when(low == high, low - 0.5).otherwise(low)
    width = F.when(low == high, F.lit(1.0) / bins).otherwise((high - low) / bins)
    found = (
        rows.withColumn(
            "bin",
            F.least(F.floor((F.col("_v") - start) / width), F.lit(bins - 1)).cast("int"),
        )
        .groupBy("class", "bin")
        .agg(F.count("*").alias("n"))
    )
    # At most ``bins`` entries per class, so the gaps are filled from a list.
    filled = found.groupBy("class").agg(
        F.sum("n").alias("n_class"),
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("by_bin"),
    ).select(
        "class", "n_class", "by_bin",
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
    )
    n = F.coalesce(F.try_element_at("by_bin", F.col("bin")), F.lit(0))
    return filled.select(
        "class",
        "bin",
        (start + F.col("bin") * width).alias("bin_start"),
        (start + (F.col("bin") + 1) * width).alias("bin_end"),
        n.alias("count"),
        (n / (F.col("n_class") * width)).alias("density"),
    ).orderBy("class", "bin")


def box_plot(
    df: DataFrame, column: str, target: str = fixed.TARGET
) -> DataFrame:
    """Per class: quartiles, whiskers (extremes within 1.5 IQR) and outlier count."""
    rows = df.select(
        F.col(target).cast("string").alias("class"),
        no_nan(F.col(column).cast("double")).alias("_v"),
    ).dropna()
    quartiles = exact_percentiles(rows, ["_v"], [0.25, 0.5, 0.75], ["class"]).select(
        "class",
        F.get("q", F.lit(0)).alias("q1"),
        F.get("q", F.lit(1)).alias("median"),
        F.get("q", F.lit(2)).alias("q3"),
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        match_keys(rows, quartiles, ["class"])
        .groupBy("class", "q1", "median", "q3")
        .agg(
            F.count("*").alias("n"),
            F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
        .withColumn("whisker_low", F.least("whisker_low", "q1"))
        .withColumn("whisker_high", F.greatest("whisker_high", "q3"))
    )


def split_rates(df: DataFrame, target: str, split: str = "split") -> DataFrame:
    """Rows and positive rate of every split."""
    return df.groupBy(split).agg(
        F.count("*").alias("n_rows"), F.avg(label_column(df, target)).alias("positive_rate")
    )

