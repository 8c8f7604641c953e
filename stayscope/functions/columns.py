"""Scalar expressions. All stay inside whole-stage code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.functions import fixed


def require_columns(df: DataFrame, names: list[str]) -> None:
    """Raise ``KeyError`` with the sorted list of columns ``df`` lacks."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise KeyError(f"missing columns: {missing}")


def strict_number(text: Column, sql_type: str) -> Column:
    """Cast trimmed text; blank and NaN become null, garbage raises (ANSI mode).

    Kept to one plain cast: optimiser rules copy such expressions into filters.
    """
    return no_nan(F.nullif(F.trim(text), F.lit("")).cast(sql_type), sql_type)


def lenient_number(value: Column) -> Column:
    """Double, or null where the value is not a number."""
    return no_nan(value.try_cast("double"), "double")


def no_nan(value: Column, sql_type: str = "double") -> Column:
    """NaN → null for floating types. In Spark SQL, NaN equals NaN."""
    if sql_type not in ("float", "double"):
        return value
    return F.nullif(value, F.lit(float("nan")).cast(sql_type))


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating column."""
    value = F.col(f"`{column}`")
    return value.isNull() | F.isnan(value) if dict(df.dtypes)[column] in ("float", "double") else value.isNull()


def yes_no_to_bit(target: Column) -> Column:
    """Yes → 1, No → 0; anything else, null included, raises."""
    return (
        F.when(target == "Yes", F.lit(1))
        .when(target == "No", F.lit(0))
        .otherwise(
            F.raise_error(
                F.concat(F.lit("target outside Yes/No: "), F.coalesce(target, F.lit("null")))
            ).cast("int")
        )
        .cast("tinyint")
    )


def label_column(df: DataFrame, target: str) -> Column:
    """0/1 integer label from a Yes/No or a numeric target column."""
    if dict(df.dtypes)[target] == "string":
        return yes_no_to_bit(F.col(target)).cast("int")
    return F.col(target).cast("int")


def tenure_bucket(tenure: Column) -> Column:
    """Right-closed month ranges; null outside 0..72 and for null."""
    upper, labels = fixed.TENURE_UPPER, fixed.TENURE_LABELS
    branches = F.when(tenure < -1, F.lit(None).cast("string"))
    for bound, label in zip(upper, labels, strict=True):
        branches = branches.when(tenure <= bound, F.lit(label))
    return branches


def services_count(columns: list[str] = fixed.SERVICES) -> Column:
    flags = [F.coalesce((F.col(c) == "Yes").cast("int"), F.lit(0)) for c in columns]
    return reduce(lambda a, b: a + b, flags).cast("tinyint")


def average_spend(total: Column, months: Column) -> Column:
    """Missing totals count as 0 here (the encoder imputes the median instead)."""
    paid = F.coalesce(total.cast("double"), F.lit(0.0))
    return (paid / F.greatest(months.cast("double"), F.lit(1.0))).cast("float")


def spend_gap(monthly: Column, average: Column) -> Column:
    return (monthly.cast("double") - average.cast("double")).cast("float")


def count_below(value: Column, edges: list[Column], inclusive: bool = False) -> Column:
    """How many edges lie below ``value`` (``<=`` if inclusive): a bin index."""
    hits = [(e <= value) if inclusive else (e < value) for e in edges]
    return reduce(lambda a, b: a + b, [h.cast("int") for h in hits], F.lit(0))


def uniform_bin(p: Column, n_bins: int) -> Column:
    """Equal-width bin on [0, 1]; an edge belongs to the bin above, 1.0 to the last."""
    step = 1.0 / n_bins
    return count_below(p, [F.lit(i * step) for i in range(1, n_bins)], inclusive=True)


def order_hash(seed: int, key: Column) -> Column:
    """Reproducible pseudo-random order of keys: md5 of seed and key, as hex."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def decision(p: Column, threshold: Column | float) -> Column:
    return (p >= _col(threshold)).cast("int")


def decision_label(p: Column, threshold: Column | float) -> Column:
    return F.when(p >= _col(threshold), "churn").otherwise("no_churn")


def risk_band(p: Column, threshold: Column | float) -> Column:
    """high from the threshold, medium from half of it, else low."""
    t = _col(threshold)
    return F.when(p >= t, "high").when(p >= t / 2, "medium").otherwise("low")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division with null on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def _col(value: Column | float) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))
