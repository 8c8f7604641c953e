"""Exploratory run: four tables and nine chart datasets of the subscriber table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stayscope.functions import fixed
from stayscope.operators import association, profile
from stayscope.sources.tables import write_report

_CATEGORIES = [*fixed.BINARY, *fixed.ORDINAL, *fixed.DERIVED_ORDINAL, *fixed.NOMINAL]


def explore(df: DataFrame, folder: str | None = None) -> dict[str, DataFrame]:
    """Typed rows with derived columns → named tables, written as CSV if asked.

    The rows are persisted while the tables are written; without ``folder`` the
    tables are lazy and the caller decides.
    """
    rows = df.persist() if folder is not None else df
    numeric = fixed.NUMERIC
    report = {
        "numeric_summary": profile.numeric_summary(rows, numeric),
        "categorical_summary": profile.categorical_summary(rows, [*_CATEGORIES, fixed.TARGET]),
        "target_distribution": profile.target_distribution(rows),
        "cramers_v": association.cramers_v(rows, _CATEGORIES),
        "target_chart": profile.target_distribution(rows),
        "missing_values": profile.missing_counts(rows),
        "tenure_histogram": profile.histogram(rows, "tenure"),
        "monthly_charges_histogram": profile.histogram(rows, "MonthlyCharges"),
        "total_charges_box": profile.box_plot(rows, "TotalCharges"),
        "churn_by_contract": profile.rate_chart(rows, "Contract"),
        "churn_by_payment_method": profile.rate_chart(rows, "PaymentMethod"),
        "churn_by_tenure_bucket": profile.rate_chart(rows, "tenure_bucket"),
        "correlation_heatmap": association.lower_triangle(
            association.correlation(rows, [*numeric, *fixed.DERIVED_NUMERIC])
        ).orderBy("i", "j"),
    }
    if folder is not None:
        try:
            for name, table in report.items():
                write_report(table, f"{folder}/{name}")
        finally:
            rows.unpersist()
    return report


def target_correlation(df: DataFrame) -> DataFrame:
    """Pearson matrix of the numeric columns and the target bit."""
    bit = profile.label_column(df, fixed.TARGET)
    return association.correlation(
        df.select(*fixed.NUMERIC, bit.alias("churn_bit")),
        [*fixed.NUMERIC, "churn_bit"],
        "pearson",
    )
