"""Canonical cast of raw text rows and the derived retention features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.functions import columns as C
from stayscope.functions import fixed
from stayscope.operators.contract import TYPE_FAULTS, ContractError


def cast_accounts(df: DataFrame) -> DataFrame:
    """All-text rows → contract types. Blank totals become null, garbage raises."""
    C.require_columns(df, [c for c in fixed.RAW_COLUMNS if c != fixed.TARGET])
    types = fixed.NUMERIC_TYPES
    return df.select(
        *[
            (C.strict_number(F.col(c), types[c]) if c in types else F.col(c)).alias(c)
            for c in df.columns
        ]
    )


def scoring_rows(df: DataFrame) -> DataFrame:
    """Typed rows to score: optional key and senior flag filled in, target not needed.

    Fields outside the contract raise. A number that does not fit its type becomes
    null and is listed in ``type_faults`` (added only if a column has another type
    than the contract's), which :func:`stayscope.operators.contract.separate` turns
    into a broken rule of that row, so one bad value never stops a batch.
    """
    wanted = [c for c in fixed.RAW_COLUMNS if c != fixed.TARGET]
    unknown = [c for c in df.columns if c not in (*wanted, TYPE_FAULTS)]
    if unknown:
        raise ContractError([f"unexpected column {c}" for c in unknown])
    out = df
    if fixed.KEY not in df.columns:
        out = out.withColumn(fixed.KEY, F.lit(None).cast("string"))
    if "SeniorCitizen" not in df.columns:
        out = out.withColumn("SeniorCitizen", F.lit(0).cast("tinyint"))
    C.require_columns(out, wanted)
    types = fixed.NUMERIC_TYPES
    held = dict(out.dtypes)
    doubtful = [c for c in wanted if c in types and held[c] != types[c]]
    faults = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
                    & F.col(c).try_cast(types[c]).isNull(),
                    F.struct(
                        F.lit("type").alias("rule"),
                        F.lit(c).alias("column"),
                        F.col(c).cast("string").alias("value"),
                    ),
                )
                for c in doubtful
            ]
        )
    )
    kept = [TYPE_FAULTS] if TYPE_FAULTS in held else [faults.alias(TYPE_FAULTS)] if doubtful else []
    return out.select(
        *[
            C.no_nan(F.col(c).try_cast(types.get(c, "string")), types.get(c, "string")).alias(c)
            for c in wanted
        ],
        *kept,
    )


def derive_features(df: DataFrame) -> DataFrame:
    """Append the seven derived columns; one narrow projection."""
    C.require_columns(
        df,
        ["tenure", "InternetService", "PaymentMethod", "MonthlyCharges", "TotalCharges",
         *fixed.SERVICES],
    )
    return df.select("*", *derived_columns()).withColumn(
        "monthly_spend_gap", C.spend_gap(F.col("MonthlyCharges"), F.col("avg_monthly_spend"))
    )


def derived_columns() -> list:
    return [
        C.tenure_bucket(F.col("tenure")).alias("tenure_bucket"),
        C.services_count().alias("services_count"),
        F.coalesce(F.col("InternetService") != "No", F.lit(True)).alias("has_internet"),
        F.coalesce(F.col("PhoneService") == "Yes", F.lit(False)).alias("has_phone"),
        F.coalesce(F.col("PaymentMethod").isin(fixed.AUTOMATIC_PAYMENTS), F.lit(False)).alias(
            "auto_payment"
        ),
        C.average_spend(F.col("TotalCharges"), F.col("tenure")).alias("avg_monthly_spend"),
    ]


def keep_features(df: DataFrame, features: Sequence[str], others: Sequence[str]) -> DataFrame:
    """Restrict a matrix to a feature subset; unknown names raise."""
    C.require_columns(df, [*features, *others])
    return df.select(*[f"`{c}`" for c in [*others, *features]])


def with_missing_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``was_<column>_missing`` (0/1), to be set before values are imputed."""
    C.require_columns(df, list(columns))
    return df.withColumns({f"was_{c}_missing": C.is_missing(df, c).cast("tinyint") for c in columns})
