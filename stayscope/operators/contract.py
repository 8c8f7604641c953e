"""Declared contracts: row rules, key uniqueness, schema, and their violations."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayscope.functions import fixed


#: Column of values that did not fit their type.
TYPE_FAULTS = "type_faults"


class ContractError(ValueError):
    """Raised with every violated rule, not only the first."""

    def __init__(self, problems: list[str]) -> None:
        super().__init__("; ".join(problems))
        self.problems = problems


@dataclass(frozen=True)
class Rule:
    """``passes`` is true for good rows; a null result also passes."""

    name: str
    column: str
    passes: Callable[[], Column]


@dataclass(frozen=True)
class Contract:
    key: str
    types: dict[str, str]
    rules: tuple[Rule, ...] = ()
    unique: tuple[str, ...] = ()
    optional: frozenset[str] = field(default_factory=frozenset)


def in_domain(column: str, values: Sequence) -> Rule:
    return Rule("domain", column, lambda: F.col(column).isin(list(values)))


def matches(column: str, pattern: str) -> Rule:
    return Rule("pattern", column, lambda: F.col(column).rlike(pattern))


def in_range(column: str, low: float, high: float) -> Rule:
    return Rule("range", column, lambda: F.col(column).between(low, high))


def at_least(column: str, low: float) -> Rule:
    return Rule("minimum", column, lambda: F.col(column) >= low)


def fitted_ranges(bounds: DataFrame) -> list[Rule]:
    """Outlier rules from a stored table (column, low, high) of a few rows; empty bounds impose nothing."""
    rows = bounds.select("column", "low", "high").orderBy("column").collect()
    return [
        Rule("outlier", r["column"], lambda r=r: F.col(r["column"]).between(r["low"], r["high"]))
        for r in rows if r["low"] is not None
    ]


def not_null(column: str) -> Rule:
    return Rule("not_null", column, lambda: F.col(column).isNotNull())


def implies(name: str, column: str, when: Callable[[], Column], then: Callable[[], Column]) -> Rule:
    """If ``when`` holds, ``then`` must; an unknown ``when`` imposes nothing."""
    return Rule(name, column, lambda: ~F.coalesce(when(), F.lit(False)) | then())


def _failed(rule: Rule) -> Column:
    return ~F.coalesce(rule.passes(), F.lit(True))


def _any_failed(contract: Contract) -> Column:
    return reduce(lambda a, b: a | b, [_failed(r) for r in contract.rules], F.lit(False))


def _failures(contract: Contract) -> Column:
    return F.array_compact(
        F.array(
            *[
                F.when(
                    _failed(r),
                    F.struct(
                        F.lit(r.name).alias("rule"),
                        F.lit(r.column).alias("column"),
                        F.col(r.column).cast("string").alias("value"),
                    ),
                )
                for r in contract.rules
            ]
        )
    )


def schema_problems(df: DataFrame, contract: Contract) -> list[str]:
    """Missing, unexpected and mistyped columns, seen on the plan (no job)."""
    actual = dict(df.dtypes)
    problems = [
        f"missing column {c}"
        for c in contract.types
        if c not in actual and c not in contract.optional
    ]
    problems += [f"unexpected column {c}" for c in actual if c not in contract.types]
    problems += [
        f"column {c} is {actual[c]}, expected {t}"
        for c, t in contract.types.items()
        if c in actual and actual[c] != t
    ]
    return problems


def row_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per failed row rule: (rule, column, key, value, n_rows = 1).

    One narrow pass. Good rows leave at the filter, before any struct is built.
    """
    if not contract.rules:
        raise ValueError("contract has no row rules")
    return (
        df.filter(_any_failed(contract))
        .select(F.col(contract.key).cast("string").alias("key"), F.explode(_failures(contract)))
        .select("col.rule", "col.column", "key", "col.value", F.lit(1).cast("long").alias("n_rows"))
    )


def key_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per repeated key with its number of rows.

    The count is combined before the shuffle, so one key on a third of all rows
    is one row per task; nothing is joined back.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in columns]
    key = F.concat_ws("|", *parts)
    return (
        df.groupBy(*columns)
        .agg(F.count("*").alias("n_rows"))
        .filter(F.col("n_rows") > 1)
        .select(
            F.lit("unique").alias("rule"),
            F.lit(",".join(columns)).alias("column"),
            key.alias("key"),
            key.alias("value"),
            "n_rows",
        )
    )


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """All violations of row rules and of key uniqueness."""
    found = row_violations(df, contract)
    if contract.unique:
        found = found.unionByName(key_violations(df, contract.unique))
    return found


def assert_valid(df: DataFrame, contract: Contract, unique: bool = True) -> DataFrame:
    """Return ``df`` if it keeps the contract, else raise with all broken rules.

    Only per-rule counts reach the driver.
    """
    problems = schema_problems(df, contract)
    if problems:
        raise ContractError(problems)
    found = violations(df, contract) if unique else row_violations(df, contract)
    counts = (
        found.groupBy("rule", "column")
        .agg(F.sum("n_rows").alias("n_rows"), F.min("value").alias("example"))
        .orderBy("rule", "column")
        .collect()
    )
    if counts:
        raise ContractError(
            [f"{r['rule']}({r['column']}): {r['n_rows']} rows, e.g. {r['example']}" for r in counts]
        )
    return df


def mark_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Add ``violations``: the array of failed row rules, empty for good rows."""
    return df.withColumn(
        "violations",
        F.when(_any_failed(contract), _failures(contract)).otherwise(
            F.array().cast("array<struct<rule:string,column:string,value:string>>")
        ),
    )


def separate(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their violations). Works on streams.

    Values that did not fit their type (``type_faults`` of the rows to score) count
    as violations of the rule ``type``.
    """
    marked = mark_violations(df, contract)
    if TYPE_FAULTS in df.columns:
        marked = marked.withColumn("violations", F.concat(TYPE_FAULTS, "violations")).drop(TYPE_FAULTS)
    good = marked.filter(F.size("violations") == 0).drop("violations")
    return good, marked.filter(F.size("violations") > 0)


def require_rows(df: DataFrame) -> DataFrame:
    """Raise on an empty batch; reads at most one row."""
    if df.isEmpty():
        raise ContractError(["empty batch"])
    return df


def check_threshold(threshold: float) -> float:
    if not 0.0 < float(threshold) < 1.0:
        raise ValueError(f"threshold must lie in (0, 1), got {threshold}")
    return float(threshold)


def _domains() -> dict[str, list]:
    return {
        "gender": fixed.GENDERS,
        "SeniorCitizen": [0, 1],
        "Partner": fixed.YES_NO,
        "Dependents": fixed.YES_NO,
        "PhoneService": fixed.YES_NO,
        "MultipleLines": fixed.LINES,
        "InternetService": fixed.INTERNET,
        **{a: fixed.ADDON_STATES for a in fixed.ADDONS},
        "Contract": fixed.CONTRACTS,
        "PaperlessBilling": fixed.YES_NO,
        "PaymentMethod": fixed.PAYMENT_METHODS,
    }


def _types() -> dict[str, str]:
    return {c: fixed.NUMERIC_TYPES.get(c, "string") for c in fixed.RAW_COLUMNS}


def _no_phone_lines() -> Rule:
    return implies(
        "phone_lines",
        "MultipleLines",
        lambda: F.col("PhoneService") == "No",
        lambda: F.col("MultipleLines").eqNullSafe("No phone service"),
    )


def _no_internet_addons() -> Rule:
    return implies(
        "internet_addons",
        "InternetService",
        lambda: F.col("InternetService") == "No",
        lambda: reduce(
            lambda a, b: a & b, [F.col(a).eqNullSafe("No internet service") for a in fixed.ADDONS]
        ),
    )


def training_contract() -> Contract:
    """Contract of the cast 21-column table."""
    domains = {**_domains(), fixed.TARGET: fixed.YES_NO}
    rules = [
        matches(fixed.KEY, fixed.KEY_PATTERN),
        *[in_domain(c, v) for c, v in domains.items()],
        in_range("tenure", 0, 72),
        at_least("MonthlyCharges", 0.0),
        at_least("TotalCharges", 0.0),
        *[not_null(c) for c in fixed.RAW_COLUMNS if c != "TotalCharges"],
        _no_phone_lines(),
        _no_internet_addons(),
    ]
    return Contract(fixed.KEY, _types(), tuple(rules), (fixed.KEY,))


def scoring_contract() -> Contract:
    """Stricter contract of rows to score: no target, both rule directions."""
    types = {c: t for c, t in _types().items() if c != fixed.TARGET}
    rules = [
        *[in_domain(c, v) for c, v in _domains().items()],
        in_range("tenure", 0, 72),
        at_least("MonthlyCharges", 0.0),
        at_least("TotalCharges", 0.0),
        *[not_null(c) for c in types if c not in (fixed.KEY, "TotalCharges")],
        _no_phone_lines(),
        implies(
            "phone_lines_reverse",
            "MultipleLines",
            lambda: F.col("PhoneService") == "Yes",
            lambda: F.col("MultipleLines") != "No phone service",
        ),
        _no_internet_addons(),
        implies(
            "internet_addons_reverse",
            "InternetService",
            lambda: F.col("InternetService") != "No",
            lambda: ~reduce(
                lambda a, b: a | b, [F.col(a) == "No internet service" for a in fixed.ADDONS]
            ),
        ),
    ]
    return Contract(fixed.KEY, types, tuple(rules), (), frozenset({fixed.KEY, "SeniorCitizen"}))


def raw_schema(columns: Sequence[str] = fixed.RAW_COLUMNS) -> T.StructType:
    """All-string schema for landed text files."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
