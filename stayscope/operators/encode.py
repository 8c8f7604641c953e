"""Leak-free encoder: fitted on the training rows, applied as one projection.

The fitted state is a few numbers per numeric column. It turns into a
``SQLTransformer``, so a saved pipeline needs no Python class to load and the
encoding of a row is plain generated code.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.functions import fixed
from stayscope.functions.columns import no_nan, require_columns
from stayscope.operators.ordering import exact_percentiles


@dataclass(frozen=True)
class EncoderSpec:
    """Column blocks in output order: numeric, ordinal, binary, one-hot."""

    numeric: tuple[str, ...]
    ordinal: dict[str, Sequence] = field(default_factory=dict)
    binary: dict[str, Sequence] = field(default_factory=dict)
    nominal: dict[str, Sequence] = field(default_factory=dict)

    @property
    def inputs(self) -> list[str]:
        return [*self.numeric, *self.ordinal, *self.binary, *self.nominal]

    @property
    def outputs(self) -> list[str]:
        return [
            *self.numeric,
            *self.ordinal,
            *self.binary,
            *[f"{c}_{v}" for c, values in self.nominal.items() for v in values[1:]],
        ]

    @property
    def discrete(self) -> list[str]:
        return self.outputs[len(self.numeric):]


def account_spec(include_derived: bool = True) -> EncoderSpec:
    """The subscriber encoder: 35 outputs, 28 without the derived columns."""
    if not include_derived:
        return EncoderSpec(tuple(fixed.NUMERIC), fixed.ORDINAL, fixed.BINARY, fixed.NOMINAL)
    return EncoderSpec(
        (*fixed.NUMERIC, *fixed.DERIVED_NUMERIC),
        {**fixed.ORDINAL, **fixed.DERIVED_ORDINAL},
        {**fixed.BINARY, **{c: [False, True] for c in fixed.DERIVED_FLAGS}},
        fixed.NOMINAL,
    )


@dataclass(frozen=True)
class Encoder:
    """Fitted encoder: median, mean and population deviation per numeric column."""

    spec: EncoderSpec
    medians: dict[str, float]
    means: dict[str, float]
    deviations: dict[str, float]

    def statement(self, keep: Sequence[str] = ()) -> str:
        """SQL of the encoding over ``__THIS__``; ``keep`` columns pass through."""
        items = [_name(c) for c in keep]
        for c in self.spec.numeric:
            value = f"CAST({_name(c)} AS DOUBLE)"
            filled = f"coalesce(nanvl({value}, NULL), {self.medians[c]!r}D)"
            items.append(
                f"CAST(({filled} - {self.means[c]!r}D) / {self.deviations[c]!r}D AS FLOAT)"
                f" AS {_name(c)}"
            )
        for block in (self.spec.ordinal, self.spec.binary):
            for c, levels in block.items():
                cases = " ".join(
                    f"WHEN {_literal(v)} THEN {i}" for i, v in enumerate(levels)
                )
                items.append(f"CAST(CASE {_name(c)} {cases} ELSE -1 END AS FLOAT) AS {_name(c)}")
        for c, levels in self.spec.nominal.items():
            for v in levels[1:]:
                items.append(
                    f"CAST(CASE WHEN {_name(c)} = {_literal(v)} THEN 1 ELSE 0 END AS FLOAT)"
                    f" AS {_name(f'{c}_{v}')}"
                )
        return f"SELECT {', '.join(items)} FROM __THIS__"

    def stage(self, keep: Sequence[str] = ()) -> SQLTransformer:
        return SQLTransformer(statement=self.statement(keep))

    def encode(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        require_columns(df, [*keep, *self.spec.inputs])
        return self.stage(keep).transform(df)


def fit_encoder(train: DataFrame, spec: EncoderSpec) -> Encoder:
    """Medians first, then mean and deviation of the filled values: two jobs."""
    require_columns(train, spec.inputs)
    columns = list(spec.numeric)
    medians = {
        r["variable"]: r["q"][0]
        for r in exact_percentiles(train, columns, [0.5]).collect()
    }
    without = [c for c in columns if medians.get(c) is None]
    if without:
        raise ValueError(f"no value to fit on in columns {without}")
    filled = [
        F.coalesce(no_nan(F.col(f"`{c}`").cast("double")), F.lit(medians[c])) for c in columns
    ]
    row = train.agg(
        *[F.avg(v).alias(f"m{i}") for i, v in enumerate(filled)],
        *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(filled)],
    ).first()
    return Encoder(
        spec,
        medians,
        {c: row[f"m{i}"] for i, c in enumerate(columns)},
        # A constant column is only centred.
        {c: row[f"s{i}"] or 1.0 for i, c in enumerate(columns)},
    )


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _literal(value) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
