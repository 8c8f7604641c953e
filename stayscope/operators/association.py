"""Correlation and association between columns."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.functions import fixed
from stayscope.functions.columns import no_nan
from stayscope.functions.columns import ratio as _ratio
from stayscope.operators.ordering import running_sums
from stayscope.operators.profile import numeric_columns

METHODS = ("pearson", "spearman", "kendall")


def correlation(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "spearman",
) -> DataFrame:
    """Full square matrix in long form: (variable_a, variable_b, i, j, correlation).

    Each pair uses the rows where both values are present. A pair without
    spread gives null.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    values = df.select(
        *[no_nan(F.col(f"`{c}`").cast("double")).alias(f"c{i}") for i, c in enumerate(columns)]
    )
    if method in ("spearman", "kendall") and len(columns) == 1:
        upper = _diagonal(values, 1)
    elif method == "pearson":
        upper = _pearson(values, len(columns))
    elif method == "spearman":
        upper = _diagonal(values, len(columns)).unionByName(
            _spearman(values, len(columns))
        )
    elif method == "kendall":
        upper = _diagonal(values, len(columns)).unionByName(
            _kendall(values, len(columns))
        )
    else:
        raise ValueError(f"unknown method {method!r}, use one of {METHODS}")
    names = F.array(*[F.lit(c) for c in columns])
    both = F.when(
        F.col("i") == F.col("j"), F.array(F.struct("i", "j", "correlation"))
    ).otherwise(
        F.array(
            F.struct("i", "j", "correlation"),
            F.struct(F.col("j").alias("i"), F.col("i").alias("j"), F.col("correlation")),
        )
    )
    return upper.select(F.inline(both)).select(
        F.get(names, F.col("i")).alias("variable_a"),
        F.get(names, F.col("j")).alias("variable_b"),
        "i",
        "j",
        "correlation",
    )


def lower_triangle(matrix: DataFrame) -> DataFrame:
    """Heat-map cells: one of each symmetric pair, with the diagonal."""
    return matrix.filter(F.col("i") >= F.col("j"))


def _pairs(k: int) -> list[tuple[int, int]]:
    return [(i, i) for i in range(k)] + list(combinations(range(k), 2))


def _pearson(values: DataFrame, k: int) -> DataFrame:
    """All pairs in one aggregate, no unpivot, no shuffle of rows.

    From the sums of squares of complete pairs: corr() itself raises on a
    column without spread when ANSI mode is on.
    """

    def pair(i: int, j: int) -> Column:
        x, y = F.col(f"c{i}"), F.col(f"c{j}")
        spread = F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x))
        return _ratio(F.regr_sxy(y, x), spread)

    cells = [
        F.struct(
            F.lit(i).alias("i"), F.lit(j).alias("j"), pair(i, j).alias("correlation")
        ).alias(f"s{n}")
        for n, (i, j) in enumerate(_pairs(k))
    ]
    return values.agg(*cells).select(F.inline(F.array(*[f"s{n}" for n in range(len(cells))])))


def _diagonal(values: DataFrame, k: int) -> DataFrame:
    """A column agrees with itself unless it has no spread: minimum and maximum tell."""
    cells = [
        F.struct(
            F.lit(i).alias("i"), F.lit(i).alias("j"),
            F.when(F.min(f"c{i}") < F.max(f"c{i}"), F.lit(1.0)).alias("correlation"),
        ).alias(f"s{i}")
        for i in range(k)
    ]
    return values.agg(*cells).select(F.inline(F.array(*[f"s{i}" for i in range(k)])))


def _pair_cells(values: DataFrame, k: int) -> DataFrame:
    """(i, j, x, y, n): equal value pairs of complete rows, counted once."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"), F.lit(j).alias("j"),
                F.col(f"c{i}").alias("x"), F.col(f"c{j}").alias("y"),
            )
            for i, j in combinations(range(k), 2)
        ]
    )
    return (
        values.select(F.inline(pairs)).dropna()
        .groupBy("i", "j", "x", "y").agg(F.count("*").alias("n"))
    )


def _average_ranks(cells: DataFrame, side: str) -> DataFrame:
    """Per pair and value: copies, and the average rank centred on the mean rank."""
    counts = cells.groupBy("i", "j", side).agg(F.sum("n").alias("copies"))
    summed = running_sums(counts, side, ["copies"], ["i", "j"])
    rank = F.col("cum_copies") - (F.col("copies") - 1) / 2.0
    return summed.select(
        "i", "j", side, "copies", F.col("tot_copies").alias("total"),
        (rank - (F.col("tot_copies") + 1) / 2.0).alias(f"r{side}"),
    )


def _attach(cells: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    """Join a per-value lookup to the cells; frequent values do not gather in one task.

    A value on more than a thousandth of a pair's rows is hot. There are fewer
    than a thousand of them per pair, so their lookup rows are broadcast and
    their cells stay where they are; all other values meet by a shuffle.
    """
    is_hot = F.col("copies") * 1000 > F.col("total")
    hot = lookup.filter(is_hot).drop("copies", "total")
    rest = lookup.filter(~is_hot).drop("copies", "total")
    return cells.join(F.broadcast(hot), keys).unionByName(
        cells.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys)
    )


def _spearman(values: DataFrame, k: int) -> DataFrame:
    """Pearson of average ranks, from centred sums over distinct value pairs.

    The sum over y is taken per x before x ranks are joined, so each x is one row.
    """
    cells = _pair_cells(values, k)
    ranks_x = _average_ranks(cells, "x")
    ranks_y = _average_ranks(cells, "y")
    cross = (
        _attach(cells, ranks_y, ["i", "j", "y"])
        .groupBy("i", "j", "x")
        .agg(F.sum(F.col("n") * F.col("ry")).alias("ry"))
        .join(ranks_x, ["i", "j", "x"])
        .groupBy("i", "j")
        .agg(F.sum(F.col("rx") * F.col("ry")).alias("xy"))
    )

    def spread(ranks: DataFrame, side: str) -> DataFrame:
        squares = F.sum(F.col("copies") * F.col(f"r{side}") * F.col(f"r{side}"))
        return ranks.groupBy("i", "j").agg(squares.alias(side * 2))

    return (
        cross.join(spread(ranks_x, "x"), ["i", "j"])
        .join(spread(ranks_y, "y"), ["i", "j"])
        .select("i", "j", _ratio(F.col("xy"), F.sqrt("xx") * F.sqrt("yy")).alias("correlation"))
    )


def _kendall(values: DataFrame, k: int) -> DataFrame:
    """Tau-b without comparing rows with rows.

    Two distinct y positions first differ in exactly one bit. Per bit level and
    shared higher bits, pairs ordered alike in x and y are those where a zero-bit
    row has a smaller x than a one-bit row: a running sum over x. Every row is
    repeated once per bit level, log2 of the distinct y values.
    """
    cells = _pair_cells(values, k)
    values_y = cells.groupBy("i", "j", "y").agg(
        F.sum("n").alias("copies"), F.lit(1).cast("long").alias("one")
    )
    positions = running_sums(
        values_y, "y", ["one", "copies"], ["i", "j"]
    ).select(
        "i", "j", "y", "copies", F.col("tot_copies").alias("total"),
        (F.col("cum_one") - 1).alias("pos"), F.col("tot_one").alias("n_pos"),
    )
    levels = F.sequence(
        F.lit(0), F.ceil(F.log2(F.greatest(F.col("n_pos"), F.lit(2)).cast("double"))).cast("int")
    )
    bits = (
        _attach(cells, positions, ["i", "j", "y"])
        .select("i", "j", "x", "n", "pos", F.explode(levels).alias("level"))
        .select(
            "i", "j", "x", "level",
            F.call_function("shiftright", F.col("pos"), F.col("level") + 1).alias("head"),
            F.when(F.expr("(shiftright(pos, level) & 1) = 0"), F.col("n")).alias("zeros"),
            F.when(F.expr("(shiftright(pos, level) & 1) = 1"), F.col("n")).alias("ones"),
        )
        .groupBy("i", "j", "level", "head", "x")
        .agg(
            F.coalesce(F.sum("zeros"), F.lit(0)).alias("zeros"),
            F.coalesce(F.sum("ones"), F.lit(0)).alias("ones"),
        )
    )
    alike = (
        running_sums(bits, "x", ["zeros"], ["i", "j", "level", "head"])
        .groupBy("i", "j")
        .agg(
            F.sum(
                F.col("ones").cast("double") * (F.col("cum_zeros") - F.col("zeros")).cast("double")
            ).alias("alike")
        )
    )

    def tied(*side: str) -> DataFrame:
        n = F.col("copies").cast("double")
        return (
            cells.groupBy("i", "j", *side).agg(F.sum("n").alias("copies"))
            .groupBy("i", "j")
            .agg(F.sum(n * (n - 1) / 2).alias("ties_" + "".join(side)), F.sum(n).alias("_n"))
        )

    joined = (
        tied("x")
        .join(tied("y").drop("_n"), ["i", "j"])
        .join(tied("x", "y").drop("_n"), ["i", "j"])
        .join(alike, ["i", "j"])
    )
    pairs = F.col("_n") * (F.col("_n") - 1) / 2
    # alike + opposed = pairs - ties_x - ties_y + ties_xy
    balance = F.col("alike") * 2 - (pairs - F.col("ties_x") - F.col("ties_y") + F.col("ties_xy"))
    spread = F.sqrt(pairs - F.col("ties_x")) * F.sqrt(pairs - F.col("ties_y"))
    return joined.select("i", "j", _ratio(balance, spread).alias("correlation"))


def contingency(df: DataFrame, columns: Sequence[str], target: str = fixed.TARGET) -> DataFrame:
    """(variable, value, class, n) for every column; rows with a missing side dropped."""
    text = df.select(
        F.col(target).cast("string").alias("_class"),
        *[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(columns)],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("variable"), F.col(f"c{i}").alias("value"))
            for i, c in enumerate(columns)
        ]
    )
    return (
        text.filter(F.col("_class").isNotNull())
        .select(F.col("_class").alias("class"), F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("variable", "value", "class")
        .agg(F.count("*").alias("n"))
    )


def crosstab(df: DataFrame, column: str, target: str, classes: Sequence[str]) -> DataFrame:
    """Wide contingency table with one count column per given class."""
    cells = contingency(df, [column], target)
    return cells.groupBy("value").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("class") == c, F.col("n"))), F.lit(0)).alias(str(c))
            for c in classes
        ]
    )


def chi_square(cells: DataFrame) -> DataFrame:
    """Pearson chi-square per variable: (variable, total, n_values, n_classes, chi2).

    chi² = n·(Σ o²/(r·c) − 1): absent cells add nothing, so value and class
    levels are never paired up. Class totals join back as a small table and
    value totals stay with their own rows.
    """
    per_class = cells.groupBy("variable", "class").agg(F.sum("n").alias("class_n"))
    per_variable = per_class.groupBy("variable").agg(
        F.sum("class_n").alias("total"), F.count("*").alias("n_classes")
    )
    per_value = cells.groupBy("variable", "value").agg(F.sum("n").alias("value_n"))
    n_values = per_value.groupBy("variable").agg(F.count("*").alias("n_values"))
    share = F.col("n").cast("double") * F.col("n") / (F.col("value_n").cast("double") * F.col("class_n"))
    sums = (
        cells.join(per_value, ["variable", "value"])
        .join(per_class, ["variable", "class"])
        .groupBy("variable")
        .agg(F.sum(share).alias("_share"))
    )
    return sums.join(per_variable, "variable").join(n_values, "variable").select(
        "variable", "total", "n_values", "n_classes",
        (F.col("total") * (F.col("_share") - 1.0)).alias("chi2"),
    )


def cramers_v(df: DataFrame, columns: Sequence[str], target: str = fixed.TARGET) -> DataFrame:
    """Bias-corrected Cramér's V of each column against the target, highest first."""
    n, r, k = (F.col(c).cast("double") for c in ("total", "n_values", "n_classes"))
    less = F.nullif(n - 1, F.lit(0.0))
    phi2 = F.greatest(F.lit(0.0), F.col("chi2") / n - (k - 1) * (r - 1) / less)
    rows = r - (r - 1) * (r - 1) / less
    cols = k - (k - 1) * (k - 1) / less
    room = F.least(cols - 1, rows - 1)
    return (
        chi_square(contingency(df, columns, target))
        .select(
            "variable",
            F.when(room <= 0, F.lit(0.0)).otherwise(F.sqrt(_ratio(phi2, room))).alias("cramers_v"),
        )
        .orderBy(F.desc("cramers_v"), "variable")
    )
