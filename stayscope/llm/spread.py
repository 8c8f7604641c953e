"""Joins of rows with a key that may hold much of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most keys that are joined by broadcast.
HOT_KEYS = 1_000


def spread_join(left: DataFrame, right: DataFrame, on: str, weight: str, total: int | None = None) -> DataFrame:
    """Inner join on a key that is unique in ``right``, whose ``weight`` says how many rows of
    ``left`` have it (``total`` their sum, if known).

    Keys with more than one in ``HOT_KEYS`` of all rows are broadcast: by that very count there
    are fewer than ``HOT_KEYS`` of them. No task gets more than that share of the rows from one other key.
    """
    if total is None:
        total = right.agg(F.sum(weight)).first()[0] or 0
    limit = -(-total // HOT_KEYS)
    hot = right.filter(F.col(weight) > limit)
    if hot.isEmpty():
        return left.join(right, on)
    hot = F.broadcast(hot)
    rest = left.join(hot.select(on), on, "left_anti").join(right.filter(F.col(weight) <= limit), on)
    return left.join(hot, on).unionByName(rest)
