"""As-of joins: to every event the last fact of its key before it, however many rows a key has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayscope.operators.ordering import match_keys
from stayscope.session import cut_lineage


def last_before(
    events: DataFrame,
    facts: DataFrame,
    key: str,
    event_time: str,
    fact_time: str,
    columns: Sequence[str],
) -> DataFrame:
    """``events`` with ``columns`` of the last fact of the same key strictly before the event's time.

    Facts at one time count in the order of ``columns``, the greatest last. An event without
    an earlier fact, without key or without time gets nulls; facts without key or time
    are not read. Events and facts are put into one order by ranges of key and time, no
    pair of them is made, and a key that fills several ranges takes the last fact of the
    ranges before from one row per range.
    """
    asked = events.select(
        F.col(key).alias("_key"), F.col(event_time).alias("_time"), F.lit(0).alias("_kind"),
        F.lit(None).cast(facts.select(F.struct(*columns)).schema[0].dataType).alias("_fact"),
        F.struct(*[F.col(f"`{c}`") for c in events.columns]).alias("_event"),
    )
    known = facts.filter(F.col(key).isNotNull() & F.col(fact_time).isNotNull()).select(
        F.col(key).alias("_key"), F.col(fact_time).alias("_time"), F.lit(1).alias("_kind"),
        F.struct(*columns).alias("_fact"), F.lit(None).cast(asked.schema["_event"].dataType).alias("_event"),
    )
    order = ["_key", "_time", "_kind", "_fact"]
    ordered = asked.unionByName(known).repartitionByRange(*order).sortWithinPartitions(*order)
    stored = cut_lineage(ordered.select(
        "_key", "_fact", "_event", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_row"),
    ))
    last = F.max(F.when(F.col("_fact").isNotNull(), F.struct("_row", "_fact")))["_fact"]
    earlier = W.partitionBy("_key").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = stored.groupBy("_key", "_range").agg(last.alias("_last")).select(
        "_key", "_range", F.last("_last", ignorenulls=True).over(earlier).alias("_carried")
    ).filter(F.col("_carried").isNotNull())
    inside = W.partitionBy("_key", "_range").orderBy("_row").rowsBetween(W.unboundedPreceding, W.currentRow)
    local = stored.withColumn("_fact", F.last("_fact", ignorenulls=True).over(inside)).filter(F.col("_event").isNotNull())
    found = F.coalesce("_fact", "_carried")
    joined = match_keys(local, carried, ["_key", "_range"], "left").select("_event", found.alias("_fact"))
    return joined.select(
        *[F.col("_event").getField(c).alias(c) for c in events.columns if c not in columns],
        *[F.col("_fact").getField(c).alias(c) for c in columns],
    )
