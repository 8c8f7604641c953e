"""Sharding along a Hilbert curve over quantised metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayscope.session import cut_lineage

#: Levels per dimension are two to this power, so three dimensions have at most
#: 32,768 cells: the bound of the table that is broadcast.
BITS = 5

#: Rows that an ordered group of a cell holds on average.
GROUP_ROWS = 500


def order_code(column: Column, kind: str) -> Column:
    """A whole number that keeps the order of the values.

    Text: its first six bytes. Numbers: the value cut to a whole number. Null stays null.
    """
    if kind == "string":
        head = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("long")
    return column.cast("long")


def size_class(size: Column) -> Column:
    """Number of binary digits of a size."""
    return F.length(F.bin(size)).cast("long")


def level(code: Column, low: int | None, high: int | None, bits: int) -> Column:
    """Equal steps between the least and the greatest code; null is level 0."""
    if low is None:
        return F.lit(0)
    steps = 2**bits - 2
    step = F.floor((code - low) * F.lit(steps) / F.lit(max(1, high - low))).cast("int")
    return F.when(code.isNull(), F.lit(0)).otherwise(1 + step)


def hilbert_index(levels: Column, dims: int, bits: int) -> Column:
    """Position on the curve of a point given as an array of levels.

    The point is turned bit by bit, highest first, into its transposed index
    (Skilling, 2004), whose Gray code is then undone and interleaved.
    """
    steps = F.array(*[
        F.struct(F.lit(1 << b).alias("q"), F.lit(d).alias("d")) for b in range(bits - 1, 0, -1) for d in range(dims)
    ])

    def turn(x: Column, step: Column) -> Column:
        own, first, low = F.get(x, step["d"]), F.get(x, F.lit(0)), step["q"] - 1
        inverts = own.bitwiseAND(step["q"]) != 0
        swapped = first.bitwiseXOR(own).bitwiseAND(low)
        return F.transform(x, lambda v, i: F.when(
            inverts, F.when(i == 0, v.bitwiseXOR(low)).otherwise(v),
        ).when((i == 0) | (i == step["d"]), F.when(step["d"] == 0, v).otherwise(v.bitwiseXOR(swapped))).otherwise(v))

    turned = F.aggregate(steps, levels, turn) if bits > 1 else levels
    ranks = F.sequence(F.lit(0), F.lit(dims - 1))
    gray = F.transform(ranks, lambda i: F.aggregate(
        F.slice(turned, 1, i + 1), F.lit(0), lambda acc, v: acc.bitwiseXOR(v),
    ))
    masks = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)] or [F.lit(2)])
    mend = F.aggregate(masks, F.lit(0), lambda t, q: F.when(
        F.get(gray, F.lit(dims - 1)).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1),
    ).otherwise(t))
    done = F.transform(gray, lambda v: v.bitwiseXOR(mend))
    digits = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(d).alias("d")) for b in range(bits - 1, -1, -1) for d in range(dims)])
    # the point is bound once; every bit of every dimension then adds one digit
    return F.transform(F.array(done), lambda x: F.aggregate(digits, F.lit(0).cast("long"), lambda acc, s: (
        acc * 2 + F.when(F.get(x, s["d"]).bitwiseAND(s["q"]) != 0, 1).otherwise(0)
    )))[0]


def place_in_shards(docs: DataFrame, codes: Sequence[Column], columns: Sequence[str], shards: int, bits: int = BITS) -> DataFrame:
    """Cut the curve order of ``docs`` into ``shards`` runs whose counts differ by one at most.

    ``docs`` is a narrow stored table; ``codes`` are whole numbers made from its
    columns, one per dimension; rows of one cell follow a hash of ``columns``,
    then ``columns``. Adds ``curve``, ``shard`` and ``slot``. Repeated rows are
    counted first and unfolded at the end, so no order has to hold them in one task.
    """
    names = [f"_c{i}" for i in range(len(codes))]
    coded = docs.select(*columns, *[c.alias(n) for c, n in zip(codes, names, strict=True)])
    ends = coded.agg(
        F.count(F.lit(1)).alias("n"), *[f(n).alias(f"{f.__name__}{n}") for n in names for f in (F.min, F.max)]
    ).first()
    levels = [level(F.col(n), ends[f"min{n}"], ends[f"max{n}"], bits) for n in names]
    counted = coded.select(*columns, F.array(*levels).alias("_levels")).groupBy(*columns, "_levels").agg(
        F.count(F.lit(1)).alias("_n")
    )
    counted = cut_lineage(counted)
    along = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    cells = counted.groupBy("_levels").agg(F.sum("_n").alias("_in_cell")).withColumn(
        "curve", hilbert_index(F.col("_levels"), len(names), bits)
    )
    cells = cells.withColumn("_before", F.coalesce(F.sum("_in_cell").over(along), F.lit(0)))
    groups = F.ceil(F.col("_in_cell") / GROUP_ROWS)
    rows = counted.join(F.broadcast(cells), "_levels").withColumn(
        "_group", F.pmod(F.xxhash64(*columns), groups)
    )
    sums = rows.groupBy("curve", "_group").agg(F.sum("_n").alias("_in_group"))
    earlier = Window.partitionBy("curve").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("curve", "_group", F.coalesce(F.sum("_in_group").over(earlier), F.lit(0)).alias("_groups_before"))
    inside = Window.partitionBy("curve", "_group").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_before") + F.col("_groups_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    ranked = rows.join(sums, ["curve", "_group"]).withColumn("_first", first).select(
        *columns, "curve", F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1)).alias("_rank"),
    )
    n = max(1, ends.n)
    shard = F.expr(f"_rank * {shards}L div {n}L")
    return ranked.withColumn("shard", shard.cast("int")).withColumn(
        "slot", F.col("_rank") - F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")
    ).drop("_rank")


def shard_documents(docs: DataFrame, shards: int = 40, bits: int = BITS) -> DataFrame:
    """Shards of ``documents`` (doc_id, text, lang, source) by the law ``rows``.

    Dimensions: language, source, and the binary digits of the size (UTF-8 bytes
    of the text, null none, plus 16). Returns ``doc_id``, ``size``, ``text_crc32``
    (unsigned, null text as empty), ``law``, ``shard``, ``slot``, ``grown_shard``
    (always null under this law), ``lang``, ``source`` and ``curve``. Null
    metadata is a level of its own; rows that are alike in all of these are
    interchangeable. Other columns are not read.
    """
    whole = F.coalesce(F.col("text"), F.lit(""))
    narrow = cut_lineage(docs.select(
        F.col("doc_id"), (F.octet_length(whole) + 16).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
    ))
    columns = ["doc_id", "text_crc32", "size", "lang", "source"]
    codes = [order_code(F.col("lang"), "string"), order_code(F.col("source"), "string"), size_class(F.col("size"))]
    return place_in_shards(narrow, codes, columns, shards, bits).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "lang", "source", "curve",
    )
