"""Nearest neighbours by a forest of sorted hash strings.

Every tree gives a vector a string of sign bits of random projections; a tree is
the sorted array of its strings. A query descends each tree to the longest prefix
it shares with any row, then all trees ascend together, one prefix bit at a time,
until enough candidates are matched; the candidates are then scored exactly.

Rows are dealt into shards by a hash of their key, and a shard's forest is one
row of the index: vectors, sorted strings and their order. No shard grows with
the table or with rows that are alike. Queries come in blocks, each of which
meets every shard; a shard answers with its nearest rows and Spark merges them.
Pairs of shard and block are made where they are searched, by a task for one
shard and some blocks: none is shuffled, stored or sent to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayscope.session import cut_lineage

#: Rows of a shard and queries of a block, on average. A pair of them takes seconds to search; some 12 MB are
#: handed to Python for it.
SHARD_ROWS, BLOCK_ROWS = 8_192, 4_096

#: Tasks of the search beyond which one takes several blocks, as the driver keeps a note of every task.
SEARCH_TASKS = 20_000

#: Queries whose ranges and products are held at once, and the most by which a product of matrices
#: may miss a cosine (it does by less than 1e-13).
AT_ONCE, ROUNDING = 128, 1e-9

TREES, BITS, SEED = 64, 24, 7

#: Matches at which the trees stop ascending, summed over all trees, as a multiple
#: of the rows of the shard. Vectors without any cluster need about this much for
#: nine in ten true neighbours; clustered ones need far less.
ENOUGH = 0.9

INDEX = "ids binary, vectors binary, strings binary, places binary"


def usable(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """Key and vector of the rows that take part, and the number of components.

    Null keys and vectors, zero vectors, null or non-finite components, and vectors
    whose length is not the most frequent one (the greater of equals) take no part.
    Of rows with one key, the least vector in component order counts.
    """
    x = F.col("v")
    good = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter(
        F.col("id").isNotNull() & F.coalesce(
            F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(x, lambda c: c != 0), F.lit(False),
        )
    )
    size = good.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    width = size[0] if size else 0
    return good.filter(F.size("v") == width).groupBy("id").agg(F.min("v").alias("v")), width


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Every vector times a power of two that brings its greatest component near one: exact, and without
    overflow or underflow in what follows. Cosines do not change."""
    if not vectors.size:
        return vectors
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1, keepdims=True))[1])


def planes(width: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((width, TREES * BITS))


def hash_strings(vectors: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Tree by row: the first projection is the first (highest) bit of the string."""
    bits = (vectors @ directions > 0).reshape(len(vectors), TREES, BITS)
    return (bits @ (1 << np.arange(BITS - 1, -1, -1))).astype(np.uint32).T.copy()


def build_index(rows: DataFrame, width: int, shards: int) -> DataFrame:
    """One row per shard with its forest, each in a partition of its own."""

    def build(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        vectors = scaled(np.array(frame["v"].tolist(), float).reshape(-1, width))
        strings = hash_strings(vectors, planes(width))
        places = np.argsort(strings, axis=1, kind="stable").astype(np.uint32)
        return pd.DataFrame({
            "ids": [frame["id"].to_numpy(np.int64).tobytes()], "vectors": [vectors.tobytes()],
            "strings": [np.take_along_axis(strings, places.astype(np.int64), 1).tobytes()], "places": [places.tobytes()],
        })

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(build, INDEX).repartition(shards)


def prefix_ranges(queries: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the strings that share 0, 1, … ``BITS`` bits with a query begin and end, by query, tree and bits."""
    span = np.uint64(1) << np.arange(BITS, -1, -1).astype(np.uint64)
    low = np.empty((queries.shape[1], len(strings), BITS + 1), np.int64)
    high = np.empty_like(low)
    for t, (own, ordered) in enumerate(zip(queries, strings, strict=True)):
        base = own.astype(np.uint64)[:, None] // span * span
        low[:, t] = np.searchsorted(ordered, base.astype(np.uint32), "left")
        high[:, t] = np.searchsorted(ordered, (base + span - np.uint64(1)).astype(np.uint32), "right")
    return low, high


def matched_rows(low: np.ndarray, high: np.ndarray, places: np.ndarray, wanted: float, least: int) -> np.ndarray:
    """Mask of the rows matched by one query, from its ranges by tree and bits.

    All trees ascend together, in order within a level, until ``wanted`` matches; from matches of fewer
    than ``least`` different rows they ascend on, with a new count.
    """
    trees, n = places.shape
    matched = high - low
    total_at = np.append(matched.sum(0), 0)
    # no tree stops before the first level with enough matches of all trees
    level = max(0, int((total_at[:-1] >= wanted).sum()) - 1)
    total, reached = int(total_at[level + 1]), np.full(trees, level + 1)

    def mask() -> np.ndarray:
        out = np.zeros(n, bool)
        own = np.flatnonzero(reached <= BITS)
        for t, first, end in zip(own.tolist(), low[own, reached[own]].tolist(), high[own, reached[own]].tolist(), strict=True):
            out[places[t, first:end]] = True
        return out

    while level >= 0:
        more = matched[:, level] - (matched[:, level + 1] if level < BITS else 0)
        ascends = (more > 0) & ((level == BITS) | (total + np.cumsum(more) - more < wanted))
        reached[ascends] = level
        total += int(more[ascends].sum())
        if total >= wanted:
            out = mask()
            if not level or out.sum() >= least:
                return out
            total = 0  # enough matches but too few different rows: ascend on
        level -= 1
    return mask()


def candidates(query: np.ndarray, strings: np.ndarray, places: np.ndarray, wanted: float, least: int) -> np.ndarray:
    """Mask of the rows matched by one query (its string per tree)."""
    low, high = prefix_ranges(query[:, None], strings)
    return matched_rows(low[0], high[0], places, wanted, least)


def best_of_shard(
    own: np.ndarray, some: np.ndarray, hashed: np.ndarray, ids: np.ndarray, all_: np.ndarray, strings: np.ndarray, places: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, row and score of the ``k`` best candidates of every query of a block in one shard.

    A product of matrices leaves out all candidates that cannot be among the ``k`` best; only the others
    are scored one by one, so that equal vectors get equal scores.
    """
    lengths = np.sqrt((all_ * all_).sum(1))
    unit = (all_ / lengths[:, None]).T
    out = []
    for start in range(0, len(own), AT_ONCE):
        now = range(start, min(start + AT_ONCE, len(own)))
        low, high = prefix_ranges(hashed[:, now.start:now.stop], strings)
        for i, near, first, end in zip(now, some[now.start:now.stop] @ unit, low, high, strict=True):
            mask = matched_rows(first, end, places, ENOUGH * len(ids), k + 1)
            found = np.flatnonzero(mask & (ids != own[i]))
            q = some[i]
            length = np.sqrt((q * q).sum())
            if len(found) > k:
                close = near[found]
                found = found[close >= np.partition(close, -k)[-k] - ROUNDING * length]
            score = (all_[found] * q).sum(1) / (lengths[found] * length)
            best = np.lexsort((ids[found], -score))[:k]
            out.append((np.full(len(best), own[i]), ids[found[best]], score[best]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows found for every query, by cosine in double precision.

    ``queries`` has the columns of ``vectors``. Returns ``query_id``, ``rank`` (from
    1), ``vec_id`` and ``score``; ties go to the smaller key, a query's own key is
    left out, and queries with fewer than ``k`` other rows get all of them. Which
    rows take part is told by :func:`usable`; other columns are not read.
    """
    rows, width = usable(vectors, key, vector)
    rows = cut_lineage(rows)
    asked, _ = usable(queries, key, vector)
    asked = cut_lineage(asked.filter(F.size("v") == width))
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    index = build_index(rows, width, shards)

    def block(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        wanted = scaled(np.array(frame["v"].tolist(), float).reshape(-1, width))
        return pd.DataFrame({
            "asked": [frame["id"].to_numpy(np.int64).tobytes()], "wanted": [wanted.tobytes()],
            "hashed": [hash_strings(wanted, planes(width)).tobytes()],
        })

    dealt = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    sent = dealt.groupBy("block").applyInPandas(block, "asked binary, wanted binary, hashed binary").repartition(
        min(blocks, max(1, SEARCH_TASKS // shards))
    )

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, some, hashed, ids, all_, strings, places = (
                    np.frombuffer(batch.column(name)[i].as_buffer(), kind)
                    for name, kind in (("asked", np.int64), ("wanted", float), ("hashed", np.uint32), ("ids", np.int64),
                                       ("vectors", float), ("strings", np.uint32), ("places", np.uint32))
                )
                asked_id, found_id, score = best_of_shard(
                    own, some.reshape(-1, width), hashed.reshape(TREES, -1), ids, all_.reshape(-1, width),
                    strings.reshape(TREES, -1), places.reshape(TREES, -1), k,
                )
                yield pa.RecordBatch.from_arrays([pa.array(asked_id), pa.array(found_id), pa.array(score)], names=["query_id", "vec_id", "score"])

    met = index.hint("shuffle_replicate_nl").crossJoin(sent)
    scored = met.mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
