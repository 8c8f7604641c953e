"""Mixing to target weights: rake token weights to marginals, then sample documents."""

from __future__ import annotations

import functools
import warnings
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayscope.llm.bytebpe import byte_encoder, word_parts
from stayscope.llm.spread import spread_join
from stayscope.llm.wordwise import BLANK_RUN, as_texts, blank_words, give_back, run_sums, slices, word_codes
from stayscope.session import cut_lineage, release

#: Topics, hashed word counts they are found in, and rounds of fitting.
TOPICS, WIDTH, TOPIC_ROUNDS = 8, 256, 25

#: Keys, those with the least hash, among which the starting points of the rounds are spread.
START_KEYS = 2_000

#: Word vectors are stored as whole numbers up to this, so that their sums do not
#: depend on the order of the rows.
VECTOR_SCALE = 65_535

#: Most cells (values of source, language and topic that occur together) that are raked on the
#: driver. More stay a table, which is raked to the same end by joins and sums.
CELLS = 200_000

#: Most cells whose probabilities are broadcast to the rows.
SENT_CELLS = 10_000

#: Parts of words whose counts a Python worker keeps, twice.
KEPT_WORDS = 300_000

#: Longest words whose places are found together, and what a byte does to a CRC-32.
PLACED_BYTES = 48
CRC_STEPS = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC_STEPS = np.where(CRC_STEPS & 1, (CRC_STEPS >> 1) ^ np.uint32(0xEDB88320), CRC_STEPS >> 1)

#: Bytes of text that are measured at once.
MEASURED_BYTES = 4_000_000

#: Vectors multiplied with the centres at once.
SUMMED_ROWS = 2_000

#: The fitting of topics ends when no centre moves further than this.
TOPIC_STEP = 1e-3

#: Default targets: shares to this power, so that small sources gain.
TEMPER = 0.7

#: Share of all tokens that the sample is expected to hold.
KEPT_SHARE = 0.5

ROUNDS, TOLERANCE = 200, 1e-10

#: The same for raking with probabilities of at most 1, and the halvings of the range in
#: which the greatest share of tokens that meets all targets is searched.
BOUND_ROUNDS, BOUND_TOLERANCE, SHARE_STEPS = 1_000, 1e-7, 8

#: A target missed by more than this share of the tokens is told.
TOLD_GAP = 1e-3

DIMENSIONS = ("source", "lang", "topic")


def word_places(words: Sequence[str]) -> np.ndarray:
    """Place of each word in a vector; behind all places for blank ones."""
    bare = [w.strip().lower() for w in words]
    return np.fromiter((zlib.crc32(w.encode()) % WIDTH if w else WIDTH for w in bare), np.int64, len(bare))


def vectors_of(places: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Counts of the places of each text, square-rooted, of unit length (zero if empty)."""
    flat = np.repeat(np.arange(len(per_text)) * (WIDTH + 1), per_text)
    flat += places
    flat = np.bincount(flat, minlength=len(per_text) * (WIDTH + 1))
    vectors = np.sqrt(flat.reshape(-1, WIDTH + 1)[:, :WIDTH])
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def word_vectors(texts: pa.Array) -> np.ndarray:
    """Hashed counts of lower-case words, square-rooted, of unit length (zero if empty)."""
    words, codes, per_text = word_codes(texts)
    return vectors_of(word_places(words)[codes], per_text)


def places_of(words: pa.Array) -> np.ndarray:
    """``word_places`` of an array of large strings; those in ASCII and U+00C0 to U+00FF are all done at once."""
    if not len(words):
        return np.zeros(0, np.int64)
    _, borders, data = words.buffers()
    borders = np.frombuffer(borders, np.int64, len(words) + 1, 8 * words.offset)
    low = borders[0]
    found = np.frombuffer(b"" if data is None else data, np.uint8)[low:borders[-1]]
    starts, ends = borders[:-1] - low, borders[1:] - low
    other = np.concatenate(([0], np.cumsum((found >= 0xC0) & (found != 0xC3))))
    lower = found + np.uint8(32) * ((found >= 65) & (found <= 90))
    high = np.flatnonzero(found[:-1] == 0xC3) + 1
    lower[high] += np.uint8(32) * ((found[high] < 0x9F) & (found[high] != 0x97))
    padded = np.append(lower, np.uint8(0))
    starts = starts + ((ends > starts) & (padded[starts] == 32))
    empty = ends <= starts
    slow = (other[ends] > other[borders[:-1] - low]) | (ends - starts > PLACED_BYTES)
    slow |= ~empty & ((padded[starts] < 33) | (padded[ends - 1] < 33))
    sums, rest = np.full(len(words), 0xFFFFFFFF, np.uint32), np.flatnonzero(~slow & ~empty)
    at, left = starts[rest], (ends - starts)[rest]
    order = np.argsort(-left, kind="stable")
    rest, at, left = rest[order], at[order], left[order]
    held = sums[rest]
    for k in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -k, "left"))  # words longer than k
        now = held[:n]
        held[:n] = CRC_STEPS[(now ^ lower[at[:n] + k]) & 0xFF] ^ (now >> 8)
    sums[rest] = held
    places = (~sums).astype(np.int64) % WIDTH
    places[empty] = WIDTH
    behind = np.flatnonzero(slow)
    places[behind] = word_places(words.take(pa.array(behind)).to_pylist())
    return places


class WordTable:
    """Number of ids of the parts of words met so far by a Python worker.

    The newest ``KEPT_WORDS`` are kept, and as many of those met before them.
    """

    def __init__(self, count_words: Callable[[Sequence[str]], np.ndarray]):
        self.count_words = count_words
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def counts(self, parts: Sequence[str]) -> np.ndarray:
        """Number of ids of each of different parts; new ones alone are encoded."""
        if len(self.young) > KEPT_WORDS:
            self.young, self.old = {}, self.young
        known = self.young
        found = np.fromiter((known.get(p, -1) for p in parts), np.int64, len(parts))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            known = self.old
            names = [parts[i] for i in missing.tolist()]
            own = np.fromiter((known.get(p, -1) for p in names), np.int64, len(names))
            new = np.flatnonzero(own < 0)
            own[new] = self.count_words([names[i] for i in new.tolist()])
            self.young.update(zip(names, own.tolist(), strict=True))
            found[missing] = own
        return found


@functools.cache
def word_table(vocabulary: str) -> WordTable:
    return WordTable(byte_encoder(vocabulary).count_words)


def vectors_and_tokens(texts: pa.Array, vocabulary: str) -> tuple[np.ndarray, np.ndarray]:
    """Word vectors and numbers of ids of all texts, words being split once for both.

    A word has the ids of its parts. Texts that cannot be cut into words are counted whole.
    """
    encoder, table = byte_encoder(vocabulary), word_table(vocabulary)
    words, codes, per_text = blank_words(texts)
    parts, per_word = word_parts(words)
    coded = parts.dictionary_encode()
    lengths = run_sums(table.counts(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)], per_word)
    counts = run_sums(lengths.astype(np.int32)[codes], per_text)
    unsafe = pc.match_substring_regex(texts, BLANK_RUN).to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(unsafe).tolist():
        counts[i] = len(encoder.whole(texts[i].as_py()))
    return vectors_of(places_of(words).astype(np.int16)[codes], per_text), counts


def _unit(sums: np.ndarray) -> np.ndarray:
    return sums / max(np.linalg.norm(sums), 1e-12)


def centre_sums(stored: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Sum of the stored vectors nearest to each centre."""
    sums = np.zeros(centres.shape)
    for at in range(0, len(stored), SUMMED_ROWS):
        rows = stored[at:at + SUMMED_ROWS].astype(float)
        own = np.argmax(rows @ centres.T, axis=1)
        sums += (own == np.arange(len(centres))[:, None]).astype(float) @ rows  # whole numbers, exact below 2**53
    return sums.astype(np.int64)


def find_centres(starts: np.ndarray, sums_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """K-means on the sphere: rounds of means over all rows, from the given starts, until
    no centre moves by more than ``TOPIC_STEP``."""
    if not len(starts):
        return np.zeros((1, WIDTH))
    found = starts / float(VECTOR_SCALE)
    for _ in range(TOPIC_ROUNDS):
        sums = sums_of(found)
        moved = np.array([_unit(s.astype(float)) if s.any() else old for s, old in zip(sums, found, strict=True)])
        step, found = np.linalg.norm(moved - found, axis=1).max(), moved
        if step <= TOPIC_STEP:
            break
    return found


def spread(rows: np.ndarray, topics: int) -> np.ndarray:
    k = min(topics, len(rows))
    return rows[np.arange(k) * len(rows) // max(1, k)]


def stored_vectors(vectors: np.ndarray) -> np.ndarray:
    return np.rint(vectors * VECTOR_SCALE).astype("<u2")


def fit_topics(vectors: np.ndarray, topics: int = TOPICS) -> np.ndarray:
    """Centres of vectors in memory, started from points evenly spread over the rows."""
    stored = stored_vectors(vectors)
    return find_centres(spread(stored, topics), lambda centres: centre_sums(stored, centres))


def _vectors(batch: pa.RecordBatch, column: int) -> np.ndarray:
    held = batch.column(column)
    offsets = np.frombuffer(held.buffers()[1], np.int64 if pa.types.is_large_binary(held.type) else np.int32)
    start = int(offsets[held.offset])
    return np.frombuffer(held.buffers()[2], "<u2", batch.num_rows * WIDTH, start).reshape(-1, WIDTH)


def train_topics(stored: DataFrame, topics: int = TOPICS) -> np.ndarray:
    """Topic centres of all rows of a stored table with ``doc_id`` and ``_vector``.

    The starting points alone are evenly spread over the ``START_KEYS`` keys with the
    least hash. Every round is one aggregate over the whole table, of which the sums of
    each centre (``topics`` x ``WIDTH`` whole numbers) come back.
    """
    rows = stored.select("_vector")
    keys = stored.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(START_KEYS)
    ordered = [r[0] for r in keys.orderBy("doc_id").collect()]
    picked = [ordered[i] for i in spread(np.arange(len(ordered)), topics).tolist()]
    firsts = {k: v for k, v in stored.filter(
        F.col("doc_id").isin([k for k in picked if k is not None]) | (F.col("doc_id").isNull() & F.lit(None in picked))
    ).groupBy("doc_id").agg(F.min("_vector")).collect()}
    starts = np.array([np.frombuffer(firsts[k], "<u2") for k in picked], "<u2").reshape(-1, WIDTH)

    def sums_of(centres: np.ndarray) -> np.ndarray:
        def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(centres), WIDTH), np.int64)
            for batch in batches:
                if batch.num_rows:
                    sums += centre_sums(_vectors(batch, 0), centres)
            place = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(sums.reshape(-1)[place])], names=["place", "n"])

        out = np.zeros(len(centres) * WIDTH, np.int64)
        for r in rows.mapInArrow(add, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
            out[r.place] = r.n
        return out.reshape(-1, WIDTH)

    return find_centres(starts, sums_of)


def measured_texts(texts: pa.Array, vocabulary: str) -> pa.Array:
    """``_vector`` and ``_tokens`` of all texts; vectors are kept as stored, not as numbers in double precision."""
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    vectors, tokens = [], []
    for part in slices(batch, 0, MEASURED_BYTES):
        own, counts = vectors_and_tokens(as_texts(part.column(0)), vocabulary)
        vectors.append(stored_vectors(own).tobytes())
        tokens.append(counts + 1)
    data = pa.py_buffer(b"".join(vectors))
    ends = pa.py_buffer(np.arange(len(texts) + 1, dtype=np.int64) * (2 * WIDTH))
    held = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, ends, data]).cast(pa.binary())
    counted = pa.array(np.concatenate(tokens) if tokens else np.zeros(0, np.int64), pa.int64())
    give_back()
    return pa.StructArray.from_arrays([held, counted], names=["_vector", "_tokens"])


def with_vectors_and_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Add ``_vector`` (stored word vector) and ``_tokens`` (ids of the whole text and one end id).

    Only the text passes through Python.
    """

    @F.arrow_udf("struct<_vector: binary, _tokens: long>")
    def measured(texts: pa.Array) -> pa.Array:
        return measured_texts(texts, vocabulary)

    names = [F.col(f"`{c}`") for c in docs.columns]
    return docs.withColumn("_measured", measured("text")).select(*names, "_measured._vector", "_measured._tokens")


def with_topic(stored: DataFrame, centres: np.ndarray) -> DataFrame:
    """``_topic`` (nearest centre) in place of ``_vector``; only the vector passes through Python."""

    @F.pandas_udf("int")
    def nearest(vectors: pd.Series) -> pd.Series:
        own = np.frombuffer(b"".join(vectors), "<u2").reshape(-1, WIDTH)
        return pd.Series(np.argmax(own @ centres.T, axis=1).astype(np.int32))

    return stored.withColumn("_topic", nearest("_vector")).drop("_vector")


def rake(weights: np.ndarray, members: Sequence[np.ndarray], targets: Sequence[np.ndarray]) -> np.ndarray:
    """Factor of every cell, by proportional fitting of each dimension in turn.

    ``members[d]`` gives the value of each cell in dimension d; ``targets[d]`` the
    wanted share of each value. Shares of values without weight, or with weight only
    where another dimension wants none, are spread over the others. Ends when all shares are met, or after ``ROUNDS`` rounds if the
    empty cells leave no exact answer.
    """
    factor = np.ones(len(weights))
    total = weights.sum()
    if not total:
        return factor
    shut = np.zeros(len(weights), bool)
    for own, target in zip(members, targets, strict=True):
        if (target[own[weights > 0]] > 0).any():
            shut |= target[own] <= 0
    if (weights[~shut] > 0).any():
        factor[shut] = 0
    wanted = []
    for own, target in zip(members, targets, strict=True):
        held = np.bincount(own, weights * factor, len(target)) > 0
        share = np.where(held, np.maximum(target, 0), 0.0)
        wanted.append(total * (share / share.sum() if share.sum() else held / held.sum()))
    for _ in range(ROUNDS):
        off = 0.0
        for own, want in zip(members, wanted, strict=True):
            have = np.bincount(own, weights * factor, len(want))
            scale = np.divide(want, have, out=np.ones(len(want)), where=have > 0)
            off = max(off, np.abs(scale[have > 0] - 1).max(initial=0))
            factor *= scale[own]
        if off < TOLERANCE:
            break
    return factor


def sampling_rate(weights: np.ndarray, factor: np.ndarray, share: float = KEPT_SHARE) -> float:
    """The multiplier c at which min(1, c * factor) keeps ``share`` of the weight, by bisection.

    Where the cells with a factor hold less than that, all of them are kept whole.
    """
    wanted, held = share * weights.sum(), factor > 0
    if not held.any() or weights[held].sum() <= wanted:
        return float("inf")
    low, high = 0.0, 1 / factor[held].min()
    for _ in range(200):
        middle = (low + high) / 2
        if (weights * np.minimum(1, middle * factor)).sum() < wanted:
            low = middle
        else:
            high = middle
    return high


def bounded_rake(
    weights: np.ndarray, members: Sequence[np.ndarray], shares: Sequence[np.ndarray], kept: float,
) -> np.ndarray | None:
    """Probabilities min(1, product of a factor per dimension) that keep ``kept`` of the
    weight, divided as ``shares`` say; None if raking does not come to them."""
    total = kept * weights.sum()
    factor = np.full(len(weights), kept)
    for _ in range(BOUND_ROUNDS):
        off = 0.0
        for own, share in zip(members, shares, strict=True):
            have = np.bincount(own, weights * np.minimum(1, factor), len(share))
            scale = np.divide(total * share, have, out=np.ones(len(share)), where=have > 0)
            off = max(off, np.abs(scale[have > 0] - 1).max(initial=0))
            factor = np.minimum(factor * scale[own], 1e100)
        if off < BOUND_TOLERANCE:
            return np.minimum(1, factor)
    return None


def exact_probabilities(
    weights: np.ndarray, members: Sequence[np.ndarray], factor: np.ndarray, targets: Sequence[np.ndarray], most: float = KEPT_SHARE,
) -> np.ndarray | None:
    """Probabilities whose kept weight is divided as raking divides it (``factor``).

    They keep ``most`` of the weight; where some value, or values of several dimensions
    together, hold too little for that, the greatest share found that meets all targets.
    Factors over the greatest one always meet them, so that share is where the search starts.
    None if empty cells leave no answer at any share.
    """
    total = (weights * factor).sum()
    if not total:
        return np.zeros(len(weights))
    shares = [np.bincount(own, weights * factor, len(target)) / total for own, target in zip(members, targets, strict=True)]
    for share, target in zip(shares, targets, strict=True):
        wanted = np.where(share > 0, np.maximum(target, 0), 0.0)
        if wanted.sum() and np.abs(share - wanted / wanted.sum()).max() > BOUND_TOLERANCE:
            return None
    low = total / weights.sum() / factor[weights > 0].max()
    if low >= most:
        return most / low * factor / factor[weights > 0].max()
    found = factor / factor[weights > 0].max()
    high = most
    for own, share in zip(members, shares, strict=True):
        held = np.bincount(own, weights, len(share)) / weights.sum()
        high = min(high, (held[share > 0] / share[share > 0]).min())
    middle = high
    for _ in range(SHARE_STEPS + 1):
        tried = bounded_rake(weights, members, shares, middle)
        if tried is None:
            high = middle
        else:
            found, low = tried, middle
        if low >= high:
            break
        middle = (low * high) ** 0.5
    return found


def _told(gap: float) -> None:
    if gap > TOLD_GAP:
        warnings.warn(f"the mixture misses a target by {gap:.4f} of its tokens", stacklevel=3)


def probabilities_here(cells: Sequence, targets: Mapping[str, Mapping] | None, exact: bool) -> list[tuple[float, float]]:
    """Weight and probability of each collected cell (source, lang, topic, tokens)."""
    weights = np.array([float(c[3]) for c in cells])
    members, wanted = [], []
    for d, name in enumerate(DIMENSIONS):
        place: dict = {}
        members.append(np.array([place.setdefault(c[d], len(place)) for c in cells], np.int64))
        if targets and name in targets:
            wanted.append(np.array([float(targets[name].get(v, 0)) for v in place]))
        else:
            share = np.bincount(members[d], weights, len(place))
            wanted.append(np.power(share / max(share.sum(), 1.0), TEMPER))
    if not len(cells):
        return []
    factor = rake(weights, members, wanted)
    chance = exact_probabilities(weights, members, factor, wanted) if exact else None
    if chance is not None:
        factor = chance * weights.sum() / max((chance * weights).sum(), 1e-300)
    else:
        rate = sampling_rate(weights, factor)
        chance = np.array([min(1.0, f * rate) if f > 0 else 0.0 for f in factor])
    for own, want in zip(members, wanted, strict=True):
        if exact and want.sum():
            _told(np.abs(np.bincount(own, chance * weights) / max((chance * weights).sum(), 1e-300) - want / want.sum()).max())
    return list(zip(factor.tolist(), chance.tolist(), strict=True))


class CellTable:
    """Cells (dimensions, ``t`` tokens, ``_cell``, ``n``) raked as a table: the steps, bounds and
    tolerances of ``rake``, ``bounded_rake``, ``sampling_rate`` and ``exact_probabilities``, of
    which every sum is an aggregate and every scaling a join.

    ``wants`` holds a table per dimension: ``_v0`` to ``_v2`` (the value as JSON), ``want`` and ``_cells``.
    """

    def __init__(self, cells: DataFrame, targets: Mapping[str, Mapping] | None):
        self.keys = [f"_v{d}" for d in range(len(DIMENSIONS))]
        columns = ["source", "lang", "_topic"]
        self.all = cut_lineage(cells.select("_cell", "n", "t", *[F.to_json(F.struct(c)).alias(k) for c, k in zip(columns, self.keys, strict=True)]))
        self.total, self.size = float(self.all.agg(F.sum("t")).first()[0] or 0), self.all.count()
        self.wants, self.few = [], []
        for name, column, key in zip(DIMENSIONS, columns, self.keys, strict=True):
            values = cells.groupBy(column).agg(F.sum("t").alias("held"), F.count(F.lit(1)).alias("_cells"))
            if targets and name in targets:
                given = cells.sparkSession.createDataFrame(
                    [(v, float(x)) for v, x in targets[name].items()],
                    T.StructType([T.StructField("given", cells.schema[column].dataType), T.StructField("want", T.DoubleType())]),
                )
                values = values.join(given, F.col(column).eqNullSafe(F.col("given")), "left").withColumn("want", F.coalesce("want", F.lit(0.0)))
            else:
                values = values.withColumn("want", F.pow(F.col("held") / F.lit(max(self.total, 1.0)), F.lit(TEMPER)))
            self.wants.append(cut_lineage(values.select(F.to_json(F.struct(column)).alias(key), "_cells", "want")))
            self.few.append(self.wants[-1].count() <= SENT_CELLS)

    def with_values(self, now: DataFrame, values: DataFrame, d: int) -> DataFrame:
        if self.few[d]:
            return now.join(F.broadcast(values.drop("_cells")), self.keys[d])
        return spread_join(now, values, self.keys[d], "_cells").drop("_cells")

    def sums(self, now: DataFrame, amount: Column, d: int) -> DataFrame:
        return now.groupBy(self.keys[d]).agg(F.sum(amount).alias("have"))

    def fit(self, now: DataFrame, wants: Sequence[DataFrame], bounded: bool) -> tuple[DataFrame, bool]:
        """``f`` of every cell after rounds of scaling to the ``want`` of each value, and whether they came to them."""
        rounds, tolerance = (BOUND_ROUNDS, BOUND_TOLERANCE) if bounded else (ROUNDS, TOLERANCE)
        amount = F.col("t") * (F.least(F.lit(1.0), F.col("f")) if bounded else F.col("f"))
        names, held = now.columns, None
        for _ in range(rounds):
            off = 0.0
            for d, values in enumerate(wants):
                scale = cut_lineage(values.join(self.sums(now, amount, d), self.keys[d]).select(
                    self.keys[d], "_cells", "have", F.when(F.col("have") > 0, F.col("want") / F.col("have")).otherwise(1.0).alias("scale"),
                ))
                off = max(off, scale.filter("have > 0").agg(F.max(F.abs(F.col("scale") - 1))).first()[0] or 0.0)
                f = F.col("f") * F.col("scale")
                now = cut_lineage(self.with_values(now, scale.drop("have"), d).withColumn("f", F.least(f, F.lit(1e100)) if bounded else f).select(names))
                for old in (scale, held):
                    if old is not None:
                        release(old)
                held = now
            if off < tolerance:
                return now, True
        return now, False

    def rake(self) -> DataFrame:
        shut = F.lit(False)
        now = self.all
        for d, values in enumerate(self.wants):
            if values.filter("want > 0").isEmpty():
                continue
            now = self.with_values(now, values, d).withColumn("shut", shut | (F.col("want") <= 0)).drop("want")
            shut = F.col("shut")
        if "shut" in now.columns:
            live = cut_lineage(now.filter(~F.col("shut")).drop("shut"))
            now = self.all if live.isEmpty() else live
        wants = []
        for d, values in enumerate(self.wants):
            here = values.join(now.select(self.keys[d]).distinct(), self.keys[d]).withColumn("want", F.greatest(F.col("want"), F.lit(0.0)))
            whole, n = here.agg(F.sum("want"), F.count(F.lit(1))).first()
            share = F.col("want") / whole if whole else F.lit(1.0 / max(n, 1))
            wants.append(cut_lineage(here.withColumn("want", F.lit(self.total) * share)))
        raked = self.fit(now.withColumn("f", F.lit(1.0)), wants, False)[0]
        if raked.count() == self.size:
            return raked
        shut = self.all.join(raked.select("_cell"), "_cell", "left_anti")
        return cut_lineage(raked.unionByName(shut.withColumn("f", F.lit(0.0)), allowMissingColumns=True))

    def shares(self, now: DataFrame, amount: Column) -> list[DataFrame]:
        """Per dimension: each value's ``share`` of the amount, beside its ``want`` and ``held`` tokens."""
        whole = now.agg(F.sum(amount)).first()[0] or 1e-300
        return [
            values.join(now.groupBy(self.keys[d]).agg((F.sum(amount) / F.lit(whole)).alias("share"), F.sum("t").alias("held")), self.keys[d])
            for d, values in enumerate(self.wants)
        ]

    def gaps(self, shares: Sequence[DataFrame], want: Column) -> list[float]:
        """Per dimension: greatest distance of a share from its part of what is wanted."""
        wholes = [values.agg(F.sum(want)).first()[0] for values in shares]
        return [
            values.agg(F.max(F.abs(F.col("share") - want / F.lit(whole)))).first()[0] if whole else 0.0
            for values, whole in zip(shares, wholes, strict=True)
        ]

    def exact(self, raked: DataFrame, most: float = KEPT_SHARE) -> DataFrame | None:
        total, top = raked.agg(F.sum(F.col("t") * F.col("f")), F.max("f")).first()
        if not total:
            return raked.withColumn("f", F.lit(0.0))
        shares = [cut_lineage(s) for s in self.shares(raked, F.col("t") * F.col("f"))]
        held_want = F.when(F.col("share") > 0, F.greatest(F.col("want"), F.lit(0.0))).otherwise(0.0)
        if max(self.gaps(shares, held_want)) > BOUND_TOLERANCE:
            return None
        low = total / self.total / top
        if low >= most:
            return raked.withColumn("f", F.lit(most / low) * F.col("f") / F.lit(top))
        found, high = raked.withColumn("f", F.col("f") / F.lit(top)), most
        for values in shares:
            high = min(high, values.filter("share > 0").agg(F.min(F.col("held") / F.lit(self.total) / F.col("share"))).first()[0])
        middle = high
        for _ in range(SHARE_STEPS + 1):
            wants = [v.select(self.keys[d], "_cells", (F.lit(middle * self.total) * F.col("share")).alias("want")) for d, v in enumerate(shares)]
            tried, met = self.fit(self.all.withColumn("f", F.lit(middle)), wants, True)
            if met:
                found, low = tried.withColumn("f", F.least(F.lit(1.0), F.col("f"))), middle
            else:
                high = middle
            if low >= high:
                break
            middle = (low * high) ** 0.5
        return found

    def rate(self, raked: DataFrame, share: float = KEPT_SHARE) -> float:
        """``sampling_rate``, by steps to where the line through the cells not yet whole keeps the share."""
        wanted, held = share * self.total, raked.filter("f > 0")
        if (held.agg(F.sum("t")).first()[0] or 0) <= wanted:
            return float("inf")
        found = 0.0
        while True:
            whole = F.col("f") * F.lit(found) >= 1
            kept, rest = held.agg(F.sum(F.when(whole, F.col("t"))), F.sum(F.when(~whole, F.col("t") * F.col("f")))).first()
            step = (wanted - (kept or 0)) / rest if rest else found
            if step <= found * (1 + 1e-15):
                return found
            found = step

    def probabilities(self, exact: bool) -> DataFrame:
        """``_cell``, ``n``, ``_weight`` and ``_probability``."""
        raked = self.rake()
        chance = self.exact(raked) if exact else None
        if chance is not None:
            kept = chance.agg(F.sum(F.col("f") * F.col("t"))).first()[0] or 1e-300
            weight, chance = F.col("f") * F.lit(self.total / kept), chance.withColumn("_probability", F.col("f"))
        else:
            weight, chance = F.col("f"), raked.withColumn(
                "_probability", F.when(F.col("f") > 0, F.least(F.lit(1.0), F.col("f") * F.lit(self.rate(raked)))).otherwise(0.0),
            )
        if exact:
            for gap in self.gaps(self.shares(chance, F.col("_probability") * F.col("t")), F.col("want")):
                _told(gap)
        return chance.select("_cell", "n", weight.alias("_weight"), "_probability")


def mix_probabilities(rows: DataFrame, targets: Mapping[str, Mapping] | None = None, seed: int = 1, exact: bool = False) -> DataFrame:
    """Add ``_weight``, ``_probability`` and ``_kept`` to rows with source, lang,
    ``_topic``, ``_tokens`` and ``_hash``.

    ``targets`` maps a dimension to the wanted share of each value (others none);
    a missing dimension takes its own shares to the power ``TEMPER``. A cell's
    weight is the factor raking gives its tokens. Probabilities are the weights times
    one number, at most 1, so that ``KEPT_SHARE`` of the tokens is expected to stay:
    the targets are met as far as cells hold enough, and a scarce cell, kept whole,
    does not shrink the rest. With ``exact`` the cells are raked under that bound: expected
    tokens meet all targets, ``_weight`` is the probability over the share of tokens kept,
    and that share is less than ``KEPT_SHARE`` only where the targets cannot be met
    with it; where empty cells leave no answer at any share, it is as without ``exact``. Every value has its own
    target, however many there are: more than ``CELLS`` cells are raked as a table, by the same
    steps and tolerances, to the same probabilities. A missed target is warned of. A document stays if a uniform number from ``_hash`` and
    the seed lies below: rows alike in key and text share their fate.
    """
    spark = rows.sparkSession
    columns = ["source", "lang", "_topic"]
    placed = rows.withColumn("_cell", F.to_json(F.struct(*columns)))
    cells = cut_lineage(placed.groupBy("_cell", *columns).agg(F.sum("_tokens").alias("t"), F.count(F.lit(1)).alias("n")))
    n_cells = cells.count()
    if n_cells <= CELLS:
        held = cells.select(*columns, "t", "_cell", "n").collect()
        found = spark.createDataFrame(
            [(c["_cell"], c["n"], w, p) for c, (w, p) in zip(held, probabilities_here(held, targets, exact), strict=True)],
            "_cell string, n long, _weight double, _probability double",
        )
    else:
        found = cut_lineage(CellTable(cells, targets).probabilities(exact))
    if n_cells <= SENT_CELLS:
        met = placed.join(F.broadcast(found.drop("n")), "_cell", "left")
    else:
        met = spread_join(placed, found, "_cell", "n").drop("n")
    uniform = F.shiftrightunsigned(F.xxhash64("_hash", F.lit(seed)), 11) / F.lit(float(2**53))
    return met.withColumn("_kept", uniform < F.col("_probability")).drop("_cell")


def mixture_table(
    docs: DataFrame, vocabulary: str, targets: Mapping[str, Mapping] | None = None, exact: bool = False,
) -> DataFrame:
    """Per row: ``doc_id``, ``source``, ``lang``, ``topic``, ``tokens``, ``weight``,
    ``probability`` and ``kept``.

    Null sources and languages are values of their own; a null text is empty and
    counts one token, its end. Repeated rows stay; other columns are not read.
    """
    chosen = docs.select("doc_id", "text", "source", "lang")
    stored = cut_lineage(with_vectors_and_tokens(chosen, vocabulary).select(
        "doc_id", "source", "lang", "_vector", "_tokens", F.xxhash64("doc_id", "text").alias("_hash"),
    ))
    mixed = mix_probabilities(cut_lineage(with_topic(stored, train_topics(stored))), targets, exact=exact)
    return mixed.select("doc_id", "source", "lang", *[
        F.col(f"_{c}").alias(c) for c in ("topic", "tokens", "weight", "probability", "kept")
    ])


def mixture_shares(mixed: DataFrame, targets: Mapping[str, Mapping] | None = None) -> DataFrame:
    """Per value of source, language and topic of a mixture table: ``dimension``, ``value``,
    and its shares of tokens: wanted (``target``), ``expected`` and drawn (``sampled``)."""
    parts = []
    for name in DIMENSIONS:
        sums = mixed.groupBy(F.col(name).alias("of")).agg(
            F.sum("tokens").alias("t"), F.sum(F.col("tokens") * F.col("probability")).alias("e"),
            F.sum(F.when(F.col("kept"), F.col("tokens")).otherwise(0)).alias("s"),
        )
        if targets and name in targets:
            kind = mixed.schema[name].dataType
            given = mixed.sparkSession.createDataFrame(
                [(v, float(max(x, 0))) for v, x in targets[name].items()],
                T.StructType([T.StructField("given", kind), T.StructField("w", T.DoubleType())]),
            )
            sums = sums.join(given, F.col("of").eqNullSafe(F.col("given")), "left").withColumn("w", F.coalesce("w", F.lit(0.0)))
        else:
            sums = sums.withColumn("w", F.pow(F.col("t").cast("double"), F.lit(TEMPER)))
        whole = sums.agg(*[F.sum(c).alias(f"all_{c}") for c in ("w", "e", "s")])  # one row
        parts.append(sums.crossJoin(F.broadcast(whole)).select(
            F.lit(name).alias("dimension"), F.col("of").cast("string").alias("value"),
            *[F.try_divide(F.col(c), F.col(f"all_{c}")).alias(to) for c, to in (("w", "target"), ("e", "expected"), ("s", "sampled"))],
        ))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def mix_documents(
    docs: DataFrame, vocabulary: str, targets: Mapping[str, Mapping] | None = None, exact: bool = False,
) -> DataFrame:
    """The sampled rows, with the columns they came with, whatever their names."""
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text", "source", "lang",
    )
    stored = cut_lineage(with_vectors_and_tokens(held, vocabulary).select(
        "row", "doc_id", "source", "lang", "_vector", "_tokens", F.xxhash64("doc_id", "text").alias("_hash"),
    ))
    # rows are stored once; the topic is found again from the vector wherever it is read
    return mix_probabilities(with_topic(stored, train_topics(stored)), targets, exact=exact).filter("_kept").select("row.*")
