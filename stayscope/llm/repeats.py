"""Repeated byte passages: Burrows-Wheeler columns of shards, merged by interleave refinement.

A passage repeats where a string of ``LENGTH`` bytes starts at two places. Suffixes are not
sorted over the corpus. Every window of that length names one anchor, the least-coded
``GRAM`` bytes inside it, so that equal windows have equal anchors at equal offsets, and the
windows that share an anchor form one context of at most ``WIDTH`` bytes around it.
Contexts seen before, as a whole, repeat as a whole. Only where an anchor stands in different
contexts is there more to find.

Those contexts are aligned at their anchors. A shard of them has a positional
Burrows-Wheeler transform: for every column, right to left, its symbols in the order of the
suffixes behind that column. Shards are merged from these columns alone: the interleave of
shards at one column, stably partitioned by the merged symbols, is the interleave at the
next column on the left, which is the refinement step of merging string collections,
done once per column because contexts are aligned. Common prefixes follow from the
common prefixes of the column before by range minima, and rows whose common prefix is
``LENGTH`` or more are a repeated interval. No suffix is compared or sorted again.

Global order comes from range partitions, so that an anchor on a third of all
documents spreads over tasks; anchors with more than ``MOST`` contexts are compared window by
window by digest instead, since one task may not hold them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.llm.probminhash import mixed
from stayscope.llm.spread import spread_join
from stayscope.llm.wordwise import as_texts, slices
from stayscope.session import cut_lineage, release

#: Bytes of a repeated string, of an anchor, and anchors in a window.
LENGTH, GRAM = 100, 32
ANCHORS = LENGTH - GRAM + 1

#: Columns of an aligned context: the anchor and as much on both sides as a window can hold.
SIDE = LENGTH - GRAM
WIDTH = SIDE + GRAM + SIDE

#: Windows that a task codes at once; contexts of a shard and of a merge; contexts of an anchor
#: beyond which windows are compared by digest.
PIECE, SHARD, MERGED, MOST = 1 << 20, 1_024, 8_192, 4_096

#: Where a context has no byte: no byte of UTF-8 has this value.
ABSENT = 0xFF

_random = np.random.RandomState(11)
GRAM_CODE, CONTEXT_CODE = (_random.randint(0, 1 << 62, 256, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
GROWTH = 0x9E3779B97F4A7C15
STEP = [np.uint64(pow(GROWTH, k + 1, 1 << 64)) for k in range(6)]
PLACE = np.uint64((1 << 21) - 1)
POWERS = np.cumprod(np.full(PIECE + LENGTH, GROWTH, np.uint64))
INVERSE = np.cumprod(np.full(PIECE + LENGTH, pow(GROWTH, -1, 1 << 64), np.uint64))


def gram_codes(data: np.ndarray) -> np.ndarray:
    """A 64-bit code of the ``GRAM`` bytes from every position."""
    code, n, k = GRAM_CODE[data], 1, 0
    while n < GRAM:
        code = code[:-n] * STEP[k] + code[n:]
        n, k = 2 * n, k + 1
    return mixed(code)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        values = np.minimum(values[:-n], values[n:])
        n *= 2
    return np.minimum(values[:len(values) - (width - n)], values[width - n:]) if n < width else values


def contexts_of(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Contexts of the texts data[offsets[i]:offsets[i + 1]]: text number, anchor code, context
    code, first window (from the text's start), bytes from there to the anchor, last window less the first."""
    found = []
    for at in range(0, max(0, len(data) - LENGTH + 1), PIECE):
        own = data[at:at + PIECE + LENGTH - 1]
        n = len(own) - LENGTH + 1
        codes = gram_codes(own)
        # the first of equal codes wins, so the choice depends on the window's bytes alone
        ranked = (codes & ~PLACE) | np.arange(len(codes), dtype=np.uint64)
        anchor = (sliding_least(ranked, ANCHORS) & PLACE).astype(np.int64)
        text = np.searchsorted(offsets, np.arange(at, at + n), "right") - 1
        whole = at + np.arange(n) + LENGTH <= offsets[text + 1]
        new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (whole[1:] != whole[:-1]))))
        last = np.append(new[1:], n) - 1
        new, last = new[whole[new]], last[whole[new]]
        left, span = anchor[new] - new, last - new
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(CONTEXT_CODE[own] * POWERS[:len(own)])))
        context = mixed((sums[last + LENGTH] - sums[new]) * INVERSE[new] ^ (left * 128 + span).astype(np.uint64))
        found.append([text[new], codes[anchor[new]].view(np.int64), context.view(np.int64), new + at - offsets[text[new]], left, span])
    return [np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(6)]


ROW = "anchor long, context long, doc_id long, tie long, lo long, before int, span int"
SPAN = "doc_id long, tie long, start long, end long"


def tie_of(text: Column) -> Column:
    """Tells texts with one key apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), tie_of(text).alias("tie"), text.alias("text"))


def all_contexts(docs: DataFrame) -> DataFrame:
    """Contexts of all whole texts (``ROW``)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2)):
            texts = as_texts(batch.column(2))
            if not len(texts) or texts.buffers()[2] is None:
                continue
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
            text, anchor, context, lo, left, span = contexts_of(data, offsets - offsets[0])
            which = pa.array(text)
            yield pa.RecordBatch.from_arrays([
                pa.array(anchor), pa.array(context), batch.column(0).take(which), batch.column(1).take(which),
                pa.array(lo), pa.array(left.astype(np.int32)), pa.array(span.astype(np.int32)),
            ], names=[f.split()[0] for f in ROW.split(", ")])

    return keyed(docs).mapInArrow(run, ROW)


AGAIN, CONTESTED, BORDER = 0, 1, 2


def _decided(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted contexts: those seen before (``AGAIN``), the first of each where an anchor has
    several (``CONTESTED``). The first and last anchor of a batch may go on elsewhere: of each of their
    contexts the first is left open (``BORDER``), and those behind it were seen before in any case."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        anchor, context, tie, lo = (batch.column(i).to_numpy() for i in (0, 1, 3, 4))
        doc = batch.column(2).fill_null(0).to_numpy()
        null = batch.column(2).is_null().to_numpy(zero_copy_only=False)

        def changes(*columns: np.ndarray, n: int = n) -> np.ndarray:
            out = np.ones(n, bool)
            out[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            return out

        new_anchor, first = changes(anchor), changes(anchor, context)
        group, run = np.cumsum(new_anchor) - 1, np.cumsum(first) - 1
        border = (group == 0) | (group == group[-1])
        lead = np.flatnonzero(first)[run]
        same = (doc == doc[lead]) & (null == null[lead]) & (tie == tie[lead]) & (lo == lo[lead])
        several = np.bincount(group, first) > 1
        kind = np.full(n, -1, np.int32)
        kind[~same] = AGAIN
        kind[first & several[group]] = CONTESTED
        kind[border & first] = BORDER
        kept = np.flatnonzero(kind >= 0)
        rows = batch.take(pa.array(kept))
        yield pa.RecordBatch.from_arrays([pa.array(kind[kept]), *rows.columns], names=["kind", *rows.schema.names])


def positional_bwt(aligned: np.ndarray) -> np.ndarray:
    """Columns of the transform of aligned contexts (a row each): per column the symbols in the
    order of what follows it, equal ones in the order of the rows."""
    order, out = np.arange(len(aligned)), np.empty(aligned.shape[::-1], np.uint8)
    for c in range(aligned.shape[1] - 1, -1, -1):
        out[c] = aligned[order, c]
        order = order[np.argsort(out[c], kind="stable")]
    return out


def _range_least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of values[low..high], ends included, of every range."""
    levels, n = [values], 1
    most = int((high - low).max(initial=0)) + 1
    while 2 * n <= most:
        wide = levels[-1].copy()
        wide[:-n] = np.minimum(wide[:-n], wide[n:])
        levels.append(wide)
        n *= 2
    level = np.floor(np.log2(high - low + 1)).astype(np.int64)
    table = np.stack(levels)
    return np.minimum(table[level, low], table[level, high - (1 << level) + 1])


def merged_intervals(columns: list[np.ndarray], wanted: range) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Merges the transforms of shards; per wanted column, right to left, the rows of all shards
    (numbered through) in the order of their suffixes and the common prefix of each with the row before."""
    sizes = [c.shape[1] for c in columns]
    shard = np.repeat(np.arange(len(sizes)), sizes).astype(np.uint16)
    rows, common = np.arange(sum(sizes)), np.zeros(sum(sizes), np.uint8)
    for c in range(len(columns[0]) - 1, wanted.start - 1, -1):
        # the next symbol of each shard, where the interleave has that shard
        symbols = np.empty(len(rows), np.uint8)
        symbols[np.argsort(shard, kind="stable")] = np.concatenate([own[c] for own in columns])
        to = np.argsort(symbols, kind="stable")
        shard, rows, symbols = shard[to], rows[to], symbols[to]
        longer = np.zeros(len(rows), np.uint8)
        alike = np.flatnonzero(symbols[1:] == symbols[:-1]) + 1
        if len(alike):
            longer[alike] = _range_least(common, to[alike - 1] + 1, to[alike]) + 1
        common = longer
        if c in wanted:
            yield c, rows, common


def repeated_windows(aligned: np.ndarray, rank: np.ndarray, before: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Which windows of each context (from its first on) also start earlier: at a row of lower ``rank``."""
    shards = [positional_bwt(aligned[at:at + SHARD]) for at in range(0, len(aligned), SHARD)]
    found = np.zeros((len(aligned), ANCHORS), bool)
    for c, rows, common in merged_intervals(shards, range(0, SIDE + 1)):
        starts = np.flatnonzero(common < LENGTH)
        least = np.repeat(np.minimum.reduceat(rank[rows], starts), np.diff(np.append(starts, len(rows))))
        # column c is this window of the row: its anchor stands SIDE - c bytes on
        window = before[rows] - (SIDE - c)
        hit = (rank[rows] > least) & (window >= 0) & (window <= span[rows])
        found[rows[hit], window[hit]] = True
    return found


def _spans(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last window of every run of windows."""
    edges = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edges == 1)
    return row, first, np.nonzero(edges == -1)[1] - 1


def _merged_spans(rows: pa.Table) -> pa.RecordBatch:
    """Repeated spans among contexts with all their anchors complete."""
    before, span = (rows.column(c).to_numpy().astype(np.int64) for c in ("before", "span"))
    tie, lo = rows.column("tie").to_numpy(), rows.column("lo").to_numpy()
    doc = rows.column("doc_id").fill_null(0).to_numpy()
    held = rows.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
    # order of the places, equal places alike
    order = np.lexsort((lo, tie, doc, held))
    step = np.zeros(len(order), bool)
    for c in (held, doc, tie, lo):
        step[1:] |= c[order][1:] != c[order][:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(step)
    aligned = np.full((len(order), WIDTH), ABSENT, np.uint8)
    texts = rows.column("bytes").combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    aligned[row, SIDE - before[row] + inside] = data[offsets[0]:offsets[-1]]
    which, first, last = _spans(repeated_windows(aligned, rank, before, span))
    picked = pa.array(which)
    return pa.RecordBatch.from_arrays([
        rows.column("doc_id").combine_chunks().take(picked), pa.array(tie[which]), pa.array(lo[which] + first), pa.array(lo[which] + last + LENGTH),
    ], names=[f.split()[0] for f in SPAN.split(", ")])


def _merges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by anchor, merged ``MERGED`` or little more at a time, anchors kept whole."""
    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= MERGED:
            rows = pa.Table.from_batches(held)
            anchor = rows.column("anchor").to_numpy()
            end = int(np.searchsorted(anchor, anchor[-1]))
            if end:
                yield _merged_spans(rows.slice(0, end))
            held, n = rows.slice(end).to_batches(), n - end
    if n:
        yield _merged_spans(pa.Table.from_batches(held))


def _cut_contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the contexts listed with each text."""
    for batch in (part for whole in batches for part in slices(whole, 2)):
        for doc_id, tie, text, asked in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            data = (text or "").encode()
            columns = [[a[k] for a in asked] for k in ("anchor", "lo", "before", "span")]
            cut = [data[lo:lo + span + LENGTH] for lo, span in zip(columns[1], columns[3], strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(columns[0], pa.int64()), pa.array([doc_id] * len(asked), pa.int64()), pa.array([tie] * len(asked), pa.int64()),
                pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32()), pa.array(cut, pa.binary()),
            ], names=["anchor", "doc_id", "tie", "lo", "before", "span", "bytes"])


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and place of every window of the contexts."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256).to_pylist()
            windows = [(hashlib.blake2b(r["bytes"][k:k + LENGTH], digest_size=16).digest(), r["doc_id"], r["tie"], r["lo"] + k)
                       for r in part for k in range(r["span"] + 1)]
            yield pa.RecordBatch.from_arrays([
                pa.array([w[i] for w in windows], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.int64(), pa.int64()))
            ], names=["window", "doc_id", "tie", "start"])


PLACE_ORDER = ("doc_id", "tie", "lo")


def _later(rows: DataFrame, key: str, place: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key also has an earlier place, and the first place (``first``) of every key."""
    firsts = cut_lineage(rows.groupBy(key).agg(F.min(F.struct(*place)).alias("first"), F.count(F.lit(1)).alias("_n")))
    again = spread_join(rows, firsts.filter("_n > 1"), key, "_n").filter(F.struct(*place) != F.col("first"))
    return again.drop("first", "_n"), firsts


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Spans of bytes (``doc_id``, ``tie``, ``start``, ``end``) covered by strings of ``LENGTH`` bytes that also
    start earlier; spans of a text may touch, overlap or come twice."""
    order = ["anchor", "context", *PLACE_ORDER]
    contexts = cut_lineage(all_contexts(docs))
    decided = cut_lineage(contexts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_decided, f"kind int, {ROW}"))
    release(contexts)
    whole = ["doc_id", "tie", F.col("lo").alias("start"), (F.col("lo") + F.col("span") + LENGTH).alias("end")]

    # anchors at the borders of batches: the same decision by keys instead of neighbours
    border = decided.filter(F.col("kind") == BORDER).drop("kind").withColumn("both", F.struct("anchor", "context"))
    border_again, firsts = _later(border, "both", (*PLACE_ORDER, "before", "span"))
    open_anchors = firsts.groupBy("both.anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    border_first = firsts.select(F.col("both.anchor").alias("anchor"), "first.*").join(open_anchors, "anchor")
    columns = ["anchor", *PLACE_ORDER, "before", "span"]
    contested = cut_lineage(decided.filter(F.col("kind") == CONTESTED).select(*columns).unionByName(border_first.select(*columns)))
    again = decided.filter(F.col("kind") == AGAIN).select(*whole).unionByName(border_again.select(*whole))

    # bytes of contested contexts, from one row of each text
    asked = contested.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("anchor", "lo", "before", "span")).alias("asked"))
    asked = asked.select(row_key().alias("key"), "asked")
    needed = keyed(docs).withColumn("key", row_key()).join(asked.select("key"), "key", "left_semi")
    texts = needed.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("tie").alias("tie"), F.first("text").alias("text"))
    cut = cut_lineage(texts.join(asked, "key").select("doc_id", "tie", "text", "asked").mapInArrow(
        _cut_contexts, "anchor long, doc_id long, tie long, lo long, before int, span int, bytes binary",
    ))
    counts = cut.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    crowded = cut_lineage(counts.filter(F.col("n") > MOST).select("anchor"))
    few = cut.join(crowded, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    merged = few.mapInArrow(_merges, SPAN)
    windows = cut_lineage(cut.join(crowded, "anchor", "left_semi").drop("anchor").mapInArrow(_windows, "window binary, doc_id long, tie long, start long"))
    crowded_again, _ = _later(windows, "window", ("doc_id", "tie", "start"))
    return again.unionByName(merged).unionByName(crowded_again.select("doc_id", "tie", "start", (F.col("start") + LENGTH).alias("end")))


def row_key() -> Column:
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("tie").cast("string"))


def without_repeats(docs: DataFrame, kept: bool = False) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``spans``
    (their starts and ends), ``kept_sha256`` and, if asked for, the remaining bytes ``kept``.

    A byte goes if a string of ``LENGTH`` bytes over it also starts earlier: in a row with a smaller
    ``doc_id`` (null first; equal ones by a hash of the text) or earlier in the text. Rows equal in key
    and text are one document and share its result. Null texts are empty; texts shorter than ``LENGTH`` stay
    whole. Columns other than ``doc_id`` and ``text`` are not read. Keys are whole numbers.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            out = []
            for doc_id, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                data = (text or "").encode()
                runs: list[list[int]] = []
                for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
                    if runs and start <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], end)
                    else:
                        runs.append([start, end])
                edges = [0, *(e for r in runs for e in r), len(data)]
                rest = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                row = (doc_id, len(data), len(data) - len(rest), len(runs), [{"start": a, "end": b} for a, b in runs], hashlib.sha256(rest).hexdigest())
                out.append((*row, rest) if kept else row)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256", *(["kept"] if kept else [])]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pair), pa.string(), pa.binary()][:len(names)]
    spans = repeated_spans(docs).groupBy("doc_id", "tie").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    rows = keyed(docs).withColumn("key", row_key())
    # a row repeated on much of the table meets its spans by broadcast
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    found = cut_lineage(counts.join(spans.select(row_key().alias("key"), "spans"), "key", "left"))
    met = spread_join(rows, found, "key", "n").select("doc_id", "text", "spans")
    return met.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, end: long>>, kept_sha256 string"
                          + (", kept binary" if kept else ""))
