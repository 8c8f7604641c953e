"""Near-duplicates by ProbMinHash: weighted shingles, early-ending arrivals, bands, verification.

Every shingle of a text sends arrivals of a Poisson process whose rate is its
weight; each arrival falls on a random register, and a register keeps the shingle
of its earliest arrival. A shingle stops once its next arrival is later than the
latest register, so long texts need little more than one arrival per shingle. Two
registers agree with the probability Jaccard of the weights (Ertl, 2020), which
is plain Jaccard if all weights are one. Texts with repeated shingles are
sketched twice, with counts as weights and with ones.

Bands of registers give buckets. A bucket's texts are compared with pivots, not
with each other. Where that leaves several classes in a bucket, the texts outside
its largest class are compared with the others. All comparisons are of a block of texts with
those asked for, both bounded in texts and shingles, so that no row stands for a pair. Every link is
verified on the full sets, and classes are the connected components of the links.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.llm.spread import spread_join
from stayscope.llm.wordwise import as_texts, run_sums, slices
from stayscope.session import cut_lineage

#: Words of a shingle, and the least similarity of a link.
WORDS, SIMILAR = 5, 0.8

#: Bands and registers of a band: a pair at the threshold is missed with 3 in a million.
BANDS, ROWS = 32, 5

#: Texts of a block, and different shingles of all its texts together.
BLOCK, BLOCK_SHINGLES = 256, 65_536

#: Bytes of text whose shingles are made at once.
SLICE_BYTES = 2_000_000

#: Texts asked for up to which a block is searched in each of their sets.
FEW = 3

#: Neighbours beyond which a node is a hub, and the places its label is sent to.
HUB, SALTS = 1_000, 16

#: Rounds of components in which labels go to neighbours only: stars of pivots need little more.
NEAR_ROUNDS = 2

GOLDEN = 0x9E3779B97F4A7C15


def offset(k: int) -> np.uint64:
    """The k-th of a sequence of spread-out 64-bit numbers."""
    return np.uint64(k * GOLDEN & 0xFFFFFFFFFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array, words: int = WORDS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: sorted different shingle hashes and their counts.

    Words are runs without ASCII white space. A text of fewer than ``words`` words
    is one shingle; a text without words has none.
    """
    parts = pc.ascii_split_whitespace(texts)
    per_text = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    plain = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in plain), np.uint64, len(plain))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    real = np.array([w != "" for w in plain], bool)[codes] if len(codes) else np.zeros(0, bool)
    row = np.repeat(np.arange(len(per_text)), per_text)[real]
    h = hashes[codes[real]] if len(codes) else np.zeros(0, np.uint64)
    n = np.bincount(row, minlength=len(per_text))
    starts = np.cumsum(n) - n
    # words that a short text lacks count as zero, as does what lies behind the last text
    padded = np.concatenate((h, np.zeros(words, np.uint64)))
    total = np.zeros(len(h), np.uint64)
    for k in range(words):
        total += mixed(padded[k:k + len(h)] + offset(k + 1)) * np.uint64(2 * k + 3)
    total = mixed(total)
    out = []
    for a, size in zip(starts.tolist(), n.tolist(), strict=True):
        if size >= words:
            out.append(np.unique(total[a:a + size - words + 1], return_counts=True))
        elif size:
            own = mixed(np.array([xxhash.xxh64_intdigest(h[a:a + size].tobytes())], np.uint64))
            out.append((own, np.ones(1, np.int64)))
        else:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    return out


def sketch(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = BANDS * ROWS) -> np.ndarray:
    """ProbMinHash signatures of weighted sets that are not empty: a row of shingle hashes each."""
    sizes = np.array([len(s) for s, _ in sets], np.int64)
    element = np.concatenate([s for s, _ in sets])
    weight = np.concatenate([w for _, w in sets]).astype(float)
    owner = np.repeat(np.arange(len(sets)), sizes)
    earliest = np.full((len(sets), registers), np.inf)
    holder = np.zeros((len(sets), registers), np.uint64)
    flat, kept = earliest.reshape(-1), holder.reshape(-1)
    time, step = np.zeros(len(element)), 0
    while len(element):
        step += 1
        random = mixed(element + offset(2 * step))
        uniform = ((random >> np.uint64(11)).astype(float) + 0.5) / 2.0**53
        time = time - np.log(uniform) / weight
        place = owner * registers + (mixed(element + offset(2 * step + 1)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(flat, place, time)
        won = flat[place] == time
        kept[place[won]] = element[won]
        rows, which = np.unique(owner, return_inverse=True)
        latest = earliest[rows].max(axis=1)
        on = time < latest[which]
        element, weight, owner, time = element[on], weight[on], owner[on], time[on]
    return holder


def band_keys(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    parts = signatures.reshape(len(signatures), bands, -1)
    key = np.tile(np.array([offset(i + 1) for i in range(bands)]), (len(signatures), 1))
    for k in range(parts.shape[2]):
        key = mixed(key ^ parts[:, :, k]) * np.uint64(2 * k + 3)
    return mixed(key).view(np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard of two weighted sets, by sorting the weight ratios."""
    common, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    wa, wb = a[1].astype(float), b[1].astype(float)
    ca, cb = wa[at], wb[bt]
    order = np.argsort(ca / cb, kind="stable")
    ca, cb = ca[order], cb[order]
    rest = wa.sum() - ca.sum() + np.cumsum(ca[::-1])[::-1]  # those with a ratio as great or greater
    below = wb.sum() - cb.sum() + np.cumsum(cb) - cb
    return float((1 / (rest / ca + below / cb)).sum())


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The greater of Jaccard of the shingle sets and probability Jaccard of their counts."""
    both = len(np.intersect1d(a[0], b[0], assume_unique=True))
    plain = both / max(1, len(a[0]) + len(b[0]) - both)
    if plain >= 1 or (a[1].max(initial=1) == 1 and b[1].max(initial=1) == 1):
        return plain
    return max(plain, probability_jaccard(a, b))


def node_of(text: Column) -> Column:
    """Identity of a text: 128 bits of its digest."""
    return F.unhex(F.md5(text.cast("binary")))


def bands_of(rows: DataFrame) -> DataFrame:
    """Band keys of every row of (``doc_id``, ``node``, ``text``) and the size of its set; no words, no keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2, SLICE_BYTES)):
            sets = shingles(as_texts(batch.column(2)))
            filled = [i for i, (s, _) in enumerate(sets) if len(s)]
            again = [i for i in filled if sets[i][1].max() > 1]
            keys: list[list[int]] = [[] for _ in sets]
            if filled:
                jobs = [(sets[i][0], np.ones(len(sets[i][0]))) for i in filled] + [sets[i] for i in again]
                for i, own in zip([*filled, *again], band_keys(sketch(jobs)).tolist(), strict=True):
                    keys[i] = sorted({*keys[i], *own})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int64())), pa.array([len(s) for s, _ in sets], pa.int64())],
                names=["doc_id", "node", "bands", "size"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "node", "text").mapInArrow(run, f"doc_id {kind}, node binary, bands array<long>, size long")


def sets_of(rows: DataFrame) -> DataFrame:
    """Shingle sets of (``node``, ``text``) as little-endian arrays; counts only where one repeats."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1, SLICE_BYTES)):
            sets = shingles(as_texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([s.astype("<u8").tobytes() for s, _ in sets], pa.binary()),
                pa.array([c.astype("<u4").tobytes() if c.max(initial=1) > 1 else b"" for _, c in sets], pa.binary()),
            ], names=["node", "hashes", "counts"])

    return rows.select("node", "text").mapInArrow(run, "node binary, hashes binary, counts binary")


def _set(hashes: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(hashes, "<u8")
    return own, np.frombuffer(counts, "<u4") if counts else np.ones(len(own), np.int64)


def _links_of_block(members: list[dict], similar: float) -> list[tuple[bytes, bytes, bytes, bytes, float]]:
    """Links between the texts of a block (side 0) and those asked for (side 1), one
    for each text asked for and each other class: connection is all that counts.

    Probability Jaccard is at most the sum over common shingles of the lesser of both shares in
    all counts, so it is worked out only where that sum reaches ``similar``."""
    block = [m for m in members if m["side"] == 0]
    sets = [_set(m["hashes"], m["counts"]) for m in block]
    sizes = np.array([len(s) for s, _ in sets], np.int64)
    every = np.concatenate([s for s, _ in sets])
    labels = [m["label"] for m in block]
    _, class_of = np.unique(np.array(labels, object), return_inverse=True)
    plain = np.array([not m["counts"] for m in block])
    asked = [m for m in members if m["side"] == 1]
    weighted = not plain.all() or any(m["counts"] for m in asked)
    shares = np.concatenate([c / max(1, c.sum()) for _, c in sets]) if weighted else None
    # the shingles of the block are numbered once, unless few texts are asked for
    different, where = np.unique(every, return_inverse=True) if len(asked) > FEW else (None, None)
    out = []
    for m in asked:
        foreign = np.array([label != m["label"] for label in labels], bool)
        if not foreign.any():
            continue
        own = _set(m["hashes"], m["counts"])
        if different is None:
            at = np.minimum(np.searchsorted(own[0], every), len(own[0]) - 1)
            hit = own[0][at] == every
            share = np.where(hit, (own[1] / own[1].sum())[at], 0.0) if weighted else None
        else:
            at = np.minimum(np.searchsorted(different, own[0]), len(different) - 1)
            met = different[at] == own[0]
            held = np.zeros(len(different), np.int8)
            held[at[met]] = 1
            hit = held[where]
            if weighted:
                of = np.zeros(len(different))
                of[at[met]] = (own[1] / own[1].sum())[met]
                share = of[where]
        both = run_sums(hit, sizes)
        near = both / np.maximum(1, sizes + len(own[0]) - both)
        unsure = np.zeros(len(block), bool)
        if weighted:
            most = run_sums(np.minimum(share, shares), sizes)
            unsure = (both > 0) & (near < similar) & (~plain | bool(m["counts"])) & (most >= similar - 1e-6)
        linked = np.zeros(len(block), bool)  # texts of a class that has its link
        for j in np.flatnonzero(((near >= similar) | unsure) & foreign).tolist():
            if linked[j]:
                continue
            if unsure[j]:
                near[j] = similarity(own, sets[j])
            if near[j] >= similar:
                linked[class_of == class_of[j]] = True
                ends = sorted(((m["node"], m["label"]), (block[j]["node"], labels[j])))
                out.append((ends[0][0], ends[1][0], ends[0][1], ends[1][1], float(near[j])))
    return out


def links_in_blocks(against: DataFrame, asked: DataFrame, sets: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Links (``a``, ``b``, their labels ``of_a`` and ``of_b``, ``similarity``) across labels between texts
    ``against`` and texts ``asked`` that share ``key``, ``block`` and ``ask`` (each with ``node`` and ``label``)."""
    names = ["a", "b", "of_a", "of_b", "similarity"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = _links_of_block(batch.column(0)[i].as_py(), similar)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[k] for f in found], t) for k, t in enumerate([*[pa.binary()] * 4, pa.float64()])], names=names,
                )

    columns = ["key", "block", "ask", "node", "label"]
    met = against.select(*columns, F.lit(0).alias("side")).unionAll(asked.select(*columns, F.lit(1).alias("side"))).join(sets, "node")
    gathered = met.groupBy("key", "block", "ask").agg(
        F.collect_list(F.struct("side", "node", "label", "hashes", "counts")).alias("members"), F.min("side").alias("least"), F.max("side").alias("most"),
    )
    return gathered.filter("least < most").select("members").mapInArrow(run, "a binary, b binary, of_a binary, of_b binary, similarity double")


def _parts(texts: Column, shingles: Column) -> Column:
    """Number of blocks for so many texts with so many shingles."""
    return F.greatest(F.ceil(texts / BLOCK), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1).cast("long"))


def _every(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), count - 1))


def links_to_pivots(pairs: DataFrame, sets: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Links among different pairs of a ``pivot`` (with its label ``top``) and a ``node`` (with its ``label``,
    whose set has ``size`` shingles): a pivot's set is sent once per block of its partners."""
    counts = cut_lineage(pairs.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("sizes"), F.min("top").alias("label")))
    of_pivot = F.col("pivot").alias("key")
    blocks = _parts(F.col("n"), F.col("sizes"))
    nothing = F.lit(0).cast("long").alias("ask")
    against = spread_join(pairs, counts.drop("label"), "pivot", "n").select(
        of_pivot, "node", "label", F.pmod(F.xxhash64("node", "pivot"), blocks).alias("block"), nothing,
    )
    asked = counts.select(of_pivot, F.col("pivot").alias("node"), "label", _every(blocks).alias("block"), nothing)
    return links_in_blocks(against, asked, sets, similar)


def links_across(open_: DataFrame, sets: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Links across classes in buckets (``key``, ``node``, ``label``, and of the bucket: ``main`` class, texts
    ``n`` and shingles ``sizes``, those outside the main class ``minor`` and ``minor_sizes``)."""
    blocks, asks = _parts(F.col("n"), F.col("sizes")), _parts(F.col("minor"), F.col("minor_sizes"))
    place = F.xxhash64("node", "key")
    against = open_.select("key", "node", "label", F.pmod(place, blocks).alias("block"), _every(asks).alias("ask"))
    asked = open_.filter(F.col("label") != F.col("main")).select(
        "key", "node", "label", _every(blocks).alias("block"), F.pmod(place, asks).alias("ask"),
    )
    return links_in_blocks(against, asked, sets, similar)


def components(edges: DataFrame) -> DataFrame:
    """Least node of the connected component of every node of ``edges`` (``a``, ``b``).

    Every round takes the least label among the neighbours and, after the first ``NEAR_ROUNDS``, then follows the
    label's own label; each round is one stored table, and rounds end when nothing changes. A node
    with more than ``HUB`` neighbours sends its label to ``SALTS`` places, between which they are dealt; so
    does every label to its nodes.
    """
    ends = cut_lineage(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(ends.groupBy("a").agg(
        F.least(F.min("b"), F.col("a")).alias("label"), F.count(F.lit(1)).alias("degree"),
    ).withColumnRenamed("a", "node"))
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    dealt = F.pmod(F.xxhash64("a"), F.lit(SALTS)).cast("int")
    hubs = labels.filter(F.col("degree") > HUB).select(F.col("node").alias("b"), F.lit(True).alias("_hub"), every.alias("_deal"))
    both = cut_lineage(ends.withColumn("_deal", dealt).join(hubs, ["b", "_deal"], "left").select(
        "a", "b", F.when(F.col("_hub"), F.col("_deal")).otherwise(0).alias("salt"),
    ))
    copies = F.explode(F.sequence(F.lit(0), F.when(F.col("degree") > HUB, SALTS - 1).otherwise(0)))
    rounds = 0
    while True:
        rounds += 1
        sent = labels.select(F.col("node").alias("b"), "label", copies.alias("salt"))
        near = both.join(sent, ["b", "salt"]).select(F.col("a").alias("node"), "label", F.lit(None).cast("binary").alias("old"), F.lit(None).cast("long").alias("degree"))
        stepped = near.unionAll(labels.select("node", "label", F.col("label").alias("old"), "degree")).groupBy("node").agg(
            F.min("label").alias("label"), F.max("old").alias("old"), F.max("degree").alias("degree"),
        )
        if rounds > NEAR_ROUNDS:
            used = labels.select(F.col("label").alias("node")).distinct()
            jump = labels.join(used, "node", "left_semi").select(F.col("node").alias("label"), F.col("label").alias("further"), every.alias("salt"))
            stepped = stepped.withColumns({"_before": F.col("old"), "salt": F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")}).join(
                jump.withColumnRenamed("label", "_before"), ["_before", "salt"],
            ).select("node", F.least("label", "further").alias("label"), "old", "degree")
        moved = cut_lineage(stepped)
        labels = moved.select("node", "label", "degree")
        if moved.filter(F.col("old") != F.col("label")).isEmpty():
            return labels.select("node", "label")


def _grown(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Labels with the links found since, whose classes are joined by their labels; the labels stand if there are none."""
    found = cut_lineage(found)
    if found.isEmpty():
        return labels
    moved = components(found.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
    further = moved.select(
        F.col("node").alias("label"), F.col("label").alias("further"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    again = labels.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(further, ["label", "salt"], "left").select(
        "node", F.coalesce("further", "label").alias("label"),
    )
    return cut_lineage(again.unionAll(moved.join(labels, "node", "left_anti")))


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def link_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that hold a text (``doc_id``, ``node``) and the label of every node that has a
    verified link (``node``, ``label``)."""
    rows = docs.filter(F.col("text").isNotNull()).select("doc_id", node_of(F.col("text")).alias("node"), "text")
    sketched = cut_lineage(bands_of(rows))
    nodes = cut_lineage(sketched.groupBy("node").agg(F.min("bands").alias("bands"), F.min("size").alias("size"), F.min("doc_id").alias("doc_id")))
    spread = nodes.select("node", "size", F.explode("bands").alias("key"))
    buckets = cut_lineage(spread.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("low"), F.max("node").alias("high")).filter("n > 1"))
    members = cut_lineage(spread_join(spread, buckets, "key", "n").select("key", "node", "size", "low"))

    # the sets of one row of each text that shares a bucket; its key may be null
    holders = nodes.join(members.select("node").distinct(), "node", "left_semi").select(F.col("node").alias("_node"), F.col("doc_id").alias("_held"))
    wanted = rows.join(holders, (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_held")), "left_semi")
    sets = cut_lineage(sets_of(wanted.select("node", "text")).groupBy("node").agg(F.min("hashes").alias("hashes"), F.min("counts").alias("counts")))

    def sides(pairs: DataFrame) -> DataFrame:
        one, other = F.col("pivot"), F.col("node")
        return pairs.withColumns({"a": F.least(one, other), "b": F.greatest(one, other)})

    tried = cut_lineage(sides(members.filter(F.col("node") != F.col("low")).select(F.col("low").alias("pivot"), "node", "size").distinct()))
    alone = tried.withColumns({"top": F.col("pivot"), "label": F.col("node")})
    labels = components(cut_lineage(links_to_pivots(alone, sets)))

    # the other end of every bucket that still holds several classes
    tops = _labelled(buckets.select(F.col("high").alias("node"), "key", "n"), labels).select("key", "n", F.col("node").alias("high"), F.col("label").alias("top"))
    known = cut_lineage(_labelled(members.select("key", "node", "size"), labels))
    other = spread_join(known, cut_lineage(tops), "key", "n").filter(F.col("top") != F.col("label"))
    second = cut_lineage(sides(other.select(F.col("high").alias("pivot"), "top", "node", "label", "size").distinct()).join(tried, ["a", "b"], "left_anti"))
    labels = _grown(labels, links_to_pivots(second, sets))

    # what is left: the texts outside the largest class of a bucket against all
    known = cut_lineage(_labelled(members.select("key", "node", "size"), labels))
    classes = known.groupBy("key", "label").agg(F.count(F.lit(1)).alias("texts"), F.sum("size").alias("sizes"))
    several = classes.groupBy("key").agg(
        F.count(F.lit(1)).alias("classes"), F.max(F.struct("texts", "sizes", "label")).alias("main"), F.sum("texts").alias("n"), F.sum("sizes").alias("sizes"),
    ).filter("classes > 1").select(
        "key", F.col("main.label").alias("main"), "n", "sizes", (F.col("n") - F.col("main.texts")).alias("minor"),
        (F.col("sizes") - F.col("main.sizes")).alias("minor_sizes"),
    )
    open_ = cut_lineage(spread_join(known.drop("size"), cut_lineage(several), "key", "n"))
    labels = _grown(labels, links_across(open_, sets))
    return sketched.select("doc_id", "node"), labels


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``class_id`` (the least key of its class)
    and ``n_texts`` (different texts of the class).

    Equal texts are one class, empty ones too; texts without words have no other
    link; a null text is a class of its own. Null keys give way to others. Columns
    other than ``doc_id`` and ``text`` are not read.
    """
    chosen = docs.select("doc_id", "text")
    membership, labels = link_classes(chosen)
    nodes = membership.groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    texts = cut_lineage(_labelled(nodes, labels))
    classes = texts.groupBy("label").agg(F.min("least").alias("class_id"), F.count(F.lit(1)).alias("n_texts"))
    many = cut_lineage(spread_join(texts, cut_lineage(classes), "label", "n_texts").select("node", "n", "class_id", "n_texts"))
    placed = spread_join(membership, many, "node", "n").select("doc_id", "class_id", "n_texts")
    alone = chosen.filter(F.col("text").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("n_texts"))
    return placed.unionAll(alone)


def one_per_class(docs: DataFrame) -> DataFrame:
    """One row of each class, that with the least key (null first), then the least digest
    of the text; of rows alike in both the least in the columns' order (as JSON where a column has no order).
    Null texts all stay. Columns are passed on."""
    membership, labels = link_classes(docs.select("doc_id", "text"))
    texts = _labelled(membership.groupBy("node").agg(F.min(F.struct("doc_id"))["doc_id"].alias("doc_id")), labels)

    def place(key: Column, node: Column) -> Column:
        return F.concat_ws(":", F.hex(node), key.cast("string"))

    chosen = texts.groupBy("label").agg(F.min(F.struct("doc_id", "node")).alias("k")).select(place(F.col("k.doc_id"), F.col("k.node")).alias("_place"))
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), place(F.col("doc_id"), node_of(F.col("text"))).alias("_place"),
        F.col("text").isNull().alias("_none"),
    )
    ordered = not any("map<" in kind or "variant" in kind for _, kind in docs.dtypes)
    least = F.min("row") if ordered else F.min_by("row", F.to_json("row"))
    single = held.filter(~F.col("_none")).join(chosen, "_place", "left_semi").groupBy("_place").agg(least.alias("row"))
    return single.select("row.*").unionAll(held.filter("_none").select("row.*"))
