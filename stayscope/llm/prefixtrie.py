"""Trie of conversation prefixes in balanced parentheses, one bit vector per shard.

Conversations are rebuilt from shared openings, and every distinct sequence of first
turns is a node. A node is named by position-dependent sums of turn digests, so that a
conversation of any length is summed in chunks and never gathered. Nodes are put
in preorder by the chain they lie on (runs between branchings) and their depth, cut
into shards by ranges of that order, and a shard writes its nodes as parentheses. Blocks
of the bit vector keep least and greatest excess; ``findclose`` descends over them and
delimits the subtree of every node at once, the rank of leaf pairs counts its leaves, and a
cumulative array gives its savings.

Nodes whose subtree runs over the end of a shard, the spines, are merged afterwards: at
any depth open and close events alternate, so that an open node ends at the next close of
its depth, found by a window over one or two rows per depth and shard. Cumulative
numbers at both ends, shifted by the totals of the shards before, give its sums.

Keys that hold many rows (a first turn of a third of all conversations, a conversation
with a third of all turns) are joined as :func:`spread_join` says.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayscope.llm.spread import spread_join
from stayscope.llm.wordwise import ragged
from stayscope.session import cut_lineage

#: Conversations that share an opening, and the greatest number of turns shared.
FAMILY, SHARED = 20, 3

#: Turns of a conversation that are summed by one task; nodes of a shard; parentheses of a block.
CHUNK, SHARD, BLOCK = 1_024, 65_536, 64

#: Conversation ids hashed as one piece.
ENDS = 4_096

LANES = 4
ROOT = "0" * 8 * LANES
NO_ENDS = hashlib.sha256(b"").hexdigest()
WORD = r"[^\x20\x09-\x0D]+"


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns in rebuilt order (``conv_id``, ``d``, ``digest``, ``words``, ``size``) and conversations
    (``conv_id``, ``size``: their turns after rebuilding)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    ordered = turns.repartitionByRange("conv_id", "turn", "digest").sortWithinPartitions("conv_id", "turn", "digest")
    stored = cut_lineage(ordered.select("conv_id", "digest", "words", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("rid")))

    # a conversation may run over several partitions: one row for each of them
    runs = stored.groupBy("conv_id", "part").agg(F.min("rid").alias("first"), F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    runs = cut_lineage(runs.select("conv_id", "part", "first", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    own = F.col("conv_id")
    lengths = runs.groupBy("conv_id").agg(F.sum("n").alias("n"))
    described = lengths.select(
        "conv_id", "n", F.pmod(F.crc32(own.cast("string").cast("binary")), F.lit(SHARED + 1)).alias("h"), (own - own % FAMILY).alias("from"),
    )
    sizes = lengths.select(F.col("conv_id").alias("from"), F.col("n").alias("n_from"))
    got = F.least("h", F.coalesce("n_from", F.lit(0)))
    convs = cut_lineage(described.join(sizes, "from", "left").select(
        "conv_id", "from", "h", got.alias("got"), (got + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size"),
    ))
    placed = stored.join(runs.join(convs, "conv_id").select("conv_id", "part", "first", "before", "h", "got", "size"), ["conv_id", "part"])
    placed = placed.withColumn("at", F.col("rid") - F.col("first") + F.col("before") + 1)
    heads = placed.filter((F.col("at") <= SHARED) & (own % FAMILY == 0)).select(F.col("conv_id").alias("from"), "at", "digest", "words")
    borrowed = convs.filter("got > 0").join(heads, "from").filter("at <= got").select(
        "conv_id", F.col("at").alias("d"), "digest", "words", "size",
    )
    kept = placed.filter("at > h").select("conv_id", (F.col("at") - F.col("h") + F.col("got")).alias("d"), "digest", "words", "size")
    return borrowed.unionByName(kept), convs.select("conv_id", "size")


def _running(rows: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], how) -> DataFrame:
    """Running ``how`` (``F.sum`` or ``F.max``) of columns along ``order`` (from 1) per key: inside
    chunks of ``CHUNK``, then over the chunks, so that no task takes a whole key."""
    chunked = rows.withColumn("_chunk", F.floor((F.col(order) - 1) / CHUNK))
    inside = W.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    totals = chunked.groupBy(*keys, "_chunk").agg(*[how(c).alias(c) for c in columns])
    starts = totals.select(*keys, "_chunk", *[how(c).over(earlier).alias(f"_of_{c}") for c in columns]).filter("_chunk > 0")
    local = chunked.select(*[c for c in chunked.columns if c not in columns], *[how(c).over(inside).alias(c) for c in columns])
    joined = local.join(starts, [*keys, "_chunk"], "left")

    def both(c: str) -> Column:
        one, other = F.col(c), F.col(f"_of_{c}")
        return one + F.coalesce(other, F.lit(0)) if how is F.sum else F.greatest(one, other)

    return joined.withColumns({c: both(c) for c in columns}).drop("_chunk", *[f"_of_{c}" for c in columns])


def prefix_rows(turns: DataFrame) -> DataFrame:
    """Node and parent of every rebuilt turn: ``conv_id``, ``d``, ``node``, ``parent``, ``words``, ``ends``.

    The name of a prefix is the sum, in four lanes of 32 bits, of digests of its turns together with their positions.
    """
    code = F.md5(F.concat(F.col("d").cast("string"), F.lit(":"), F.col("digest")).cast("binary"))
    lanes = [f"_l{i}" for i in range(LANES)]
    own = [F.conv(F.substring("_code", 8 * i + 1, 8), 16, 10).cast("long") for i in range(LANES)]
    rows = turns.select("conv_id", "d", "words", (F.col("d") == F.col("size")).alias("ends"), code.alias("_code"))
    rows = rows.withColumns(dict(zip(lanes, own, strict=True)))
    summed = _running(rows, ["conv_id"], "d", lanes, F.sum)

    def name(columns: Sequence[Column]) -> Column:
        return F.lower(F.concat(*[F.lpad(F.hex(c.bitwiseAND(0xFFFFFFFF)), 8, "0") for c in columns]))

    return summed.select(
        "conv_id", "d", "words", "ends", name([F.col(c) for c in lanes]).alias("node"),
        name([F.col(c) - o for c, o in zip(lanes, own, strict=True)]).alias("parent"),
    )


def trie_nodes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Distinct prefixes: ``node``, ``parent``, ``depth``, ``conv_id`` (least member), ``n_convs``, ``words``,
    ``n_ends``, ``n_children``; the root is there if any conversation is."""
    found = rows.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("d").alias("depth"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.min("words").alias("words"), F.count_if("ends").alias("n_ends"),
    )
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count_if(F.col("size") == 0).alias("n_ends")).filter("n_convs > 0")
    root = root.select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs",
        F.lit(0).cast("long").alias("words"), "n_ends",
    )
    nodes = cut_lineage(found.withColumn("depth", F.col("depth").cast("long")).unionByName(root))
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    return cut_lineage(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))


def preorder(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """``nodes`` with ``chain``: a number by which, and then by depth, they are in preorder.

    A chain is a run of nodes without branching. Chains are ordered by the names of the
    chains above them, first to last, and their own: prefixes before what they lead.
    """
    forks = nodes.filter(f"n_children + if(n_ends > 0, 1, 0) > 1 OR node = '{ROOT}'").select(F.col("node").alias("parent"), "n_children").filter("n_children > 0")
    tops = cut_lineage(spread_join(nodes.filter("parent IS NOT NULL").select("parent", "node", "conv_id", "depth", "n_convs"), forks, "parent", "n_children"))
    # the nodes of a chain have one least member: the last top of that conversation at or above a node is its own
    marked = nodes.filter("parent IS NOT NULL").select("node", "conv_id", "depth").join(tops.select("node", F.lit(True).alias("_top")), "node", "left")
    marked = marked.withColumn("top", F.when(F.col("_top"), F.struct("depth", "node"))).drop("_top")
    chained = cut_lineage(_running(marked, ["conv_id"], "depth", ["top"], F.max).select("node", F.col("top.node").alias("top")))

    owners = tops.select("conv_id").distinct()
    above = spread_join(rows.select("node", "conv_id", "d"), tops.select("node", "n_convs"), "node", "n_convs").join(owners, "conv_id", "left_semi")
    paths = above.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("d", "node"))).alias("path"))
    upto = F.filter("path", lambda p: p["d"] <= F.col("depth"))
    named = tops.join(paths, "conv_id").select(F.col("node").alias("top"), F.array_join(F.transform(upto, lambda p: p["node"]), "").alias("path"))
    ranked = cut_lineage(named.repartitionByRange("path").sortWithinPartitions("path").select("top", F.monotonically_increasing_id().alias("chain")))
    lengths = chained.groupBy("top").agg(F.count(F.lit(1)).alias("_length"))
    placed = spread_join(chained, ranked.join(lengths, "top"), "top", "_length").select("node", "chain")
    return nodes.join(placed, "node", "left").withColumn("chain", F.coalesce("chain", F.lit(-1)))


class Parentheses:
    """Bit vector of consecutive nodes in preorder, with excess blocks.

    Depths count from the spine above the first node; closes may go below it. The last
    node is closed if it is known to be childless.
    """

    def __init__(self, depth: np.ndarray, last_closes: bool):
        closes = np.concatenate(([0], depth[:-1] - depth[1:] + 1))
        self.open_at = np.arange(len(depth)) + np.cumsum(closes)
        self.bits = np.zeros(int(self.open_at[-1]) + 1 + int(last_closes), np.int8)
        self.bits[self.open_at] = 1
        self.excess = np.cumsum(2 * self.bits.astype(np.int64) - 1)
        self.nodes_before = np.cumsum(self.bits) - self.bits
        padded = np.full(-(-len(self.bits) // BLOCK) * BLOCK, self.excess[-1])
        padded[:len(self.bits)] = self.excess
        self.blocks = padded.reshape(-1, BLOCK)
        # a tree over the blocks: least and greatest excess of 1, 2, 4, … of them
        self.low, self.high = [self.blocks.min(1)], [self.blocks.max(1)]
        while len(self.low[-1]) > 1:
            for levels, take in ((self.low, np.minimum), (self.high, np.maximum)):
                wide = levels[-1] if len(levels[-1]) % 2 == 0 else np.append(levels[-1], levels[-1][-1])
                levels.append(take(wide[::2], wide[1::2]))

    def _first_in(self, block: np.ndarray, after: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Position in the block, beyond ``after``, of the first excess that is ``wanted``; -1 if none."""
        out = np.full(len(block), -1)
        for at in range(0, len(block), 8_192):
            part = slice(at, at + 8_192)
            hit = (self.blocks[block[part]] == wanted[part, None]) & (np.arange(BLOCK) > after[part, None])
            out[part] = np.where(hit.any(1), hit.argmax(1), -1)
        return np.where(out >= 0, block * BLOCK + out, -1)

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """Position of the close of every open parenthesis; -1 if it is beyond this vector."""
        wanted = self.excess[at] - 1
        block = at // BLOCK
        found = self._first_in(block, at % BLOCK, wanted)
        rest = np.flatnonzero(found < 0)
        place, level, going = block[rest] + 1, np.zeros(len(rest), np.int64), np.ones(len(rest), bool)
        target, hit = wanted[rest], np.full(len(rest), -1)

        def holds(k: int, who: np.ndarray) -> np.ndarray:
            p = place[who]
            inside = p < len(self.low[k])
            q = np.minimum(p, len(self.low[k]) - 1)
            return inside & (self.low[k][q] <= target[who]) & (target[who] <= self.high[k][q])

        # up: to the first group of blocks to the right that holds the excess
        for k in range(len(self.low)):
            who = np.flatnonzero(going)
            yes = holds(k, who)
            level[who[yes]], going[who[yes]] = k, False
            # odd places may step to their right neighbour at the same level
            no = who[~yes]
            odd = no[place[no] % 2 == 1]
            even = no[place[no] % 2 == 0]
            place[odd] += 1
            place[even] += 1
            again = even[holds(k, even)] if len(even) else even
            level[again], going[again] = k, False
            left = np.setdiff1d(no, again, assume_unique=True)
            place[left] = (place[left] + 1) // 2
        # down: into the left half if it holds the excess
        for k in range(len(self.low) - 1, 0, -1):
            who = np.flatnonzero(~going & (level == k))
            place[who] *= 2
            level[who] = k - 1
            right = who[~holds(k - 1, who)]
            place[right] += 1
        who = np.flatnonzero(~going)
        hit[who] = self._first_in(place[who], np.full(len(who), -1), target[who])
        found[rest] = hit
        return found


NODE, CLOSE, WHOLE, ASKED = 0, 1, 2, 3
SHARD_FIELDS = (
    "kind int, seg long, depth long, last_depth long, node string, conv_id long, n_convs long, n_children long, parent_conv_id long, "
    "open boolean, leaves long, saved long"
)


def _arrow(batch: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    return batch.column(name).to_numpy() if isinstance(batch, pa.Table) else batch.column(name).to_numpy(zero_copy_only=False)


def shard_rows(nodes: pa.Table, seg: int) -> pa.RecordBatch:
    """What a shard of consecutive nodes gives: its nodes, with sums where they close inside;
    closes of nodes opened before it; depths where a parent lies before it; its totals.

    Sums of open nodes, closes and the shard itself are cumulative numbers from the shard's start.
    """
    depth, conv = _arrow(nodes, "depth"), _arrow(nodes, "conv_id")
    n_convs, n_children, words = (_arrow(nodes, c) for c in ("n_convs", "n_children", "words"))
    m = len(depth)
    vector = Parentheses(depth, n_children[-1] == 0)
    # a leaf is an open followed by its close
    leaf = np.zeros(m, np.int64)
    follows = vector.open_at + 1 < len(vector.bits)
    leaf[follows] = vector.bits[vector.open_at[follows] + 1] == 0
    leaves, saved = (np.concatenate(([0], np.cumsum(v))) for v in (leaf, (n_convs - 1) * words))
    close = vector.findclose(vector.open_at)
    closed = close >= 0
    behind = np.where(closed, vector.nodes_before[np.maximum(close, 0)], 0)
    own_leaves = np.where(closed, leaves[behind] - leaves[:-1], leaves[:-1])
    own_saved = np.where(closed, saved[behind] - saved[:-1], saved[:-1])

    # the parent is the last node before that is one level higher
    order = np.lexsort((np.arange(m), depth))
    key, low = depth * m + np.arange(m), (depth - 1) * m + np.arange(m)
    at = np.searchsorted(key[order], low) - 1
    before = order[np.maximum(at, 0)]
    inside = (at >= 0) & (depth[before] == depth - 1)
    asked = np.unique(depth[~inside & (depth > 0)] - 1)

    # closes of the spine: levels by which the least depth so far falls
    least = np.minimum.accumulate(depth)
    falls = np.flatnonzero(np.diff(least) < 0) + 1
    by = least[falls - 1] - least[falls]
    levels, where = ragged(least[falls], by), np.repeat(falls, by)

    kinds = np.repeat([NODE, CLOSE, ASKED, WHOLE], [m, len(levels), len(asked), 1])
    rest = len(kinds) - m

    def filled(values: np.ndarray, mask: np.ndarray | None = None) -> pa.Array:
        whole = np.concatenate((values, np.zeros(rest, np.int64)))
        hidden = np.concatenate((np.zeros(m, bool) if mask is None else mask, np.ones(rest, bool)))
        return pa.array(whole, pa.int64(), mask=hidden)

    nothing = np.zeros(len(asked), np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(kinds.astype(np.int32)), pa.array(np.full(len(kinds), seg, np.int64)),
        pa.array(np.concatenate((depth, levels, asked, depth[:1]))), pa.array(np.full(len(kinds), depth[-1])),
        pa.array([*nodes.column("node").to_pylist(), *[None] * rest], pa.string()),
        filled(conv), filled(n_convs), filled(n_children), filled(conv[before], ~inside),
        pa.array(np.concatenate((~closed, np.zeros(rest, bool)))),
        pa.array(np.concatenate((own_leaves, leaves[where], nothing, leaves[-1:]))),
        pa.array(np.concatenate((own_saved, saved[where], nothing, saved[-1:]))),
    ], names=[f.split()[0] for f in SHARD_FIELDS.split(", ")])


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive nodes of a partition, ``SHARD`` or little more at a time."""
    first, held, n = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= SHARD:
            yield shard_rows(pa.Table.from_batches(held), first)
            first, held, n = first + 1, [], 0
    if n:
        yield shard_rows(pa.Table.from_batches(held), first)


def subtree_sums(placed: DataFrame) -> DataFrame:
    """``node``, ``depth``, ``conv_id``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves`` and
    ``saved_tokens`` of the nodes of :func:`preorder`."""
    columns = ["depth", "node", "conv_id", "n_convs", "n_children", "words"]
    ordered = placed.select("chain", *columns).repartitionByRange("chain", "depth").sortWithinPartitions("chain", "depth")
    done = cut_lineage(ordered.select(*columns).mapInArrow(_shards, SHARD_FIELDS))

    # one row per shard: cumulative numbers before it, and the depth where the one before it ended
    line = W.orderBy("seg")
    before = line.rowsBetween(W.unboundedPreceding, -1)
    shards = cut_lineage(done.filter(F.col("kind") == WHOLE).select(
        "seg", "depth", F.lag("last_depth").over(line).alias("ended"),
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("leaves", "saved")],
        *[F.sum(c).over(line.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias(f"{c}_all") for c in ("leaves", "saved")],
    ))
    shifted = done.filter((F.col("kind") == CLOSE) | (F.col("kind") == ASKED) | F.col("open")).join(shards.drop("depth", "ended"), "seg").select(
        "kind", "seg", "depth", "conv_id", "open", *[(F.col(c) + F.col(f"{c}_before")).alias(c) for c in ("leaves", "saved")], "leaves_all", "saved_all",
    )
    borders = shards.filter("ended >= depth").select(
        F.lit(CLOSE).alias("kind"), "seg", F.explode(F.sequence("depth", "ended")).alias("depth"), F.lit(None).cast("long").alias("conv_id"), F.lit(False).alias("open"),
        F.col("leaves_before").alias("leaves"), F.col("saved_before").alias("saved"), "leaves_all", "saved_all",
    )
    # within a shard a close of the spine comes before a node that stays open, and a parent asked for before both
    rank = F.when(F.col("kind") == ASKED, 0).when(F.col("kind") == CLOSE, 1).otherwise(2)
    events = W.partitionBy("depth").orderBy("seg", rank)
    following = events.rowsBetween(1, W.unboundedFollowing)

    def closing(c: str) -> Column:
        met = F.first(F.when(F.col("kind") == CLOSE, F.col(c)), ignorenulls=True).over(following)
        return F.coalesce(met, F.col(f"{c}_all")) - F.col(c)

    spine = cut_lineage(shifted.unionByName(borders).select(
        "kind", "seg", "depth", closing("leaves").alias("n_leaves"), closing("saved").alias("saved_tokens"),
        F.last(F.when(F.col("open"), F.col("conv_id")), ignorenulls=True).over(events.rowsBetween(W.unboundedPreceding, -1)).alias("opened"),
    ))
    ended = spine.filter(F.col("kind") == NODE).select("seg", "depth", F.lit(True).alias("open"), "n_leaves", "saved_tokens")
    asked = spine.filter(F.col("kind") == ASKED).select("seg", (F.col("depth") + 1).alias("depth"), "opened")
    # of a depth at most one node of a shard stays open
    nodes = done.filter(F.col("kind") == NODE).join(asked, ["seg", "depth"], "left").join(ended, ["seg", "depth", "open"], "left")
    return nodes.select(
        "node", "depth", "conv_id", F.coalesce("parent_conv_id", "opened").alias("parent_conv_id"), "n_convs", "n_children",
        F.coalesce("n_leaves", "leaves").alias("n_leaves"), F.coalesce("saved_tokens", "saved").alias("saved_tokens"),
    )


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 (``ends_sha256``) of the decimal ids that end at a node, ascending and comma-joined.

    Ids are first joined in runs of ``ENDS`` wherever the range order puts them; the task
    that digests a node takes one row per run.
    """

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(node: str, ids: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node]), pa.array(ids[:1], pa.int64()), pa.array([",".join(map(str, ids))])], names=["node", "first", "ids"])

        now, held = None, []
        for batch in batches:
            for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (node != now or len(held) == ENDS):
                    yield packed(now, held)
                    held = []
                now = node
                held.append(conv)
        if held:
            yield packed(now, held)

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, hashlib.sha256()
        for batch in batches:
            done = []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if node != now:
                    if now is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = node, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.string())], names=["node", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])

    ordered = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    joined = ordered.mapInArrow(runs, "node string, first long, ids string")
    return joined.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digests, "node string, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id`` (least member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Turns are ordered by ``turn``, null first, equal ones by the digest of role and text;
    repeated rows are turns of their own. Null roles and texts are empty; rows without a
    ``conv_id`` belong to no conversation and are left out. An empty table has no root. Columns other than
    these four are not read.
    """
    turns, convs = numbered_turns(conversations)
    rows = cut_lineage(prefix_rows(turns))
    nodes = trie_nodes(rows, convs)
    sums = subtree_sums(preorder(nodes, rows))
    ends = rows.filter("ends").select("node", "conv_id").unionByName(convs.filter("size = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    return sums.join(end_digests(ends), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
