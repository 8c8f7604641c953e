"""Token counts that follow edits: a segment tree of leaves per document.

A document is cut into leaves at blanks that a visible character follows. No
pre-token crosses such a blank, whatever stands before it, so the tokens of the
document are the tokens of its leaves. The tree keeps the count of every leaf
and the sums above. An edit re-encodes only the leaves it touches; if the new
content no longer starts with a blank and a visible character, the leaf before
it joins in as boundary context. Then the sums on the way to the root change.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.llm.bytebpe import byte_encoder
from stayscope.llm.wordwise import as_texts, slices

#: Characters after which a leaf ends at the next safe blank.
LEAF_CHARS = 512

EDITS = "array<struct<begin:int,length:int,put:string>>"
EDIT_LIST = pa.list_(pa.struct([("begin", pa.int32()), ("length", pa.int32()), ("put", pa.string())]))
TREES = "leaf_chars array<int>, tree array<int>"
COUNTS = (
    "`{key}` {kind}, tokens_before long, tokens_after long, n_edits long, n_leaves long, "
    "leaves_encoded long, chars_encoded long, " + TREES
)

MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")
SECRET = re.compile(r"(?<== \")[0-9A-Za-z_\-]{16,}(?=\")")


def leaf_cuts(text: str, leaf_chars: int = LEAF_CHARS) -> list[int]:
    """Starts of all leaves but the first."""
    cuts, at = [], text.find(" ", leaf_chars)
    while 0 <= at < len(text) - 1:
        if text[at + 1].isspace():
            at = text.find(" ", at + 1)
        else:
            cuts.append(at)
            at = text.find(" ", at + leaf_chars)
    return cuts


def tree_of(counts: Sequence[int]) -> list[int]:
    """Sums of a binary tree in level order; the leaves start at half its length.

    A tree over n leaves has the next power of two as its width; empty places are 0.
    """
    width = 1
    while width < len(counts):
        width *= 2
    tree = np.zeros(2 * width, np.int64)
    tree[width:width + len(counts)] = counts
    while width > 1:
        width //= 2
        tree[width:2 * width] = tree[2 * width:4 * width].reshape(-1, 2).sum(1)
    return tree.tolist()


def put_leaf(tree: list[int], leaf: int, count: int) -> None:
    """Set one leaf and mend the sums above it."""
    at = len(tree) // 2 + leaf
    change = count - tree[at]
    while at:
        tree[at] += change
        at //= 2


def usable_edits(edits, size: int) -> list[tuple[int, int, str]]:
    """Edits in order of position, inside the text; one that begins before the
    end of the edit ahead of it is left out, as is one with a null position."""
    out, free = [], 0
    for e in sorted((e for e in edits or () if e and e["begin"] is not None), key=lambda e: (e["begin"], e["length"] or 0)):
        begin, end = e["begin"], min(size, e["begin"] + max(0, e["length"] or 0))
        if free <= begin <= size:
            out.append((begin, end, e["put"] or ""))
            free = max(end, free)
    return out


def touched_regions(text: str, starts: list[int], edits: list[tuple[int, int, str]]):
    """Runs of leaves to encode anew: first leaf, leaf after the last, new content.

    ``starts`` holds the leaf starts and the length of the text.
    """
    last = len(starts) - 2
    leaf_of = lambda p: max(0, min(last, int(np.searchsorted(starts, p, "right")) - 1))
    regions: list[list] = []
    for begin, end, put in edits:
        first, to = leaf_of(begin), leaf_of(max(begin, end - 1)) + 1
        if regions and first < regions[-1][1]:
            regions[-1][1] = max(to, regions[-1][1])
            regions[-1][2].append((begin, end, put))
        else:
            regions.append([first, to, [(begin, end, put)]])
    done: list[list] = []
    for first, to, own in regions:
        while True:
            if done and first < done[-1][1]:
                first, own = done[-1][0], done[-1][3] + own
                done.pop()
            at, parts = starts[first], []
            for begin, end, put in own:
                parts += [text[at:begin], put]
                at = end
            new = "".join([*parts, text[at:starts[to]]])
            safe = first == 0 or new == "" or (new[0] == " " and len(new) > 1 and not new[1].isspace())
            if safe:
                break
            first -= 1
        done.append([first, to, new, own])
    return [(first, to, new) for first, to, new, _ in done]


def build_trees(docs: DataFrame, vocabulary: str, text: str = "text", leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """Add ``leaf_chars`` and ``tree`` to every row; a null text is one empty leaf.

    Both columns are replaced if the table has them; all others are passed on.
    """
    kept = docs.drop("leaf_chars", "tree")
    names = [*kept.columns, "leaf_chars", "tree"]
    at = names.index(text)

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _build(batches, at, names, vocabulary, leaf_chars)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(build, f"{fields}, {TREES}")


def _build(batches: Iterable[pa.RecordBatch], at: int, names: Sequence[str], vocabulary: str, leaf_chars: int) -> Iterator[pa.RecordBatch]:
    encoder = byte_encoder(vocabulary)
    for batch in (part for whole in batches for part in slices(whole, at)):
        leaves, sizes = [], []
        for t in as_texts(batch.column(at)).to_pylist():
            bounds = [0, *leaf_cuts(t, leaf_chars), len(t)]
            leaves += [t[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
            sizes.append(np.diff(bounds).tolist())
        counts, done, trees = encoder.count(pa.array(leaves, pa.large_string())), 0, []
        for own in sizes:
            trees.append(tree_of(counts[done:done + len(own)]))
            done += len(own)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(sizes, pa.list_(pa.int32())), pa.array(trees, pa.list_(pa.int32()))],
            names=names,
        )


def attach_edits(docs: DataFrame, edits: DataFrame, key: str = "doc_id") -> DataFrame:
    """Gather a table (key, begin, length, put) into an ``edits`` column of ``docs``.

    Edits are summed per document before the join. Rows that share a key get the
    same edits; documents without edits get null; edits with a null or unknown
    key are left out.
    """
    gathered = edits.groupBy(F.col(key).alias(key)).agg(
        F.collect_list(F.struct(F.col("begin").cast("int"), F.col("length").cast("int"), F.col("put"))).alias("edits"),
    )
    return docs.drop("edits").join(gathered, key, "left")


def apply_edits(trees: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts after the edits of each row, from the kept trees.

    Takes ``key``, ``text``, ``edits``, ``leaf_chars`` and ``tree``. Returns the
    key, ``tokens_before``, ``tokens_after``, ``n_edits`` applied, ``n_leaves``,
    ``leaves_encoded`` anew, ``chars_encoded`` anew, and the new ``leaf_chars``
    and ``tree``: merged leaves keep their place, with nothing in the places
    after the first. Null or empty edits leave a row as it is.
    """
    kind = trees.schema[key].dataType.simpleString()

    def update(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _update(batches, key, vocabulary)

    chosen = trees.select(key, text, F.col("edits").cast(EDITS), "leaf_chars", "tree")
    return chosen.mapInArrow(
        update, COUNTS.format(key=key, kind=kind),
    )


def _update(batches: Iterable[pa.RecordBatch], key: str, vocabulary: str) -> Iterator[pa.RecordBatch]:
    encoder = byte_encoder(vocabulary)
    for batch in (part for whole in batches for part in slices(whole, 1)):
        texts = as_texts(batch.column(1))
        edits, sizes, sums = (batch.column(i).to_pylist() for i in (2, 3, 4))
        work, fresh, applied = [], [], [0] * len(texts)
        for i, own in enumerate(edits):
            if not own:
                continue
            t = texts[i].as_py()
            own = usable_edits(own, len(t))
            applied[i] = len(own)
            starts = np.concatenate(([0], np.cumsum(sizes[i]))).tolist()
            for first, to, new in touched_regions(t, starts, own):
                work.append((i, first, to, len(new)))
                fresh.append(new)
        before = [s[1] for s in sums]
        encoded, chars = [0] * len(texts), [0] * len(texts)
        counts = encoder.count(pa.array(fresh, pa.large_string())).tolist() if fresh else []
        for (i, first, to, n), count in zip(work, counts, strict=True):
            encoded[i] += to - first
            chars[i] += n
            for leaf in range(first, to):
                put_leaf(sums[i], leaf, count if leaf == first else 0)
                sizes[i][leaf] = n if leaf == first else 0
        ints = lambda v: pa.array(v, pa.int64())
        lists = lambda v: pa.array(v, pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), ints(before), ints([s[1] for s in sums]), ints(applied),
             ints([len(s) for s in sizes]), ints(encoded), ints(chars), lists(sizes), lists(sums)],
            names=[key, "tokens_before", "tokens_after", "n_edits", "n_leaves", "leaves_encoded",
                   "chars_encoded", "leaf_chars", "tree"],
        )


def cleaning_edits(text: str) -> list[tuple[int, int, str]]:
    """Edits that clean a text: mail addresses and quoted secrets masked, lines
    equal to an earlier line (with their line end) taken out."""
    out = [(m.start(), m.end() - m.start(), "[mail]") for m in MAIL.finditer(text)] if "@" in text else []
    if '= "' in text:
        out += [(m.start(), m.end() - m.start(), "[secret]") for m in SECRET.finditer(text)]
    if "\n" in text:
        seen, at, gone = set(), 0, []
        for line in text.split("\n"):
            if line and line in seen:
                gone.append((at - 1, len(line) + 1, ""))
            seen.add(line)
            at += len(line) + 1
        if gone:
            out = [e for e in out if not any(b <= e[0] < b + n for b, n, _ in gone)] + gone
    return sorted(out)


def with_cleaning_edits(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``edits`` from :func:`cleaning_edits` to every row."""
    kept = docs.drop("edits")
    names = [*kept.columns, "edits"]
    at = names.index(text)

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _find(batches, at, names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(find, f"{fields}, edits {EDITS}")


def _find(batches: Iterable[pa.RecordBatch], at: int, names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, at)):
        found = [
            [{"begin": b, "length": n, "put": p} for b, n, p in cleaning_edits(t)]
            for t in as_texts(batch.column(at)).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, EDIT_LIST)], names=names)


def cleaned_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Trees of all texts, their cleaning edits, and the counts after them, in one pass.

    ``docs`` has ``doc_id`` and ``text``; the steps are those of
    :func:`with_cleaning_edits`, :func:`build_trees` and :func:`apply_edits`.
    """
    chosen = docs.select("doc_id", "text")
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edited = _find(batches, 1, ["doc_id", "text", "edits"])
        trees = _build(edited, 1, ["doc_id", "text", "edits", "leaf_chars", "tree"], vocabulary, LEAF_CHARS)
        return _update(trees, "doc_id", vocabulary)

    return chosen.mapInArrow(run, COUNTS.format(key="doc_id", kind=kind))


def edited_text(text: str, edits: list[tuple[int, int, str]]) -> str:
    """The text after its usable edits."""
    at, parts = 0, []
    for begin, end, put in edits:
        parts += [text[at:begin], put]
        at = end
    return "".join([*parts, text[at:]])
