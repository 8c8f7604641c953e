"""Fill-in-middle texts by secondary sort: pieces of documents, put in output order by Spark.

Documents are cut into lines, and lines into a prefix, a middle and a suffix at
places drawn from the key. A task never holds an output text: it sends pieces (runs of
whole lines up to ``PIECE_BYTES``; a longer line is cut) keyed by document and position
in the output. Spark partitions them by document and sorts inside partitions, and a
stream over the sorted pieces feeds one digest per document. The same stream reads the
markers back from the output bytes and gives every byte run its place in the
original; a second sort, inside the same partitions and without another shuffle, puts
them in that order for the digest of the restored text.

Pieces of equal rows meet at equal positions, so equal rows are worked on once per
input partition and counted. The input partition is part of the key: a row
repeated on a third of the table spreads over as many tasks as read it.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.llm.wordwise import slices

#: Seed of the draws, per cent of texts that are transformed, and per cent of those in suffix-first form.
SEED, RATE, SUFFIX_FIRST = 7, 100, 50

#: Marks of prefix, suffix and middle.
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}

#: Order of the parts in each form, and in the original.
FORMS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
ORIGINAL = ("prefix", "middle", "suffix")

PIECE_BYTES = 32_768

#: Pieces that a task gives back at once.
BATCH = 512


def draws(doc_id: object, seed: int = SEED) -> list[int]:
    """Four 32-bit numbers from the key; a null key counts as the empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def plan(doc_id: object, text: str, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST):
    """Number of lines, form, and the parts of the text by name (only ``whole`` if plain)."""
    ends = _line_ends(text)
    if text and not text.endswith("\n"):
        ends.append(len(text) - 1)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(m.decode() in text for m in MARKS.values()) or h3 % 100 >= rate:
        return n, "plain", {"whole": text}
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[k - 1] + 1 if k else 0 for k in (first, second))
    return n, "spm" if h4 % 100 < suffix_first else "psm", {"prefix": text[:a], "middle": text[a:b], "suffix": text[b:]}


def _line_ends(text: str) -> list[int]:
    ends, at = [], text.find("\n")
    while at >= 0:
        ends.append(at)
        at = text.find("\n", at + 1)
    return ends


def cut(part: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """Runs of whole lines of at most ``size`` bytes; a line beyond it is cut. At least one, perhaps empty."""
    at = 0
    while len(part) - at > size:
        end = part.rfind(b"\n", at, at + size) + 1 or at + size
        yield part[at:end]
        at = end
    yield part[at:] if at else part


class MarkReader:
    """Reads the parts of an output back from its bytes, piece by piece.

    ``feed`` gives (part, bytes) as far as they are certain; ``end`` the rest. Texts
    that hold a mark stay plain, so the marks found are those that were set.
    """

    def __init__(self, form: str):
        self.rest = list(FORMS.get(form, ()))
        self.part = "whole"
        self.held = b""

    def feed(self, piece: bytes) -> Iterator[tuple[str, bytes]]:
        held = self.held + piece
        while self.rest:
            at = held.find(MARKS[self.rest[0]])
            if at < 0:
                break
            if at:
                yield self.part, held[:at]
            self.part = self.rest.pop(0)
            held = held[at + len(MARKS[self.part]):]
        # a mark may still be cut in two
        keep = min(len(held), 2) if self.rest else 0
        if len(held) > keep:
            yield self.part, held[:len(held) - keep]
        self.held = held[len(held) - keep:]

    def end(self) -> Iterator[tuple[str, bytes]]:
        if self.held:
            yield self.part, self.held


def _packed(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of at most ``BATCH`` rows."""
    rows = iter(rows)
    while held := list(itertools.islice(rows, BATCH)):
        columns = zip(*held, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _streamed(
    batches: Iterable[pa.RecordBatch], found: Callable[[Iterable[tuple]], Iterator[tuple]], at: int, fields_of: Callable[[pa.DataType], list],
) -> Iterator[pa.RecordBatch]:
    """The rows that ``found`` makes of a stream; column ``at`` holds the key, whose type is passed on."""
    batches = (b for b in batches if b.num_rows)
    for first in batches:
        schema = pa.schema(fields_of(first.schema.types[at]))
        yield from _packed(found(_rows(itertools.chain([first], batches))), schema)


def _key(doc_id: object, text: bytes) -> bytes:
    """Identity of a row: its key and text."""
    return hashlib.blake2b(f"{'null' if doc_id is None else repr(doc_id)}\0".encode() + text, digest_size=16).digest()


FACTS = "n long, form string, prefix_chars long, middle_chars long"
FACT_FIELDS = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
ROW_FIELDS = [("part", pa.int32()), ("key", pa.binary())]


def output_pieces(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """The output texts in pieces: ``part``, ``key``, ``pos``, ``doc_id``, ``n``, ``form``, ``prefix_chars``,
    ``middle_chars``, ``piece``; partitioned by row and sorted by ``pos`` within one.

    The joined pieces of a row are its output. Facts stand on the first piece (``pos`` 0)
    only. Null texts are empty and have one empty piece; equal rows read by one task have
    every piece as often as there are rows. Columns other than ``doc_id`` and ``text`` are not read.
    """

    def pieces(batch: pa.RecordBatch) -> Iterator[tuple]:
        for part, doc_id, text in _rows([batch]):
            text = text or ""
            n, form, parts = plan(doc_id, text, seed, rate, suffix_first)
            facts = (n, form, *((None, None) if form == "plain" else (len(parts["prefix"]), len(parts["middle"]))))
            key, pos = _key(doc_id, text.encode()), 0
            for name in FORMS.get(form, ("whole",)):
                for piece in cut(MARKS.get(name, b"") + parts[name].encode()):
                    yield (part, key, pos, doc_id, *(facts if pos == 0 else (None,) * 4), piece)
                    pos += 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2)):
            fields = [*ROW_FIELDS, ("pos", pa.int64()), ("doc_id", batch.schema.types[1]), *FACT_FIELDS, ("piece", pa.binary())]
            yield from _packed(pieces(batch), pa.schema(fields))

    kind = docs.schema["doc_id"].dataType.simpleString()
    cut_up = docs.select(F.spark_partition_id().alias("part"), "doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"part int, key binary, pos long, doc_id {kind}, {FACTS}, piece binary"
    )
    return cut_up.repartition("part", "key").sortWithinPartitions("part", "key", "pos")


def read_back(pieces: DataFrame) -> DataFrame:
    """Pieces of the original from sorted pieces of the output, sorted in turn.

    Per row first a head (``place`` -1) with its facts, ``output_sha256`` and the number of
    equal rows (``copies``), then what the marks in the output bytes show: ``place``
    (of the part in the original), ``seq`` and ``piece``.
    """
    places = {name: i for i, name in enumerate(ORIGINAL)} | {"whole": 0}

    def found(rows: Iterable[tuple]) -> Iterator[tuple]:
        now, facts, copies, last, seq = None, None, 0, -1, 0
        digest, reader = hashlib.sha256(), MarkReader("plain")
        nothing = (None,) * 7

        def finish() -> Iterator[tuple]:
            for name, piece in reader.end():
                yield (*now, places[name], seq, *nothing, piece)
            yield (*now, -1, 0, *facts, copies, digest.hexdigest(), None)

        for part, key, pos, *own, piece in rows:
            if (part, key) != now:
                if now is not None:
                    yield from finish()
                now, facts, copies, last, seq = (part, key), own, 0, -1, 0
                digest, reader = hashlib.sha256(), MarkReader(own[2])
            copies += pos == 0
            if pos == last:
                continue
            last = pos
            digest.update(piece)
            for name, chunk in reader.feed(piece):
                yield (*now, places[name], seq, *nothing, chunk)
                seq += 1
        if now is not None:
            yield from finish()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _streamed(batches, found, 3, lambda kind: [
            *ROW_FIELDS, ("place", pa.int32()), ("seq", pa.int64()), ("doc_id", kind), *FACT_FIELDS,
            ("copies", pa.int64()), ("output_sha256", pa.string()), ("piece", pa.binary()),
        ])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    chunks = pieces.mapInArrow(
        run, f"part int, key binary, place int, seq long, doc_id {kind}, {FACTS}, copies long, output_sha256 string, piece binary"
    )
    # the rows of a document are in one partition already: this sorts without an exchange
    return chunks.sortWithinPartitions("part", "key", "place", "seq")


def restored_digests(chunks: DataFrame) -> DataFrame:
    """Per row of the documents: its facts, ``output_sha256`` and ``restored_sha256``."""

    def found(rows: Iterable[tuple]) -> Iterator[tuple]:
        head, copies, output, digest = None, 0, None, hashlib.sha256()
        for _, _, place, _, *facts, n_rows, sha, piece in rows:
            if place < 0:
                if head is not None:
                    yield from itertools.repeat((*head, output, digest.hexdigest()), copies)
                head, copies, output, digest = facts, n_rows, sha, hashlib.sha256()
            else:
                digest.update(piece)
        if head is not None:
            yield from itertools.repeat((*head, output, digest.hexdigest()), copies)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _streamed(batches, found, 4, lambda kind: [
            ("doc_id", kind), *FACT_FIELDS, ("output_sha256", pa.string()), ("restored_sha256", pa.string()),
        ])

    kind = chunks.schema["doc_id"].dataType.simpleString()
    return chunks.mapInArrow(run, f"doc_id {kind}, {FACTS}, output_sha256 string, restored_sha256 string")


def infill_table(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` (null if
    plain), ``output_sha256`` and ``restored_sha256``.

    Null texts are empty, and a null key draws as the empty text does. Repeated rows stay;
    other columns are not read. An empty table gives an empty one.
    """
    return restored_digests(read_back(output_pieces(docs, seed, rate, suffix_first)))


def infill_texts(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """The output texts themselves: ``doc_id``, ``form``, ``output``, one row per row of ``docs``."""

    def found(rows: Iterable[tuple]) -> Iterator[tuple]:
        now, head, held, copies, last = None, (), [], 0, -1
        for part, key, pos, doc_id, _, form, _, _, piece in rows:
            if (part, key) != now:
                if now is not None:
                    yield from itertools.repeat((*head, b"".join(held).decode()), copies)
                now, head, held, copies, last = (part, key), (doc_id, form), [], 0, -1
            copies += pos == 0
            if pos != last:
                held.append(piece)
            last = pos
        if now is not None:
            yield from itertools.repeat((*head, b"".join(held).decode()), copies)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _streamed(batches, found, 3, lambda kind: [("doc_id", kind), ("form", pa.string()), ("output", pa.string())])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return output_pieces(docs, seed, rate, suffix_first).mapInArrow(run, f"doc_id {kind}, form string, output string")
