"""Token ids in binary files: frequency-ranked, byte-aligned, with control bytes apart.

A file is a run of segments of whole documents in ascending order. Every
segment is complete in itself:

====================  =====================================================
``SEGMENT`` header    magic, documents, ids, ranks (little-endian)
ranks                 uint32, the ids that occur, most frequent first, ties
                      by the smaller id; the position is the rank
document ids          one byte each (1: present), then int64 each
document lengths      uint32 each, ids of the document with its end id
control bytes         two bits per id: bytes of its rank less one
data bytes            the ranks, little-endian, 1 to 4 bytes each
====================  =====================================================

Ranks are counted over all ids of the segment, so writing takes one pass and a
task holds one segment at most, however long its partition is. Frequent ids
take one byte. Decoding looks up the four lengths of a control byte in a table
and gathers the data bytes with numpy.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayscope.llm.bytebpe import byte_encoder
from stayscope.llm.wordwise import as_texts, slices
from stayscope.session import cut_lineage, fresh_path

SEGMENT = struct.Struct("<8sIII")
MAGIC = b"RANKIDS1"

#: Ids after which a segment ends with its document.
SEGMENT_IDS = 4_000_000

#: Number of bytes of each of the four ids that a control byte tells.
LENGTHS_OF = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.uint8)

MANIFEST = "file string, part int, segment int, offset long, n_bytes long, n_docs long, n_ids long"


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks below 2**32."""
    wide = ranks.astype("<u4")
    length = 1 + (wide > 0xFF).astype(np.uint8) + (wide > 0xFFFF) + (wide > 0xFFFFFF)
    padded = np.zeros(-(-len(wide) // 4) * 4, np.uint8)
    padded[:len(wide)] = length - 1
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4) < length[:, None]
    return control.tobytes(), wide.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks again, by table lookup."""
    length = LENGTHS_OF[np.frombuffer(control, np.uint8)].ravel()[:n].astype(np.int64)
    begin = np.cumsum(length) - length
    raw = np.concatenate((np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)))
    out = raw[begin].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(length > k)
        out[more] |= raw[begin[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def segment_bytes(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    count = np.bincount(ids)
    present = np.flatnonzero(count)
    by_rank = present[np.lexsort((present, -count[present]))]
    rank_of = np.zeros(len(count), np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    control, data = pack(rank_of[ids])
    there = np.array([d is not None for d in doc_ids], np.uint8)
    keys = np.array([d or 0 for d in doc_ids], "<i8")
    return b"".join((
        SEGMENT.pack(MAGIC, len(doc_ids), len(ids), len(by_rank)), by_rank.astype("<u4").tobytes(),
        there.tobytes(), keys.tobytes(), lengths.astype("<u4").tobytes(), control, data,
    ))


def read_segment(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, lengths and all ids of a segment."""
    magic, docs, n, ranks = SEGMENT.unpack_from(raw)
    if magic != MAGIC:
        raise ValueError("not a segment of ranked ids")
    at = SEGMENT.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, kind, count, at)
        at += out.nbytes
        return out

    by_rank, there = take("<u4", ranks), take("u1", docs)
    keys, lengths = take("<i8", docs), take("<u4", docs)
    control = take("u1", -(-n // 4)).tobytes()
    ids = by_rank[unpack(control, raw[at:], n)] if n else np.zeros(0, np.uint32)
    return [k if t else None for k, t in zip(keys.tolist(), there.tolist(), strict=True)], lengths, ids


def write_id_files(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Encode whole texts and write them to ``folder`` in ascending order of ``doc_id``.

    Rows are dealt by ranges of the key (a hash of the text parts rows of one
    key), each task writes one file under a name of its own attempt, and the
    returned manifest, stored in the shared folder, names only the files of
    finished tasks. Null texts are empty; every document ends with ``end_id``;
    null keys come first; rows of one key follow the hash of their text, and
    repeated rows stay repeated. No rows give no file. Columns other than the
    two named are not read.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = byte_encoder(vocabulary), TaskContext.get()
        store, top = fs.FileSystem.from_uri(folder)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.ids"
        found, keys, lengths, ids, offset, out = [], [], [], [], 0, None

        def flush() -> None:
            nonlocal offset, out
            if out is None:
                store.create_dir(top, recursive=True)
                out = store.open_output_stream(f"{top}/{name}")
            every = np.concatenate(ids)
            raw = segment_bytes(keys, np.concatenate(lengths), every)
            out.write(raw)
            found.append((name, task.partitionId(), len(found), offset, len(raw), len(keys), len(every)))
            offset += len(raw)
            keys.clear(), lengths.clear(), ids.clear()

        for batch in (part for whole in batches for part in slices(whole, 1)):
            own, n = encoder.encode(as_texts(batch.column(1)))
            ends = np.cumsum(n)
            with_end = np.insert(own, ends, end_id)
            n, last, key = n + 1, 0, batch.column(0).to_pylist()
            ends = np.cumsum(n)
            while last < len(key):
                room = SEGMENT_IDS - sum(map(len, ids))
                begin = ends[last - 1] if last else 0
                to = min(len(key), last + 1 + int(np.searchsorted(ends[last:], begin + room)))
                keys += key[last:to]
                lengths.append(n[last:to])
                ids.append(with_end[begin:ends[to - 1]])
                last = to
                if sum(map(len, ids)) >= SEGMENT_IDS:
                    flush()
        if keys:
            flush()
        if out is not None:
            out.close()
        rows = list(zip(*found, strict=True)) or [[]] * 7
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(rows, (pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 4), strict=True)],
            names=[c.split()[0] for c in MANIFEST.split(", ")],
        )

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = chosen.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return cut_lineage(dealt.mapInArrow(write, MANIFEST))


def manifest_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``: the ids in all segments before.

    Files are summed first, so the one ordered window has a row per file.
    """
    files = manifest.groupBy("part").agg(F.sum("n_ids").alias("of_file"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("of_file").over(before), F.lit(0)).alias("file_start"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.join(files, "part").withColumn(
        "start", F.col("file_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0)),
    )


def read_id_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start`` (ids of all documents
    before it), ``n_tokens`` and ``ids_crc32`` over its ids as little-endian uint32."""

    def read(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = fs.FileSystem.from_uri(folder)
        for frame in frames:
            for row in frame.itertuples():
                with store.open_input_file(f"{top}/{row.file}") as file:
                    raw = file.read_at(row.n_bytes, row.offset)
                keys, lengths, ids = read_segment(raw)
                ends = np.cumsum(lengths, dtype=np.int64)
                flat = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(flat[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pd.DataFrame({
                    "doc_id": pd.array(keys, "Int64"), "start": row.start + ends - lengths,
                    "n_tokens": lengths.astype(np.int64), "ids_crc32": sums,
                })

    spread = manifest_starts(manifest).repartition(
        int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "part", "segment",
    )
    return spread.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def id_file_round(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write ``docs`` to fresh files in the shared folder and read them back."""
    folder = fresh_path(docs.sparkSession, "id-files")
    return read_id_files(write_id_files(docs, folder, vocabulary), folder)
