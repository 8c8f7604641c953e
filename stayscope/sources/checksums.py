"""Digests of files and of content columns, recorded and verified as tables."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a file up to which it is one row; a longer one is read split by split.
WHOLE = 128 << 20
#: Bytes of a line from which a file cannot be read split by split.
LONGEST_LINE = 128 << 20
#: Files read split by split at the same time.
TOGETHER = 32
#: OpenSSL's names of the digests and their bytes.
KINDS = {"MD5": 16, "SHA256": 32}
#: More than OpenSSL's structs of these digests take (92 and 112 bytes).
STATE_BYTES = 256
#: Ends of names whose files the line reader unpacks.
PACKED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".zstd")
RECORDS = "name string, md5 string, sha256 string, bytes long"
#: What one task hands to the next: the digests so far, the bytes and lines in them, the last split's start.
STATE = "md5 binary, sha256 binary, fed long, lines long, start long"


def digests(content: Column) -> list[Column]:
    """md5, sha256 and size in bytes of a binary or text column."""
    return [
        F.md5(content).alias("md5"),
        F.sha2(content, 256).alias("sha256"),
        F.octet_length(content).cast("long").alias("bytes"),
    ]


def content_checksums(df: DataFrame, name: str, content: str) -> DataFrame:
    """One record per row: (name, md5, sha256, bytes)."""
    return df.select(F.col(name).alias("name"), *digests(F.col(content)))


def file_checksums(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One record per file under ``path``.

    A file of up to ``WHOLE`` bytes is one row. The digests of a longer one are
    handed from split to split, so no task reads or holds more than a split and
    a line; as digests are chains, its splits come one after another. A file
    that cannot be read so (see ``chained_checksums``) is one row, below 2 GB.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    long_ones = files.where(F.col("length") > WHOLE).select("path", "length").collect()
    records = _whole_checksums(files.where(F.col("length") <= WHOLE))
    if not long_ones:
        return records
    with ThreadPool(min(TOGETHER, len(long_ones))) as pool:
        chained = pool.starmap(partial(chained_checksums, _split_session(spark)), long_ones)
    found = [record for record in chained if record]
    left = [_literal_path(row["path"]) for row, record in zip(long_ones, chained, strict=True) if not record]
    if found:
        records = records.unionByName(spark.createDataFrame(found, RECORDS))
    if left:
        records = records.unionByName(_whole_checksums(spark.read.format("binaryFile").load(left)))
    return records


def _whole_checksums(files: DataFrame) -> DataFrame:
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return content_checksums(named, "name", "content")


def _split_session(spark: SparkSession) -> SparkSession:
    """A session set like ``spark`` but for one thing: more cores do not make splits shorter."""
    session = spark.newSession()
    given = session.conf.getAll
    for name, value in spark.conf.getAll.items():
        if given.get(name) != value:
            session.conf.set(name, value)
    session.conf.set("spark.sql.files.minPartitionNum", 1)
    return session


def _literal_path(path: str) -> str:
    """``path`` with the signs escaped that readers take for patterns."""
    return re.sub(r"([\\{}\[\]*?,])", r"\\\1", path)


def chained_checksums(
    spark: SparkSession, path: str, length: int
) -> tuple[str, str, str, int] | None:
    """The record of one file, one task per split in order of the splits.

    Lines cut at line feeds alone are the file's bytes. None if they are not or
    do not add up to ``length`` (the reader unpacks files of ``PACKED`` names and
    drops a byte order mark and, here, lines of ``LONGEST_LINE``), or if Python's
    OpenSSL does not show its calls.
    """
    if path.endswith(PACKED):
        return None
    try:
        state = {kind.lower(): _step(kind, "Init") for kind in KINDS} | {"fed": 0, "lines": 0, "start": -1}
    except (ImportError, AttributeError):
        return None
    reader = spark.read.option("mapreduce.input.linerecordreader.line.maxlength", LONGEST_LINE)
    lines = reader.text(_literal_path(path), lineSep="\n").select(
        F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary")
    )
    for split in range(lines.rdd.getNumPartitions()):
        states = lines.mapInArrow(partial(_feed, state), STATE).rdd
        [after] = spark.sparkContext.runJob(states, list, [split])
        state = after.asDict()
    if state["fed"] + 1 == length:
        state = _fed(state, b"\n")
    if state["fed"] != length:
        return None
    ends = [_step(kind, "Final", state[kind.lower()]).hex() for kind in KINDS]
    return path.rsplit("/", 1)[-1], *ends, length


def _feed(state: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state after the lines of one split; a line feed goes before all but a file's first."""
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = batch.column("start").to_numpy()
        if starts[0] < state["start"] or (np.diff(starts) < 0).any():
            raise ValueError("the splits of a file did not come in order")
        whole = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("value"))
        text = pc.binary_join(whole, b"\n")[0].as_buffer()
        if state["lines"]:
            state = _fed(state, b"\n")
        state = _fed(state, text) | {"lines": state["lines"] + batch.num_rows, "start": int(starts[-1])}
    kinds = {"md5": pa.binary(), "sha256": pa.binary()}
    yield pa.RecordBatch.from_pydict(
        {k: pa.array([v], kinds.get(k, pa.int64())) for k, v in state.items()}
    )


def _fed(state: dict, data: bytes | pa.Buffer) -> dict:
    data = pa.py_buffer(data)
    digests = {k.lower(): _step(k, "Update", state[k.lower()], data) for k in KINDS}
    return state | digests | {"fed": state["fed"] + data.size}


def _step(kind: str, step: str, state: bytes = b"", data: pa.Buffer | None = None) -> bytes:
    """One call of OpenSSL's digest: ``hashlib``, which runs on it, cannot hand on a digest half-done."""
    import _hashlib

    call: Callable[..., int] = getattr(ctypes.CDLL(_hashlib.__file__), f"{kind}_{step}")
    held = ctypes.create_string_buffer(state, STATE_BYTES)
    out = ctypes.create_string_buffer(KINDS[kind])
    if step == "Init":
        done = call(held)
    elif step == "Update":
        done = call(held, ctypes.c_void_p(data.address), ctypes.c_size_t(data.size))
    else:
        done = call(out, held)
    if done != 1:
        raise RuntimeError(f"{kind}_{step} failed")
    return out.raw if step == "Final" else held.raw


def save_checksums(records: DataFrame, path: str) -> str:
    records.write.mode("overwrite").json(path)
    return path


def load_checksums(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECORDS).json(path)


def verify_checksums(records: DataFrame, expected: DataFrame, digest: str = "md5") -> DataFrame:
    """(name, expected, actual, ok) for each expected digest (name, expected).

    Comparison ignores case and outer blanks; an empty expectation passes; a
    missing file does not.
    """
    wanted = F.lower(F.trim(F.coalesce("expected", F.lit(""))))
    actual = F.lower(F.trim(F.col(digest)))
    return expected.join(records.select("name", digest), "name", "left").select(
        "name",
        wanted.alias("expected"),
        actual.alias("actual"),
        ((wanted == "") | F.coalesce(actual == wanted, F.lit(False))).alias("ok"),
    )
