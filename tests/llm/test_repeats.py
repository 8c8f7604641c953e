"""Repeated passages against a set of all windows, and the merge against plain sorting."""

import hashlib
import random

import numpy as np
import pytest

from stayscope.llm import repeats
from stayscope.llm.repeats import without_repeats


def brute(docs):
    """By (key, text): length, removed bytes, runs and what is left, of documents in order."""
    first, out = set(), {}
    for key, text in sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            window = data[s:s + 100]
            if window in first:
                gone[s:s + 100] = b"\1" * 100
            first.add(window)
        left = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[key, text or ""] = (len(data), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return out


def check(spark, docs, partitions=3):
    frame = spark.createDataFrame([(*d, 1, "mine") for d in docs], "doc_id long, text string, lo int, key string").repartition(partitions)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in without_repeats(frame).collect())
    wanted = brute(docs)
    assert got == sorted((d[0] or -1, *wanted[d[0], d[1] or ""]) for d in docs)
    return got


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 8))) for _ in range(n))


@pytest.fixture
def small(monkeypatch):
    for name, size in {"SHARD": 4, "MERGED": 20, "PIECE": 3_000}.items():
        monkeypatch.setattr(repeats, name, size)


def documents(rng, n=60):
    shared = [words(rng, 60) for _ in range(4)]
    docs = []
    for i in range(1, n + 1):
        parts = [words(rng, rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):
            passage = rng.choice(shared)
            at = rng.randrange(0, 60)
            parts += [passage[at:at + rng.randrange(60, 300)], words(rng, rng.randrange(0, 10))]
        docs.append((i, rng.choice(["", " ", "\n"]).join(parts)))
    docs += [(n + 1 + k, docs[3 * k][1]) for k in range(5)]  # exact copies
    docs += [(n + 10 + k, docs[k][1].replace("a", "b", 1)) for k in range(5)]  # near copies
    return docs


@pytest.mark.parametrize("most", [2, 4_096])
def test_random_passages_in_small_shards(spark, small, monkeypatch, most):
    monkeypatch.setattr(repeats, "MOST", most)
    got = check(spark, documents(random.Random(most)))
    assert sum(r[2] for r in got) > 1_000


def test_small_arrow_batches_leave_all_anchors_to_the_borders(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        check(spark, documents(random.Random(5), 30))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_rows(spark):
    rng = random.Random(9)
    long, passage = words(rng, 40_000), words(rng, 40)
    docs = [
        (1, None), (2, ""), (3, "x" * 99), (4, "x" * 100), (5, "x" * 101), (6, "x" * 5_000), (7, "xy" * 60), (8, passage), (9, passage), (10, passage + passage),
        (11, "ü" * 200), (12, "é漢😀" * 40), (13, "é漢😀" * 40), (14, long), (15, long[:50_000] + "!" + long[50_000:]), (None, passage + " null key"), (16, passage), (16, passage),
        (17, "\n" * 300), (18, passage[:99]), (19, passage[1:]),
    ]
    check(spark, docs)


def test_one_row_on_a_third_of_the_table_and_one_passage_in_all_others(spark, small):
    rng = random.Random(2)
    passage, hot = words(rng, 50), words(rng, 50)
    docs = [(1, hot)] * 40 + [(i, words(rng, 8) + passage + words(rng, 8)) for i in range(2, 82)]
    check(spark, docs, 6)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert without_repeats(frame).collect() == []


def test_remaining_bytes_and_spans(spark):
    text = words(random.Random(4), 60)
    frame = spark.createDataFrame([(1, text), (2, "new " + text + " end")], "doc_id int, text string")
    rows = {r.doc_id: r for r in without_repeats(frame, kept=True).collect()}
    assert bytes(rows[2].kept) == b"new  end" and bytes(rows[1].kept) == text.encode()
    assert [tuple(s) for s in rows[2].spans] == [(4, 4 + len(text.encode()))]


def test_merge_orders_suffixes_and_measures_their_common_prefixes():
    rng = np.random.RandomState(0)
    aligned = rng.randint(97, 99, (50, 12)).astype(np.uint8)
    shards = [repeats.positional_bwt(aligned[at:at + 7]) for at in range(0, 50, 7)]
    for c, rows, common in repeats.merged_intervals(shards, range(0, 12)):
        suffixes = [aligned[r, c:].tobytes() for r in rows]
        assert suffixes == sorted(suffixes) and sorted(rows) == list(range(50))
        for i in range(1, 50):
            wanted = next((k for k in range(12 - c) if suffixes[i - 1][k] != suffixes[i][k]), 12 - c)
            assert common[i] == wanted
