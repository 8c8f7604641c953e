"""Encoders against their libraries and against plain dynamic programming."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from stayscope.llm import bytebpe, pieces
from stayscope.llm.edits import (
    apply_edits,
    attach_edits,
    build_trees,
    cleaned_counts,
    cleaning_edits,
    edited_text,
    tree_of,
    usable_edits,
    with_cleaning_edits,
)
from stayscope.llm.idfiles import id_file_round, pack, segment_bytes, read_segment, unpack
from stayscope.llm.pieces import encode_pieces

BPE = bytebpe.vocabulary_path()
PIECES = pieces.vocabulary_path()

TEXTS = [
    "", " ", "plain words here", "a  b", "a \n b", " lead", "trail ", "x\n\n y", "don't we'll  go",
    "a<|endoftext|> b <|endoftext|>", "é ü 12 3456 !?\t", "nbsp  here", "line one\nline two\nline one",
    "mail me: some.one@example.org now", 'key = "0123456789abcdef0123"', "漢字 と 😀 x", "▁ written", "plain words here",
]


def documents(spark, texts=TEXTS):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, None, None, None), (3, "twice", "x", 1), (3, "twice", "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, start int")


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")


def test_words_give_the_ids_of_whole_texts(corpus):
    encoder = bytebpe.byte_encoder(BPE)
    texts = TEXTS + [r.text for r in corpus.collect()] + ["word " * 60_000]
    ids, counts = encoder.encode(pa.array(texts, pa.large_string()))
    plain = [encoder.whole(t) for t in texts]
    assert counts.tolist() == [len(p) for p in plain]
    assert ids.tolist() == [i for p in plain for i in p]
    assert encoder.count(pa.array(texts, pa.large_string())).tolist() == counts.tolist()
    assert encoder.encode(pa.array([], pa.large_string()))[0].tolist() == []


def test_word_memory_is_thinned_without_changing_ids(monkeypatch):
    monkeypatch.setattr("stayscope.llm.wordwise.KEPT_IDS", 30)
    encoder = bytebpe.ByteEncoder(BPE)
    for k in range(6):
        texts = [f"same words and number{k} {k * 7} again", "same words"]
        ids, counts = encoder.encode(pa.array(texts, pa.large_string()))
        assert ids.tolist() == [i for t in texts for i in encoder.whole(t)]


def test_pieces_keep_few_words_and_small_slices(spark, monkeypatch):
    """The ids of a worker's words have a bound of their own, and texts are encoded in small runs; nothing is cut."""
    monkeypatch.setattr(pieces, "KEPT_IDS", 30)
    encoder, plain = pieces.PieceEncoder(PIECES), pieces.piece_encoder(PIECES)
    for k in range(6):
        texts = [f"same words and number{k} {k * 7} again", "same words"]
        ids, _ = encoder.encode(pa.array(texts, pa.large_string()))
        assert ids.tolist() == [i for t in texts for i in plain.whole(t)]
        assert len(encoder.memory.ids) < 60
    docs = documents(spark)
    whole = sorted(map(str, encode_pieces(docs, PIECES).collect()))
    monkeypatch.setattr(pieces, "SLICE_BYTES", 10)
    assert sorted(map(str, encode_pieces(docs, PIECES).collect())) == whole


def test_packed_ranks_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = rng.integers(0, 2 ** rng.integers(1, 33, n), n).astype(np.uint32)
        control, data = pack(ranks)
        assert len(control) == -(-n // 4)
        assert unpack(control, data, n).tolist() == ranks.tolist()


def test_segment_ranks_by_frequency():
    ids = np.array([9, 9, 4, 9, 4, 70000], np.int32)
    raw = segment_bytes([None, 5], np.array([2, 4]), ids)
    keys, lengths, got = read_segment(raw)
    assert (keys, lengths.tolist(), got.tolist()) == ([None, 5], [2, 4], ids.tolist())
    with pytest.raises(ValueError):
        read_segment(b"x" * len(raw))


@pytest.mark.parametrize("segment", [1, 50, 4_000_000])
def test_id_files_hold_all_documents_in_order(spark, monkeypatch, segment):
    docs = documents(spark)
    got = sorted(id_file_round(docs, BPE).collect(), key=lambda r: r.start)
    encoder = bytebpe.byte_encoder(BPE)
    start = 0
    assert [r.doc_id for r in got] == sorted([r.doc_id for r in docs.collect()], key=lambda k: (k is not None, k))
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(zlib.crc32(np.array([*encoder.whole(r.text or ""), 0], "<u4").tobytes()))
    for r in got:
        assert r.start == start
        start += r.n_tokens
        texts[r.doc_id].remove(r.ids_crc32)
    assert id_file_round(docs.limit(0), BPE).count() == 0


def test_edits_match_encoding_the_edited_text(spark):
    rng, encoder = random.Random(3), bytebpe.byte_encoder(BPE)
    words = ["alpha", "be", " ", "\n", "  ", "gamma,", "don't", "12", "é"]
    rows = []
    for i in range(150):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 120)))
        edits = [
            (rng.randint(0, len(text) + 2), rng.choice([0, 0, 1, 3, 40]), rng.choice(["", " ", "x", " new words ", "\n", "'s"]))
            for _ in range(rng.randint(0, 5))
        ]
        rows.append((i, text, edits, 0))
    rows += [(None, None, None, 0), (7, "", [(0, 0, "put in")], 0), (8, "same", None, 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<begin:int,length:int,put:string>>, tree int")
    got = apply_edits(build_trees(table, BPE, leaf_chars=16), BPE).collect()
    assert len(got) == len(rows)
    by_key = {(r.doc_id, r.tokens_before): r for r in got}
    for key, text, edits, _ in rows:
        text = text or ""
        usable = usable_edits([dict(zip(("begin", "length", "put"), e, strict=True)) for e in edits or []], len(text))
        row = by_key[key, len(encoder.whole(text))]
        assert row.tokens_after == len(encoder.whole(edited_text(text, usable))), (text, usable)
        assert row.n_edits == len(usable) and row.tree[1] == row.tokens_after
        assert sum(row.leaf_chars) == len(edited_text(text, usable))
        assert row.tree == tree_of(row.tree[len(row.tree) // 2:])


def test_only_touched_leaves_are_encoded(spark):
    text = "some words in a row " * 2000
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    edits = spark.createDataFrame([(1, 20_000, 4, "few"), (None, 0, 1, "x"), (99, 0, 1, "x")], "doc_id long, begin int, length int, put string")
    row = apply_edits(build_trees(attach_edits(table, edits), BPE), BPE).first()
    assert row.n_edits == 1 and row.leaves_encoded <= 2 and row.chars_encoded < 2000 < row.n_leaves * 512


def test_cleaning_edits_of_the_corpus(spark, corpus):
    encoder = bytebpe.byte_encoder(BPE)
    made = with_cleaning_edits(documents(spark, TEXTS).select("doc_id", "text").union(corpus))
    got = {(r.doc_id, r.tokens_before, r.tokens_after, r.n_edits) for r in apply_edits(build_trees(made, BPE), BPE).collect()}
    for r in made.select("doc_id", "text").collect():
        usable = usable_edits([dict(zip(("begin", "length", "put"), e, strict=True)) for e in cleaning_edits(r.text or "")], len(r.text or ""))
        after = edited_text(r.text or "", usable)
        assert (r.doc_id, len(encoder.whole(r.text or "")), len(encoder.whole(after)), len(usable)) in got
    fused = {(r.doc_id, r.tokens_before, r.tokens_after, r.n_edits) for r in cleaned_counts(made, BPE).collect()}
    assert fused == got
    assert edited_text(TEXTS[12], usable_edits([dict(zip(("begin", "length", "put"), e, strict=True)) for e in cleaning_edits(TEXTS[12])], 99)) == "line one\nline two"
    assert apply_edits(build_trees(made.limit(0), BPE), BPE).count() == 0


def best_by_table(encoder, text):
    """Plain dynamic programming over all starts."""
    known = {p: (s, i) for p, (_, s, i) in encoder.automaton.items()}
    best = [(0.0, [])] + [None] * len(text)
    for start in range(len(text)):
        for end in range(start + 1, min(len(text), start + 20) + 1):
            part = text[start:end]
            if part in known:
                score, ids = known[part][0], [known[part][1]]
            elif end == start + 1:
                score, ids = encoder.unknown, [encoder.byte_id[b] for b in part.encode()]
            else:
                continue
            if best[end] is None or best[start][0] + score > best[end][0]:
                best[end] = (best[start][0] + score, best[start][1] + ids)
    return best[-1][1]


def unigram_library():
    """The library's own best-path encoder over the same pieces and scores: the
    vocabulary file with its kind set from merges to best path."""
    raw = bytearray(open(PIECES, "rb").read())
    from_, to = bytes([0x18, 2]), bytes([0x18, 1])
    at = raw.rindex(from_, 0, len(raw))
    for at in [i for i in range(len(raw) - 1, 0, -1) if raw[i - 1:i + 1] == from_]:
        changed = bytes(raw[:at - 1]) + to + bytes(raw[at + 1:])
        try:
            model = sentencepiece.SentencePieceProcessor(model_proto=changed)
        except Exception:
            continue
        if model.encode("the these") != sentencepiece.SentencePieceProcessor(model_file=PIECES).encode("the these"):
            return model
    return None


def test_pieces_are_the_best_path(corpus):
    encoder = pieces.piece_encoder(PIECES)
    texts = TEXTS + [r.text[:300] for r in corpus.collect()]
    ids, counts = encoder.encode(pa.array(texts, pa.large_string()))
    ends = np.cumsum(counts)
    for t, n, e in zip(texts, counts, ends, strict=True):
        normal = ("▁" + t).replace(" ", "▁") if t else ""
        assert ids[e - n:e].tolist() == best_by_table(encoder, normal), t


def test_pieces_match_the_library_path(corpus):
    model = unigram_library()
    if model is None:
        pytest.skip("the vocabulary file could not be read as best-path")
    encoder = pieces.piece_encoder(PIECES)
    same, known = 0, set(encoder.pieces)
    for r in corpus.limit(100).collect():
        words = [w for w in r.text.split() if known.issuperset(w)][:6]
        text = " ".join(words)
        own, theirs = encoder.whole(text), model.encode(text)
        assert sum(map(model.get_score, own)) >= sum(map(model.get_score, theirs))
        same += own == theirs
    assert same > 50


def test_piece_round_trip_and_odd_rows(spark):
    docs = documents(spark)
    got = encode_pieces(docs, PIECES).collect()
    assert len(got) == docs.count()
    assert sum(not r.same_text for r in got) == 1  # the one with a written blank sign
    assert {r.n_ids for r in got if r.doc_id is None} == {0}
    assert any(r.n_byte_ids for r in got)
    encoder = pieces.piece_encoder(PIECES)
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.n_ids for r in got)
    assert encoder.decode(encoder.whole("b" * 50_000)) == "b" * 50_000
    assert encode_pieces(docs.filter(F.lit(False)), PIECES).count() == 0
