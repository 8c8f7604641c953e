"""Sentence pieces by the best-scoring path: Aho-Corasick matches drive one Viterbi pass.

The automaton holds all normal pieces of a vocabulary file. Its walk over a
text yields, at every position, all pieces that end there (its state's own and
those of the output links), which relax the best score of the position. A
character that is no piece costs ``UNKNOWN`` below the worst piece and becomes
its UTF-8 bytes. Scores are summed in double precision; of equal paths, the one
with the longer last piece stays. Text is normalised as the vocabulary asks: a
blank is put in front of a text that is not empty and blanks are written as
``▁``. Only runs of ``▁`` have it after their start, so words are encoded once
per batch (see ``wordwise``).
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterable, Iterator, Sequence

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from stayscope.llm.wordwise import WordMemory, as_texts, encode_texts, slices

VOCABULARY = "piece_bpe_32k.model"
BLANK = "▁"

#: Ids of words that a Python worker keeps, and bytes of text that are encoded at once.
KEPT_IDS, SLICE_BYTES = 2_000_000, 2_000_000

#: What an unknown character costs beyond the worst piece.
UNKNOWN = 10.0

#: Texts that are not cut into words: two blanks together, a blank at the start, or a written blank sign.
WHOLE = r"  |^ |▁"


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


class PieceEncoder:
    """One per Python worker and vocabulary file."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        control = [model.is_control(i) or model.is_unknown(i) for i in range(n)]
        self.byte_id = [0] * 256
        self.bytes_of: list[bytes] = [b""] * n
        self.automaton = ahocorasick.Automaton()
        worst = 0.0
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not control[i]:
                if BLANK in piece[1:] and piece.strip(BLANK):
                    raise ValueError(f"piece {piece!r} has a blank inside")
                score = model.get_score(i)
                worst = min(worst, score)
                self.automaton.add_word(piece, (len(piece), score, i))
                self.bytes_of[i] = piece.replace(BLANK, " ").encode()
        self.automaton.make_automaton()
        self.unknown = worst - UNKNOWN
        self.memory = WordMemory(self._encode_words, KEPT_IDS)

    def best_path(self, text: str) -> list[int]:
        """Ids of the best path over a normalised text."""
        n = len(text)
        score, back, piece = [0.0] * (n + 1), list(range(-1, n)), [-1] * (n + 1)
        at = 0
        lowest = float("-inf")
        best, single = lowest, False
        end = -1
        for end, (size, value, i) in self.automaton.iter(text):
            while at < end:
                if not single and score[at] + self.unknown > best:
                    best, back[at + 1], piece[at + 1] = score[at] + self.unknown, at, -1
                score[at + 1] = best
                best, single = lowest, False
                at += 1
            if size == 1:
                single = True
            reached = score[end + 1 - size] + value
            if reached > best:
                best, back[end + 1], piece[end + 1] = reached, end + 1 - size, i
        while at < n:
            if not single and score[at] + self.unknown > best:
                best, back[at + 1], piece[at + 1] = score[at] + self.unknown, at, -1
            score[at + 1] = best
            best, single = lowest, False
            at += 1
        out: list[int] = []
        at = n
        while at:
            if piece[at] >= 0:
                out.append(piece[at])
            else:
                out += [self.byte_id[b] for b in reversed(text[back[at]:at].encode())]
            at = back[at]
        return out[::-1]

    def whole(self, text: str) -> list[int]:
        return self.best_path((BLANK + text).replace(" ", BLANK)) if text else []

    def _encode_words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Every word but an empty text's has the blank in front, that of the text's start too."""
        ids = [self.best_path(BLANK + w[1:] if w[:1] == " " else BLANK + w) if w else [] for w in words]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for own in ids for i in own), np.int32, int(lengths.sum())), lengths

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each."""
        unsafe = pc.match_substring_regex(texts, WHOLE).to_numpy(zero_copy_only=False)
        return encode_texts(texts, self.memory, self.whole, unsafe)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of the ids; the blank put in front is taken off."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


@functools.cache
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def encode_pieces(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text, decode it again, and compare.

    Per row: ``doc_id``, ``ids`` (array of int), ``n_ids``, ``n_byte_ids`` (bytes of
    unknown characters), ``ids_crc32`` (unsigned, over little-endian uint32) and
    ``same_text`` (decoding gives the text). Null texts are empty and have no ids.
    A text that holds ``▁`` itself decodes to a blank there. Repeated rows stay;
    other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(vocabulary)
        is_byte = np.zeros(len(encoder.pieces), np.int64)
        is_byte[encoder.byte_id] = 1
        for batch in (part for whole in batches for part in slices(whole, 1, SLICE_BYTES)):
            texts = as_texts(batch.column(1))
            ids, counts = encoder.encode(texts)
            ends = np.cumsum(counts)
            starts = ends - counts
            spans = list(zip(starts.tolist(), ends.tolist(), strict=True))
            bytes_before = np.concatenate(([0], np.cumsum(is_byte[ids])))
            offsets = np.append(0, ends).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
                    pa.array(counts),
                    pa.array(bytes_before[ends] - bytes_before[starts]),
                    pa.array([zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in spans], pa.int64()),
                    pa.array([
                        encoder.decode(ids[a:b].tolist()) == t
                        for (a, b), t in zip(spans, texts.to_pylist(), strict=True)
                    ], pa.bool_()),
                ],
                names=[doc_id, "ids", "n_ids", "n_byte_ids", "ids_crc32", "same_text"],
            )

    return docs.select(doc_id, text).mapInArrow(
        encode, f"`{doc_id}` {kind}, ids array<int>, n_ids long, n_byte_ids long, ids_crc32 long, same_text boolean",
    )
