"""Byte-level BPE of the tokenizers library over Arrow batches of texts."""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from stayscope.llm.wordwise import BLANK_RUN, WordMemory, count_texts, encode_texts

VOCABULARY = "byte_bpe_50k.json"

#: How this vocabulary writes a blank at the start of a token.
BLANK = "Ġ"

#: Characters given to the encoder at once.
JOINED_CHARS = 2_000

#: The same where words are counted only, and texts of that size given to it in one call.
COUNTED_CHARS, COUNTED_TEXTS = 500, 128

#: Letters up to U+024F and marks that a byte-level vocabulary keeps apart.
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ɏ", ".,;:!?)"

#: What is not cut further.
UNCUT = re.compile(f" ?[{LETTERS}]+|[{MARKS}]+|\n")

#: The character a byte-level vocabulary writes for each byte: itself if printable, else one from U+0100 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
BYTE_SIGNS = "".join(chr(_OTHERS.get(b, b)) for b in range(256))


def byte_signs(part: str) -> str:
    """The part as a byte-level vocabulary writes it."""
    if part[:1] == " " and part[1:].isalpha() and part.isascii():
        return BLANK + part[1:]
    return part.encode().decode("latin-1").translate(BYTE_SIGNS)



def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


#: Kind of a byte: a letter or the first byte of one (U+00C0 to U+023F), a mark, a line end, a blank, or another.
OTHER, LETTER, MARK, LINE_END, SPACE = range(5)
KINDS = np.full(256, OTHER, np.int8)
KINDS[[*range(65, 91), *range(97, 123), *range(0xC3, 0xC9)]] = LETTER
KINDS[list(MARKS.encode())], KINDS[10], KINDS[32] = MARK, LINE_END, SPACE


def word_parts(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words (large strings, a blank at most in front) cut where a byte-level vocabulary never joins
    characters, between letters, marks and one line end; and the number of parts of each.

    Words with anything else, or a line end not between these, stay whole.
    """
    _, borders, data = words.buffers()
    borders = np.frombuffer(borders, np.int64, len(words) + 1, 8 * words.offset) if len(words) else np.zeros(1, np.int64)
    data = pa.py_buffer(b"") if data is None else data
    low, lengths = borders[0], np.diff(borders)
    found = np.frombuffer(data, np.uint8)[low:borders[-1]]
    kinds = KINDS[found]
    behind = np.flatnonzero((found[1:] & 0xC0 == 0x80) & (kinds[:-1] == LETTER) & (found[:-1] > 127)) + 1
    kinds[behind] = LETTER
    signs = behind[(found[behind - 1] == 0xC3) & ((found[behind] == 0x97) | (found[behind] == 0xB7))]
    kinds[signs] = OTHER
    inside = np.ones(len(found) + 1, bool)  # a byte before it is of the same word
    inside[borders - low] = False
    framed = np.concatenate((KINDS[:1], kinds, KINDS[:1]))
    before, after = framed[:-2] * inside[:-1], framed[2:] * inside[1:]  # OTHER is 0
    bad = kinds == OTHER
    ends = np.flatnonzero(kinds == LINE_END)
    bad[ends] = ~(np.isin(before[ends], (LETTER, MARK)) & np.isin(after[ends], (LETTER, MARK)))
    bad = np.concatenate(([0], np.cumsum(bad)))
    whole = bad[borders[1:] - low] > bad[borders[:-1] - low]
    cuts = inside[:-1] & (kinds != before) & (before != SPACE) & ~np.repeat(whole, lengths)
    upto = np.concatenate(([0], np.cumsum(cuts)))
    starts = np.sort(np.concatenate((borders[:-1], low + np.flatnonzero(cuts))))
    parts = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(np.append(starts, borders[-1])), data])
    return parts, 1 + upto[borders[1:] - low] - upto[borders[:-1] - low]


class ByteEncoder:
    """One per Python worker and vocabulary file; keeps the words met so far."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; threads hold memory
        self.tokenizer = Tokenizer.from_file(path)
        cut, added = self.tokenizer.pre_tokenizer, self.tokenizer.get_added_tokens_decoder().values()
        #: The model alone, if it gives a part that is not cut further the ids that the whole encoder gives it.
        self.model = self.tokenizer.model if (
            isinstance(cut, ByteLevel) and cut.use_regex and not cut.add_prefix_space and self.tokenizer.normalizer is None
            and self.tokenizer.truncation is None and self.tokenizer.padding is None
            and all(re.search(f"[^ \n{LETTERS}{MARKS}]", t.content) for t in added)
        ) else None
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.starts_blank = np.zeros(self.size, bool)
        for token, i in vocabulary.items():
            self.starts_blank[i] = token.startswith(BLANK)
        self.memory = WordMemory(self._encode_words)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _encode_words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words led by a blank are joined into long texts; their tokens are told
        apart again by the blank that only the first token of a word has."""
        lengths = np.zeros(len(words), np.int64)
        got: list[tuple[np.ndarray, np.ndarray]] = []
        joined = [i for i, w in enumerate(words) if len(w) > 1 and w[0] == " " and not w[1].isspace()]
        at = 0
        while at < len(joined):
            end, chars = at, 0
            while end < len(joined) and chars < JOINED_CHARS:
                chars += len(words[joined[end]])
                end += 1
            some = np.asarray(joined[at:end])
            ids = np.asarray(self.whole("".join(words[i] for i in joined[at:end])), np.int32)
            first = np.flatnonzero(self.starts_blank[ids])
            if len(first) != len(some):
                raise RuntimeError("a token of this vocabulary spans two words")
            lengths[some] = np.diff(np.append(first, len(ids)))
            got.append((some, ids))
            at = end
        alone = sorted(set(range(len(words))).difference(joined))
        if alone:
            encoded = [self.whole(words[i]) for i in alone]
            lengths[alone] = [len(e) for e in encoded]
            got.append((np.asarray(alone), np.asarray([t for e in encoded for t in e], np.int32)))
        out = np.empty(int(lengths.sum()), np.int32)
        starts = np.cumsum(lengths) - lengths
        for some, ids in got:
            from_, n = starts[some], lengths[some]
            ends = np.cumsum(n)
            out[np.repeat(from_ - (ends - n), n) + np.arange(len(ids))] = ids
        return out, lengths

    def count_words(self, words: Sequence[str]) -> np.ndarray:
        """Number of ids of each word; no offsets are made.

        Letters or marks alone go to the model as they are, others through the whole encoder.
        """
        if self.model is None:
            return self._count_joined(words)
        tokenize, uncut = self.model.tokenize, UNCUT.fullmatch
        lengths = np.fromiter((len(tokenize(byte_signs(w))) if uncut(w) else -1 for w in words), np.int64, len(words))
        others = np.flatnonzero(lengths < 0)
        lengths[others] = self._count_joined([words[i] for i in others.tolist()])
        return lengths

    def _count_joined(self, words: Sequence[str]) -> np.ndarray:
        lengths = np.zeros(len(words), np.int64)
        joined = np.asarray([i for i, w in enumerate(words) if len(w) > 1 and w[0] == " " and not w[1].isspace()], np.int64)
        chars = np.cumsum([len(words[i]) for i in joined.tolist()], dtype=np.int64)
        ends = np.flatnonzero(np.diff(chars // COUNTED_CHARS, append=-1)) + 1
        for at in range(0, len(ends), COUNTED_TEXTS):
            some = ends[at:at + COUNTED_TEXTS]
            starts = np.concatenate(([ends[at - 1] if at else 0], some[:-1]))
            texts = ["".join(words[i] for i in joined[a:b].tolist()) for a, b in zip(starts.tolist(), some.tolist(), strict=True)]
            got = [np.asarray(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            first = np.flatnonzero(self.starts_blank[ids := np.concatenate(got)])
            own = joined[starts[0]:some[-1]]
            if len(first) != len(own):
                raise RuntimeError("a token of this vocabulary spans two words")
            lengths[own] = np.diff(np.append(first, len(ids)))
        for i in np.setdiff1d(np.arange(len(words)), joined).tolist():
            lengths[i] = len(self.whole(words[i]))
        return lengths

    def _unsafe(self, texts: pa.Array) -> np.ndarray:
        return pc.match_substring_regex(texts, BLANK_RUN).to_numpy(zero_copy_only=False)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each."""
        return encode_texts(texts, self.memory, self.whole, self._unsafe(texts))

    def count(self, texts: pa.Array) -> np.ndarray:
        return count_texts(texts, self.memory, self.whole, self._unsafe(texts))


@functools.cache
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)
