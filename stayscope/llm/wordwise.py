"""Encoding whole texts through their distinct words, one Arrow batch at a time.

A byte-pair or piece vocabulary never joins characters across a blank that is
followed by a visible character: every pre-token (or piece) holds a blank only
at its start. A text is therefore the concatenation of its words, each with
the blank before it, and may be encoded word by word. Words repeat, so a batch
is turned into word codes by Arrow, each distinct word is encoded once, and the
results are laid out by index arithmetic. Texts where a blank stands beside
other white space are encoded whole. The results equal those of the plain
encoder on whole texts.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A blank before other white space: such texts are not cut into words.
BLANK_RUN = r" [\s\x0b\x1c-\x1f\x{85}\pZ]"

#: Ids that a Python worker keeps. Beyond it, words that came once only are dropped;
#: if that is not enough, all are.
KEPT_IDS = 4_000_000

#: Bytes of text that are worked on at once within a batch; a longer text stands alone.
SLICE_BYTES = 6_000_000


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, … of every run, one run after the other."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - (ends - lengths), lengths)
    return shift + np.arange(ends[-1])


def run_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over consecutive runs, zero for empty ones."""
    total = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


class WordMemory:
    """Ids of the words met so far by this Python worker, in one flat array.

    ``encode_words`` takes a list of different words and returns their ids one
    after the other and the number of ids of each. ``kept`` takes the place of ``KEPT_IDS``.
    """

    def __init__(self, encode_words: Callable[[Sequence[str]], tuple[np.ndarray, np.ndarray]], kept: int | None = None):
        self.encode_words, self.kept = encode_words, kept
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.again = np.zeros(0, bool)

    def _thin(self) -> None:
        """Drop the words that came in one batch only."""
        kept = np.flatnonzero(self.again)
        if 2 * int(self.length[kept].sum()) > (self.kept or KEPT_IDS):
            self.forget()
            return
        words = list(self.slot)
        self.slot = {words[k]: i for i, k in enumerate(kept.tolist())}
        self.ids = self.ids[ragged(self.start[kept], self.length[kept])]
        self.length = self.length[kept]
        self.start = np.cumsum(self.length) - self.length
        self.again = np.zeros(len(kept), bool)

    def slots(self, words: Sequence[str]) -> np.ndarray:
        """Slot of each word; words not met before are encoded first.

        Slots are numbered in the order in which words were first met.
        """
        if len(self.ids) > (self.kept or KEPT_IDS):
            self._thin()
        known = self.slot
        found = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
        self.again[found[found >= 0]] = True
        new = np.flatnonzero(found < 0)
        if len(new):
            fresh = [words[i] for i in new.tolist()]
            ids, lengths = self.encode_words(fresh)
            first = len(self.length)
            known.update(zip(fresh, range(first, first + len(fresh)), strict=True))
            starts = len(self.ids) + np.cumsum(lengths) - lengths
            self.ids = np.concatenate((self.ids, ids.astype(np.int32)))
            self.start = np.concatenate((self.start, starts))
            self.length = np.concatenate((self.length, lengths))
            self.again = np.concatenate((self.again, np.zeros(len(fresh), bool)))
            found[new] = np.arange(first, first + len(fresh))
        return found


def as_texts(column) -> pa.Array:
    """One array of strings, nulls empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


@functools.cache
def _trim() -> Callable[[int], int] | None:
    """``malloc_trim`` of the C library, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return None


def give_back() -> None:
    """Return to the system what Arrow, numpy and Python have freed; a worker that waits for its next
    task holds no more than it needs."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``most`` bytes of text each, one row at least.

    After them, what has been freed goes back to the system.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(at, to - at)
        at = to
    give_back()


def word_codes(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the word code of every position, and the words of each text.

    Every word but the first of its text carries the blank before it.
    """
    parts = pc.split_pattern(texts, " ")
    per_text = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    plain = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    firsts = np.cumsum(per_text) - per_text
    leading, place = np.unique(codes[firsts], return_inverse=True)
    words = [" " + w for w in plain] + [plain[c] for c in leading.tolist()]
    codes[firsts] = len(plain) + place
    return words, codes, per_text


def blank_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """What ``word_codes`` gives, the distinct words in another order and as an array: cut before every blank, in place."""
    _, borders, data = texts.buffers()
    borders = np.frombuffer(borders, np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    data = pa.py_buffer(b"") if data is None else data
    blanks = borders[0] + np.flatnonzero(np.frombuffer(data, np.uint8)[borders[0]:borders[-1]] == 32)
    before = np.searchsorted(blanks, borders)
    starts = np.append(np.insert(blanks, before[:-1], borders[:-1]), borders[-1])
    words = pa.Array.from_buffers(pa.large_string(), len(starts) - 1, [None, pa.py_buffer(starts), data])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), np.diff(before) + 1


def encode_texts(
    texts: pa.Array,
    memory: WordMemory,
    encode_whole: Callable[[str], Iterable[int]],
    unsafe: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and the number of ids of each.

    ``unsafe`` marks the texts that ``encode_whole`` takes as they are.
    """
    n = len(texts)
    counts = np.zeros(n, np.int64)
    safe = np.flatnonzero(~unsafe)
    words, codes, per_text = word_codes(texts.take(pa.array(safe)))
    slots = memory.slots(words)[codes]
    lengths = memory.length[slots]
    counts[safe] = run_sums(lengths, per_text)
    ids = memory.ids[ragged(memory.start[slots], lengths)]
    if len(safe) == n:
        return ids, counts
    whole = {i: np.asarray(list(encode_whole(texts[i].as_py())), np.int32)
             for i in np.flatnonzero(unsafe).tolist()}
    for i, own in whole.items():
        counts[i] = len(own)
    out = np.empty(int(counts.sum()), np.int32)
    starts = np.cumsum(counts) - counts
    out[ragged(starts[safe], counts[safe])] = ids
    for i, own in whole.items():
        out[starts[i]:starts[i] + len(own)] = own
    return out, counts


def count_texts(
    texts: pa.Array,
    memory: WordMemory,
    encode_whole: Callable[[str], Iterable[int]],
    unsafe: np.ndarray,
) -> np.ndarray:
    """Number of ids of each text."""
    counts = np.zeros(len(texts), np.int64)
    safe = np.flatnonzero(~unsafe)
    words, codes, per_text = word_codes(texts.take(pa.array(safe)))
    slots = memory.slots(words)
    counts[safe] = run_sums(memory.length[slots][codes], per_text)
    for i in np.flatnonzero(unsafe).tolist():
        counts[i] = len(list(encode_whole(texts[i].as_py())))
    return counts
