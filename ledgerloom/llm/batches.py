"""Words of Arrow text columns, found for a whole batch at once with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Bytes of text that are looked at together; a longer text is looked at by itself, whole
SLICE_BYTES = 8 << 20
SEED = 42
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def text_column(column: pa.Array) -> pa.Array:
    """A column as text without nulls."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def sliced(frames: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text each, so memory does not follow the batches' sizes."""
    for frame in frames:
        ends = np.cumsum(pc.fill_null(pc.binary_length(frame[column]), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(ends):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield frame.slice(at, to - at)
            at = to


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large_string column without nulls one after the other, and where each text begins and ends."""
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.empty(0, np.uint8)
    return whole, bounds - bounds[0]


def word_spans(is_word: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal runs of word bytes, none of which reaches over a text's bounds."""
    if not len(is_word):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = np.zeros(len(is_word) + 1, bool)
    cut[bounds] = True
    first, last = is_word.copy(), is_word.copy()
    first[1:] &= ~is_word[:-1] | cut[1:-1]
    last[:-1] &= ~is_word[1:] | cut[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def encoded(data: np.ndarray, is_word: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """For every word its number among the different words, and these as a binary column."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[is_word]))]
    column = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    return column.indices.to_numpy(), column.dictionary


def word_hashes(words: pa.Array) -> np.ndarray:
    """XXH64 of every word, as Spark's ``xxhash64`` gives it."""
    return np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words.to_pylist()), np.uint64, len(words))


def chained(before: np.ndarray, more: np.ndarray) -> np.ndarray:
    """A 64-bit hash of a sequence from the hash of all but its last element and the hash of that one."""
    mixed = (before ^ (before >> np.uint64(29))) * _MIX
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _ODD
    return mixed + more
