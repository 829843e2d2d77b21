"""Words of whole texts as codes of a dictionary, without a Python object for each word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# The bytes that part words (space, tab to carriage return).
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


@dataclass
class Words:
    """``codes`` of all words in order; text i's are ``codes[starts[i]:starts[i + 1]]``; ``entries`` are the distinct words."""

    codes: np.ndarray
    starts: np.ndarray
    entries: pa.BinaryArray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts, and where each text starts among them (one more at the end); null is empty."""
    col = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    if not len(col) or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(col.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def dictionary(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, pa.BinaryArray]:
    """Codes and distinct entries of the pieces of ``data`` that begin at ``starts`` (with the end of the last)."""
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1,
                                              [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)])
    found = pc.dictionary_encode(pieces)
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary


def split_words(column: pa.Array, *, lower: bool) -> Words:
    """Runs of bytes other than white space; ``lower`` turns A-Z into a-z first."""
    data, offsets = text_bytes(column)
    gap = _SPACE[data]
    first = ~gap
    first[1:] &= gap[:-1]
    inner = offsets[:-1][np.diff(offsets) > 0]
    first[inner] = ~gap[inner]  # a text's first byte begins a word even if the last text ended in one
    begins = np.flatnonzero(first)
    kept = data[~gap]
    before = np.cumsum(~gap) - 1  # place of a byte among the kept ones
    starts = np.append(before[begins], len(kept))
    codes, entries = dictionary(_LOWER[kept] if lower else kept, starts)
    return Words(codes, np.searchsorted(begins, offsets), entries)


def word_hashes(entries: pa.BinaryArray) -> np.ndarray:
    """64-bit hash of every entry."""
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w) for w in entries.to_pylist()), np.uint64, len(entries))
