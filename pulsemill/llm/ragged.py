"""Ragged arrays over the text of an Arrow batch: words by offsets, and gathers by index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text bytes that are held at once in wider form.
SLICE_BYTES = 8 << 20


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive parts (first row, texts) of about `most` bytes, at least one row each; a null text
    is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(column):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield first, column.slice(first, last - first)
        first = last


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after another, and the offset of each text (one more)."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    if data is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return flat, offsets - offsets[0]


def from_bytes(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Strings that lie one after another in `flat`."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(flat))]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers)


def split_words(texts: pa.Array, blanks: tuple[int, ...] = (32, 10)) -> tuple[pa.Array, np.ndarray]:
    """Words between the ASCII blanks, without empty ones, and each text's offset into them."""
    flat, offsets = as_bytes(texts)
    blank = np.isin(flat, np.array(blanks, np.uint8))
    at = np.flatnonzero(blank)
    starts = np.sort(np.concatenate([offsets[:-1], at + 1]), kind="stable")
    ends = np.sort(np.concatenate([at, offsets[1:]]), kind="stable")
    before = np.concatenate([[0], np.cumsum(blank)])
    per_text = before[offsets[1:]] - before[offsets[:-1]] + 1
    lengths = ends - starts
    full = lengths > 0
    word_offsets = np.concatenate([[0], np.cumsum(lengths[full])])
    counted = np.concatenate([[0], np.cumsum(full)])
    text_offsets = counted[np.concatenate([[0], np.cumsum(per_text)])]
    return from_bytes(flat[~blank], word_offsets), text_offsets


def distinct(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(index into the distinct words for each word, the distinct words)."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def gather(values: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups `index` of a ragged array, one after another, with their offsets."""
    lengths = (offsets[1:] - offsets[:-1])[index]
    out = np.concatenate([[0], np.cumsum(lengths)])
    source = np.repeat(offsets[:-1][index] - out[:-1], lengths) + np.arange(out[-1])
    return values[source], out
