"""Scans of the bytes of Arrow text columns with NumPy: byte classes, prefix sums by text, and word bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Classes a byte can be in; a byte's classes are bits of ``CLASSES[byte]``.
SPACE, CAPITAL, SYMBOL, CONTINUED = 1, 2, 4, 8


def _table() -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[[0x20, *range(0x09, 0x0E)]] |= SPACE
    out[ord("A") : ord("Z") + 1] |= CAPITAL
    out[np.frombuffer(b"#$%&*|", np.uint8)] |= SYMBOL
    out[0x80:0xC0] |= CONTINUED  # bytes inside a UTF-8 character
    return out


CLASSES = _table()


def text_bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, where each text starts, with the end). ``texts`` has no nulls."""
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    starts = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def per_text(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many of the flags are set in each text."""
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[starts])


def word_bounds(space: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, byte after the last) of each word in order: runs of bytes other than white space inside one text."""
    if not len(space):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.concatenate([[True], space[:-1]])
    after = np.concatenate([space[1:], [True]])
    inner = starts[(starts > 0) & (starts < len(space))]
    before[inner] = True
    after[inner - 1] = True
    return np.flatnonzero(before & ~space), np.flatnonzero(after & ~space) + 1


def word_counts(texts: pa.StringArray) -> np.ndarray:
    """Words of each text: maximal runs of characters other than ASCII white space."""
    data, starts = text_bytes(texts)
    first, _ = word_bounds((CLASSES[data] & SPACE) > 0, starts)
    return np.diff(np.searchsorted(first, starts))
