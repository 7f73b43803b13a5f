"""Arrays of whole blocks of documents as compact binary values, and running documents through blocks."""

from __future__ import annotations

import numpy as np

#: Characters of text after which a block of documents ends.
CHARS = 32_000_000


def packed(values: np.ndarray) -> bytes:
    """The array, its bytes sorted by place and compressed: small numbers in wide integers cost what they need."""
    import zstandard

    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, dtype) -> np.ndarray:
    import zstandard

    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def ends_to_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sum of each run of ``values``; runs follow each other and may be empty."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes start, start + 1, ... of every run, one run after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
