"""Small text helpers that run inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACES = " \t\n\v\f\r"


def words(text: str, lower: bool = False) -> list[bytes]:
    """Runs of anything but space and the controls 0x09 to 0x0D, as UTF-8 (bytes.split knows just these); ``lower``
    turns A-Z into lower case."""
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def has_word(text: str) -> bool:
    return bool(text.strip(_SPACES))


def word_chars(text: str) -> int:
    """Code points outside those separators."""
    return len(text) - sum(map(text.count, _SPACES))


def texts(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """A text column as Python strings, NULL as empty."""
    return [t or "" for t in column.to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` neighbours; empty if there are fewer."""
    n = len(hashes) - width + 1
    if n <= 0:
        return hashes[:0]
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = mix64(out + hashes[i : i + n]) if i else hashes[:n].copy()
    return out


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that long texts do not pile up."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
