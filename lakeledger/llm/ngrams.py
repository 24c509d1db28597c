"""Hashed character n-grams of lower-cased texts, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from lakeledger.llm.common import byte_values, give_back, mix, powers, prefix_sums

#: Characters handled together; every one makes a few n-grams.
SLICE_CHARS = 1 << 18

#: Bytes that stay: ASCII letters and digits and all bytes of other characters; the rest is one blank.
_STAYS = np.zeros(256, bool)
_STAYS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def lowered(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row): the texts in lower case, each with a blank before and behind, runs
    of other characters as one blank."""
    parts = [b" " + (t or "").lower().encode() + b" " for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    data = np.where(_STAYS[data], data, np.uint8(0x20))
    blank = data == 0x20
    again = np.zeros(len(data), bool)
    again[1:] = blank[1:] & blank[:-1] & (row[1:] == row[:-1])
    return data[~again], row[~again]


def grams(data: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every n-gram that lies in one row."""
    if len(data) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    sums = prefix_sums(byte_values(data))
    h = mix((sums[n:] - sums[:-n]) * powers(len(data) - n + 1, inverse=True) + np.uint64(n))
    inside = row[:len(row) - n + 1] == row[n - 1:]
    return h[inside], row[:len(row) - n + 1][inside]


def slices(column: pa.Array) -> Iterator[tuple[int, list]]:
    """(first row, texts) in pieces of about SLICE_CHARS."""
    give_back()  # what an earlier task of this worker has left, as tables of another stage
    held, size, first = [], 0, 0
    for i, t in enumerate(column):
        text = t.as_py()
        held.append(text)
        size += len(text or "")
        if size >= SLICE_CHARS:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held
    give_back()
