"""Vectorised text helpers that run inside Arrow batches of Spark tasks.

Texts stay in the UTF-8 buffer of the Arrow column; words, hashes and shingles are numpy arrays
over that buffer, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that separate words: space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n (kept per worker, grown by doubling)."""
    if len(_POWERS["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
            _POWERS[name] = p
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Texts:
    """Some whole texts: one byte buffer, ``offsets`` (n + 1), and the rows they came from."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first_row: int = 0):
        self.data, self.offsets, self.first_row = data, offsets, first_row

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)


def text_blocks(column: pa.Array, max_bytes: int = 1 << 20) -> Iterator[Texts]:
    """Blocks of consecutive texts of about ``max_bytes`` (a longer text is a block of its own); null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1 + column.offset)[column.offset:]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    sizes = np.diff(offsets)
    if column.null_count:
        sizes = np.where(np.asarray(column.is_null()), 0, sizes)
    at = 0
    while at < n:
        total = np.cumsum(sizes[at:at + 65536])
        k = max(1, int(np.searchsorted(total, max_bytes, "right")))
        yield Texts(data[offsets[at]:offsets[at + k]], offsets[at:at + k + 1] - offsets[at], at)
        at += k


def words(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every maximal run of non-space bytes."""
    n = len(t.data)
    if not n:
        e = np.zeros(0, np.int64)
        return e, e, e
    inside = ~SPACE[t.data]
    border = np.zeros(n + 1, bool)
    border[t.offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | border[:-1]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | border[1:])) + 1
    return starts, ends, np.searchsorted(t.offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end): equal spans, equal hashes wherever they stand."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    sums = total[1:]
    sums[:] = data
    sums += np.uint64(1)
    sums *= up[:len(data)]
    np.cumsum(sums, out=sums)
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(hashes: np.ndarray, doc: np.ndarray, n_docs: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word shingles (repeats kept, in text order) and the n_docs + 1 offsets of each
    text's own.  A text of fewer words has its whole sequence as one shingle; one without words has none."""
    count = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(count)])
    own = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    offsets = np.concatenate([[0], np.cumsum(own)])
    if not offsets[-1]:
        return np.zeros(0, np.uint64), offsets
    at = np.repeat(first[:-1] - offsets[:-1], own) + np.arange(offsets[-1])
    length = np.repeat(np.minimum(count, width), own)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    h = length.astype(np.uint64)
    for j in range(width):
        part = np.where(j < length, padded[at + j], np.uint64(0))
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + part)
    return h, offsets


def pack_strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())
