"""Texts as numpy arrays inside tasks: bytes, words and hashes of words and of word windows.

A word's hash is a polynomial in random values of its bytes, taken from prefix sums, so a batch of
texts is hashed by a few array operations. Texts are worked off in groups of about GROUP_BYTES and
bytes in pieces of about PIECE, whatever the batch or a text is long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GROUP_BYTES = 1 << 21
PIECE = 1 << 19
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_UNBASE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = 0xD1342543DE82EF95
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def groups(batch: pa.RecordBatch, text: str = "text", most: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about so many bytes of text; null texts become empty."""
    at = batch.schema.get_field_index(text)
    batch = batch.set_column(at, text, pc.fill_null(batch.column(at), ""))
    ends = np.cumsum(pc.binary_length(batch.column(at)).to_numpy(zero_copy_only=False))
    row = 0
    while row < batch.num_rows:
        done = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(row, stop - row)
        row = stop


def tidied(work: Callable) -> Callable:
    """`work` on Arrow batches, giving back what Arrow keeps unused: workers live on, beside stages without Python too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in work(batches):
            yield batch
            del batch
            pa.default_memory_pool().release_unused()
        pa.default_memory_pool().release_unused()

    return run


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, and the places where the texts begin, with the end of the last."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the words (runs of bytes that are not ASCII white space)."""
    inside = ~_SPACE[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = inside[edges]
    stops[edges[edges > 0] - 1] = inside[edges[edges > 0] - 1]
    starts, ends = np.nonzero(begins)[0], np.nonzero(stops)[0] + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _UNBASE)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _POWERS[k] = np.multiply.accumulate(x)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        low = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, low + PIECE, "right")))
        size = ends[stop - 1] - low
        up, down = _powers(size + 1)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_VALUES[data[low:low + size]] * up[:size], out=sums[1:])
        s, e = starts[at:stop] - low, ends[at:stop] - low
        out[at:stop] = (sums[e] - sums[s]) * down[s]
        at = stop
    return mixed(out)


def window_hashes(each: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive words, by doubling; windows across texts are the caller's to drop."""
    total = max(len(each) - n + 1, 0)
    if not total:
        return np.zeros(0, np.uint64)
    part, width, out, taken = each, 1, None, 0
    left = n
    while left:
        if left & 1:
            piece = part[taken:taken + total]
            out = piece.copy() if out is None else out * _U(pow(_STEP, width, 1 << 64)) + piece
            taken += width
        left >>= 1
        if left:
            part = part[:len(part) - width] * _U(pow(_STEP, width, 1 << 64)) + part[width:]
            width *= 2
    return mixed(out + _U(n))
