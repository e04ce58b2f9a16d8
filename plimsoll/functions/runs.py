"""Runs of consecutive words found by rolling hashes, so that only runs worth comparing become rows.

Texts come as words joined by single spaces (:func:`joined`), so a run of words is a span of bytes.
The hash of a span is read off prefix sums of a polynomial in the bytes, which costs the same for any
length. Spans that a fixed-size map of hashes doesn't know are dropped in the scan; what is left is
compared as text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import NOT_WORD, bare

#: log2 of the bits of the map of known runs; 8 MB, whatever the number of runs.
MAP_BITS = 26
#: Bytes of text that are counted together; a quarter of it is hashed together, as a byte takes some 80 bytes of hashes.
TOGETHER = 1 << 22
_BUCKET = 1 << 15
_WRAP = 1 << 64
_BASE = 0xD6E8FEB86659FD93
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def joined(lowered: Column) -> Column:
    """The words of a lower-cased text with single spaces between them."""
    return F.trim(F.regexp_replace(lowered, NOT_WORD + "+", " "))


class _Hashed:
    """The words of a batch of joined texts, and the hash of any span of them."""

    def __init__(self, texts: pa.Array):
        self.data, offsets = text_bytes(texts)
        self.starts, self.ends, self.text = word_spans(self.data, offsets)
        powers = np.full((2, len(self.data) + 1), [[_BASE], [pow(_BASE, -1, _WRAP)]], np.uint64)
        powers[:, 0] = 1
        up, self.down = np.multiply.accumulate(powers, axis=1)
        self.sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTES[self.data] * up[:-1], out=self.sums[1:])

    def spans(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text number, first byte, end byte and hash of each run of `width` words."""
        last = max(len(self.starts) - width + 1, 0)
        first = np.nonzero(self.text[:last] == self.text[len(self.text) - last:])[0]
        begin, end = self.starts[first], self.ends[first + width - 1]
        return self.text[first], begin, end, self.hashes(begin, end)

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        hashed = (self.sums[end] - self.sums[begin]) * self.down[begin]
        hashed = (hashed ^ (hashed >> np.uint64(32))) * np.uint64(_BASE)
        return hashed ^ (hashed >> np.uint64(29))


def strings(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.StringArray:
    """The spans of the data as an array of strings."""
    offsets = np.zeros(len(begin) + 1, np.int32)
    np.cumsum(end - begin, out=offsets[1:])
    places = np.repeat(begin - offsets[:-1], end - begin) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(data[places]))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of strings, and where each text begins, with the end of the last."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text number of the words of texts that hold nothing but words and spaces."""
    inside, fresh = data != 0x20, np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    before, after = fresh[:-1].copy(), fresh[1:].copy()
    before[1:] |= ~inside[:-1]
    after[:-1] |= ~inside[1:]
    begin = np.nonzero(inside & before)[0]
    return begin, np.nonzero(inside & after)[0] + 1, np.searchsorted(offsets, begin, "right") - 1


_ASCII = np.array([c if chr(c).isalnum() or chr(c) == "_" else 0x20 for c in range(0x80)], np.uint8)


@lru_cache(maxsize=1 << 16)
def _spelled(code: int, fold: bool) -> str:
    """What a character stands for, folded or not; a space for each that belongs to no word."""
    meant = bare(chr(code)) if fold else chr(code)
    return "".join(c if c == "_" or unicodedata.category(c)[0] in "LN" else " " for c in meant)


def _slots(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each range in turn."""
    ends = np.cumsum(sizes)
    return np.repeat(begin - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def words_only(texts: pa.Array, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of lower-cased texts with spaces for all that belongs to no word, and where each text begins.

    With ``fold``, accents go first, as :func:`plimsoll.functions.text.fold_accents` drops them. Each kind of
    character is looked up once, however often it occurs.
    """
    data, offsets = text_bytes(texts)
    if not len(data) or data.max() < 0x80:
        return _ASCII[data], offsets
    place = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
    at = np.nonzero(codes >= 0x80)[0]
    kinds, kind = np.unique(codes[at], return_inverse=True)
    spelled = [_spelled(int(c), fold) for c in kinds]
    sizes = np.array([len(x) for x in spelled])
    out = _ASCII[np.minimum(codes, 0x7F)].astype("<u4")
    out[at] = np.array([ord(x[0]) if x else 0x20 for x in spelled], "<u4")[kind]
    if (sizes != 1).any():
        times = np.ones(len(codes), np.int64)
        times[at] = sizes[kind]
        ends = np.cumsum(times)
        out, place = np.repeat(out, times), np.concatenate([[0], ends])[place]
        many = np.nonzero(sizes[kind] > 1)[0]
        size = sizes[kind[many]]
        flat = np.array([ord(c) for x in spelled for c in x], "<u4")
        out[_slots(ends[at[many]] - size, size)] = flat[_slots((np.cumsum(sizes) - sizes)[kind[many]], size)]
    if out.max(initial=0) < 0x80:
        return out.astype(np.uint8), place
    wide = np.cumsum(1 + (out >= 0x80) + (out >= 0x800) + (out >= 0x10000))
    written = np.frombuffer(out.tobytes().decode("utf-32-le").encode(), np.uint8)
    return written, np.concatenate([[0], wide])[place]


def pieces(batch: pa.RecordBatch, parts: int = 1) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about TOGETHER bytes, or that by ``parts``."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("words")), 0).to_numpy(zero_copy_only=False))
    row = 0
    while row < batch.num_rows:
        before = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, before + TOGETHER // parts, "right")))
        yield batch.slice(row, stop - row)
        row = stop


def runs(df: DataFrame, key: str, widths: Sequence[int], known: np.ndarray | None = None) -> DataFrame:
    """(key, run): runs of any of ``widths`` words of the column ``words``; only those that the map ``known`` may hold.

    One pass for all widths. Rows with fewer words, or null, give none. A run that a text repeats is
    mostly given once.
    """
    kind = dict(df.dtypes)[key]
    shared = df.sparkSession.sparkContext.broadcast(known) if known is not None else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = shared.value if shared is not None else None
        for batch in batches:
            for some in pieces(batch, 4):
                hashed = _Hashed(pc.fill_null(some.column("words"), ""))
                for width in widths:
                    text, begin, end, hashes = hashed.spans(width)
                    if seen is not None:
                        place = (hashes >> np.uint64(64 - MAP_BITS)).astype(np.int64)
                        kept = (seen[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                        text, begin, end = text[kept], begin[kept], end[kept]
                    stops = np.searchsorted(np.cumsum(end - begin), np.arange(TOGETHER // 4, (end - begin).sum() + TOGETHER // 4, TOGETHER // 4))
                    for low, high in zip([0, *stops[:-1] + 1], stops + 1):
                        listed = strings(hashed.data, begin[low:high], end[low:high]).dictionary_encode()
                        pairs = np.unique(text[low:high] * (len(listed.dictionary) + 1) + np.asarray(listed.indices))
                        owner, run = np.divmod(pairs, len(listed.dictionary) + 1)
                        yield pa.record_batch([some.column(key).take(pa.array(owner)), listed.dictionary.take(pa.array(run))],
                                              names=[key, "run"])

    return df.select(key, "words").mapInArrow(work, f"`{key}` {kind}, run string")


def run_map(known: DataFrame) -> np.ndarray:
    """The map of the hashes of the column ``run``, of any widths; it reaches the driver as at most 2^11 rows of 4 KB."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column("run")).to_numpy(zero_copy_only=False))
            hashed = _Hashed(batch.column("run")).hashes(ends - np.diff(ends, prepend=0), ends)
            yield pa.record_batch([pa.array((hashed >> np.uint64(64 - MAP_BITS)).astype(np.int64))], names=["place"])

    place = F.col("place")
    found = known.select("run").mapInArrow(work, "place long").groupBy(F.floor(place / _BUCKET).alias("bucket")).agg(
        F.bitmap_construct_agg(place % _BUCKET).alias("bits"))
    seen = np.zeros((1 << MAP_BITS) // 8, np.uint8)
    for row in found.toLocalIterator():
        at = row["bucket"] * _BUCKET // 8
        seen[at:at + _BUCKET // 8] = np.frombuffer(row["bits"], np.uint8)
    return seen
