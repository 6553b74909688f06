"""Words and shingles of many texts at once, as NumPy arrays over an Arrow string column.

A word is a run of bytes other than space and 0x09-0x0D; A-Z are lower-cased. Words are known by
64-bit hashes that come from prefix sums over the byte buffer, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (wrapping arithmetic)."""
    x = np.asarray(x, np.uint64).copy()
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BYTE_LOWER = BYTE[LOWER]
BASE = 0xD6E8FEB86659FD93
BASE_INVERSE = pow(BASE, -1, 1 << 64)
STEP = mix(np.arange(101, 101 + 64, dtype=np.uint64)) | np.uint64(1)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept, and grown when a longer text comes."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        have[0] = 1
        _powers[base] = np.multiply.accumulate(have)
    return _powers[base]


def slices(batches, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of the batches whose ``text`` holds about ``limit`` bytes; a longer text is a part alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < len(sizes):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each begins (one more at the end); null is empty."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


class Words:
    """Words of a column of texts: ``start``, ``end`` (bytes), ``hash``, ``first`` (of each text, one more at the end)."""

    def __init__(self, texts: pa.Array, lower: bool = True, gaps: np.ndarray = SPACE):
        data, offsets = buffer(texts)
        n = len(data)
        gap = gaps[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.ones(n, bool)
        before[1:] = gap[:-1]
        after = np.ones(n, bool)
        after[:-1] = gap[1:]
        self.start = np.flatnonzero(~gap & (before | edge[:-1]))
        self.end = np.flatnonzero(~gap & (after | edge[1:])) + 1
        self.data, self.offsets = data, offsets
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((BYTE_LOWER if lower else BYTE)[data] * powers(BASE, n)[:n], out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * powers(BASE_INVERSE, n + 1)[self.start])
        self.first = np.searchsorted(self.start, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every k-word window and of every whole text of 1 to k-1 words; where each text's begin."""
        counts = self.counts
        n = len(self.hash)
        made = np.maximum(counts - k + 1, (counts > 0).astype(counts.dtype))
        begin = np.concatenate([[0], np.cumsum(made)])
        out = np.zeros(begin[-1], np.uint64)
        if not len(out):
            return out, begin
        full = np.zeros(max(0, n - k + 1), np.uint64)
        for j in range(k):
            if len(full):
                full += self.hash[j:n - k + 1 + j] * STEP[j]
        long = np.flatnonzero(counts >= k)
        if len(long):
            take = np.repeat(self.first[long] - begin[long], made[long]) + ranges(begin[long], made[long])
            out[ranges(begin[long], made[long])] = mix(full[take])
        for size in range(1, k):
            some = np.flatnonzero(counts == size)
            if len(some):
                value = np.full(len(some), size + 1, np.uint64) * STEP[k]
                for j in range(size):
                    value += self.hash[self.first[some] + j] * STEP[j]
                out[begin[some]] = mix(value)
        return out, begin


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start+1, .. for each start, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def blob(values: np.ndarray, kind=np.uint64) -> bytes:
    return np.ascontiguousarray(values, kind).tobytes()


def unblob(value: bytes | None, kind=np.uint64) -> np.ndarray:
    return np.frombuffer(value or b"", kind)
