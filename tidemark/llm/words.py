"""Words, shingles and 64-bit hashes of whole batches of texts, computed with numpy on their UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (multiply and shift)."""
    x = np.asarray(x, dtype=np.uint64).copy()
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def constants(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit numbers that follow from ``seed``."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BASE = 0x2545F4914F6CDD1D | 1
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
_STEP = {"up": _BASE, "down": pow(_BASE, -1, 1 << 64)}
BLOCK = 1 << 20


def powers(kind: str, size: int) -> np.ndarray:
    """Powers of the base ("up") or of its inverse ("down") modulo 2^64."""
    known = _POWERS[kind]
    while len(known) < size:
        known = np.concatenate([known, known * np.uint64(pow(_STEP[kind], len(known), 1 << 64))])
    _POWERS[kind] = known
    return known[:size]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins (one more entry than texts); null is empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 1, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each span of bytes, in blocks so that memory follows the block; spans ascend and do not overlap."""
    table = constants(256, seed)
    if lower:
        table = table[_LOWER]
    out = np.zeros(len(begin), np.uint64)
    at = 0
    while at < len(begin):
        stop = max(at + 1, int(np.searchsorted(end, begin[at] + BLOCK, side="right")))
        base, top = int(begin[at]), int(end[stop - 1])
        sums = np.zeros(top - base + 1, np.uint64)
        np.cumsum(table[data[base:top]] * powers("up", top - base), out=sums[1:])
        first = begin[at:stop] - base
        out[at:stop] = (sums[end[at:stop] - base] - sums[first]) * powers("down", top - base + 1)[first]
        at = stop
    return mix(out + (end - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def word_spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end byte of every word (``breaks``: bytes that are in no word), and the index of the first word of each text (one more entry than texts)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~breaks[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[True], ~inside[:-1]]) | edge[:-1]
    after = np.concatenate([~inside[1:], [True]]) | edge[1:]
    begin = np.flatnonzero(inside & before)
    end = np.flatnonzero(inside & after) + 1
    return begin, end, np.searchsorted(begin, offsets)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z lower-cased), and the index of the first word of each text (one more entry than texts)."""
    data, offsets = buffers(column)
    begin, end, first = word_spans(data, offsets)
    return span_hashes(data, begin, end), first


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct ``width``-word shingle hashes of each text.

    A text with fewer words has its whole sequence as one shingle; a null, empty or
    blank text has none.
    """
    hashes, first = word_hashes(column)
    factors = constants(width + 1, 77)
    rolled = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for j in range(width):
        if len(rolled):
            rolled += hashes[j : j + len(rolled)] * factors[j]
    rolled = mix(rolled)
    sets = []
    for begin, end in zip(first[:-1], first[1:]):
        if end - begin >= width:
            sets.append(np.unique(rolled[begin : end - width + 1]))
        elif end > begin:
            own = hashes[begin:end]
            sets.append(mix((own * factors[: len(own)]).sum(dtype=np.uint64, keepdims=True) + len(own) * factors[width:]))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
