"""Word shingles as hashed sets, for Arrow batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PART_BYTES = 1 << 21  # of text hashed at a time, or one text

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BYTE = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64)
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def parts(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of about ``PART_BYTES`` of text, or of one text."""
    sizes = np.cumsum(np.asarray(pc.binary_length(batch.column(column)).fill_null(0)))
    at = 0
    while at < len(sizes):
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + PART_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and the offsets of each."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and the offsets of each text's set.

    Words are runs of bytes other than white space, A-Z lowered. A text with fewer words than
    ``width`` has its whole sequence as one shingle, none if it has no word."""
    raw, offsets = text_bytes(texts)
    raw = _LOWER[raw]
    inside = ~_SPACES[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[offsets] = True
    open_ = inside.copy()
    open_[1:] &= ~inside[:-1] | first[1:-1]
    close = inside.copy()
    close[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(open_), np.flatnonzero(close) + 1
    power = np.full(len(raw) + 1, _R, np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * power[:-1], out=total[1:])
    back = np.full(len(raw) + 1, _R_INVERSE, np.uint64)
    back[0] = 1
    np.cumprod(back, out=back)
    word = mix((total[ends] - total[starts]) * back[starts])
    edges = np.searchsorted(starts, offsets)  # words before each text
    count = np.diff(edges)

    def folded(at: np.ndarray, n: int) -> np.ndarray:
        h = np.full(len(at), np.uint64(n), np.uint64)
        for j in range(n):
            h = mix(h * _R + word[at + j])
        return h

    full = np.maximum(count - (width - 1), 0)
    short = (count > 0) & (count < width)
    sizes = full + short
    out = np.zeros(int(sizes.sum()), np.uint64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    has = full > 0
    at = np.repeat(edges[:-1][has] - bounds[:-1][has], full[has]) + np.flatnonzero(
        np.repeat(has, sizes)
    )
    out[np.repeat(has, sizes)] = folded(at, width)
    for n in range(1, width):
        rows = np.flatnonzero(short & (count == n))
        out[bounds[rows]] = folded(edges[rows], n)
    sets, kept = [], np.zeros(len(sizes) + 1, np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        s = np.sort(out[a:b])
        if len(s) > 1:
            s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        sets.append(s)
        kept[i + 1] = len(s)
    flat = np.concatenate(sets) if sets else out
    return flat, np.cumsum(kept)
