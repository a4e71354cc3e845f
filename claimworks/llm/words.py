"""Words of whole Arrow batches as numpy arrays: places, hashes, shingles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

LONG_WORD = 24  # bytes; longer words are hashed one by one
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX1
        x = (x ^ (x >> np.uint64(27))) * MIX2
        return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column end to end, and offsets; a null is empty."""
    if column.null_count:
        column = pa.compute.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    step = np.int64 if wide else np.int32
    offsets = np.frombuffer(offsets, step, len(column) + 1 + column.offset)[column.offset:].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_places(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Start and end of every run of word bytes, cut at document edges, and its document."""
    inside = is_word[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, doc


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    sizes = ends - starts
    out = sizes.astype(np.uint64) * STEP
    short = np.flatnonzero(sizes <= LONG_WORD)
    short = short[np.argsort(-sizes[short], kind="stable")]  # longest first: live words are a prefix
    acc = out[short]
    live_at = np.searchsorted(-sizes[short], -np.arange(1, LONG_WORD + 1), "right")
    begin = starts[short]
    with np.errstate(over="ignore"):
        for j, live in enumerate(live_at.tolist()):
            if not live:
                break
            acc[:live] = (acc[:live] ^ data[begin[:live] + j]) * np.uint64(0x100000001B3) + STEP
            if j % 6 == 5:
                acc[:live] = mix(acc[:live])
    out[short] = mix(acc)
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes())
    return out


def slab_ranges(offsets: np.ndarray, limit: int):
    """Row ranges holding about ``limit`` bytes; one row at least."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        yield start, stop
        start = stop


def ragged(parts_start: np.ndarray, parts_len: np.ndarray) -> np.ndarray:
    """Indices start..start+len of every part, end to end."""
    total = int(parts_len.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(parts_start - (np.cumsum(parts_len) - parts_len), parts_len)
    return shift + np.arange(total)
