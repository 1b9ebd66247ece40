"""Words of many texts at once, as arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text turned into arrays at once; a longer text stands alone.
CHUNK_BYTES = 1_000_000
# Bytes of text whose words a task holds at once.
SLICE_BYTES = 4_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_PLACES = 64
_MIX = np.random.default_rng(20).integers(1, 1 << 63, (_PLACES, 256), np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of a bounded number of bytes of text; a longer text stands alone."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
    first = 0
    while first < batch.num_rows:
        before = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, "right")))
        yield batch.slice(first, last - first)
        first = last


def chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and row offsets (from 0) of ranges of texts; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of bytes other than ASCII white space; runs end with their row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~_SPACE[data]
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = False, solid
    inner = offsets[1:-1]
    starts = solid & ~before[:-1]
    cut = inner[inner < len(data)]
    starts[cut] = solid[cut]
    at = np.flatnonzero(starts)
    after = np.empty(len(data) + 1, bool)
    after[:-1], after[-1] = solid, False
    ends = solid & ~after[1:]
    stop = inner[inner > 0] - 1
    ends[stop] = solid[stop]
    return at, np.flatnonzero(ends) + 1, np.searchsorted(offsets, at, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, A-Z as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    letters = _LOWER[data[np.repeat(starts, lengths) + place]]
    values = _MIX[place % _PLACES, letters]
    far = np.flatnonzero(place >= _PLACES)
    if len(far):
        # The block is mixed into each byte's value, so that no sum of blocks tells the same as another.
        values[far] = mixed(values[far] ^ ((place[far] // _PLACES).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return mixed(np.add.reduceat(values, first) + lengths.astype(np.uint64))
