"""Texts as flat numpy arrays: slicing, words, and 64-bit hashes of any span.

A batch of texts becomes one byte buffer with offsets.  Words and spans are
hashed with a polynomial over random byte weights modulo 2^64: one running sum
gives the hash of every span by a subtraction, and a final mix spreads it.
Equal spans have equal hashes; unequal ones meet with probability about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WEIGHT = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
SLICE_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ...; the longest list so far is kept."""
    if base not in POWERS or len(POWERS[base]) < n:
        out = np.full(max(n, SLICE_BYTES + 64), base, U)
        out[0] = 1
        POWERS[base] = np.multiply.accumulate(out)
    return POWERS[base][:n]


class Spans:
    """Hashes of spans of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(values * powers(BASE, n), out=self.sums[1:])
        self.back = powers(INVERSE, n + 1)

    def hash(self, start: np.ndarray | slice, stop: np.ndarray | slice) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.back[start])

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k values from each position on."""
        n = len(self.sums) - k
        return self.hash(slice(0, n), slice(k, n + k)) if n > 0 else np.zeros(0, U)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most so many bytes each; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


@dataclass
class Words:
    """Words of a run of texts: byte range, hash, and the first word of each text."""

    start: np.ndarray
    stop: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # one more entry than texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(raw: np.ndarray, offsets: np.ndarray) -> Words:
    """Maximal runs without ASCII white space; no word crosses a text."""
    inside = ~SPACE[raw]
    edges = offsets[(offsets > 0) & (offsets < len(raw))]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] = inside[edges - 1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    spans = Spans(WEIGHT[raw])
    return Words(start, stop, spans.hash(start, stop), np.searchsorted(start, offsets))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of so many values."""
    out, reach = values, 1
    while reach * 2 <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    return np.minimum(out[: len(out) - (width - reach)], out[width - reach :]) if reach < width else out


def runs(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def ranges(start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start..start+count-1 for each pair, one after the other."""
    return np.repeat(start, counts) + runs(counts)


def scatter(target: np.ndarray, columns: dict[str, np.ndarray], extra: dict[str, object] | None = None) -> pa.RecordBatch | None:
    """One row for each target in use, with the entries of every column that go there as bytes."""
    if not len(target):
        return None
    order = np.argsort(target, kind="stable")
    at = target[order]
    cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    stops = np.r_[cuts[1:], len(at)]
    out: dict[str, pa.Array] = {"bucket": pa.array(at[cuts].astype(np.int32))}
    for name, value in (extra or {}).items():
        out[name] = pa.array([value] * len(cuts))
    for name, column in columns.items():
        placed = column[order]
        out[name] = pa.array([placed[a:b].tobytes() for a, b in zip(cuts.tolist(), stops.tolist())], pa.binary())
    return pa.RecordBatch.from_pydict(out)


def gather(table: pa.Table, name: str, dtype: object) -> np.ndarray:
    """The entries of a column made by scatter(), of all rows."""
    raw, _ = flat(table[name].cast(pa.large_binary()))
    return np.frombuffer(raw.tobytes(), dtype)


def crc32_rows(raw: bytes | memoryview, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """crc32 of byte ranges of one buffer."""
    import zlib

    view = memoryview(raw)
    return np.array([zlib.crc32(view[a:b]) for a, b in zip(starts.tolist(), stops.tolist())], np.int64)
