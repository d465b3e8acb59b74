"""Words of Arrow text columns as flat numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D, which is ``[^\\x20\\x09-\\x0D]+`` on the
characters too, since UTF-8 uses those bytes for nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: True for bytes that belong to words.
IN_WORD = np.ones(256, bool)
IN_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U = np.uint64

#: Elements hashed at once, so that the arrays in between stay small.
CHUNK = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection on 64-bit integers."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def multipliers(n: int, seed: int = 0) -> np.ndarray:
    """n odd 64-bit multipliers; the first ones are the same for every n."""
    return mix((np.arange(1, n + 1, dtype=U) + U(seed * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)) * U(0x9E3779B97F4A7C15)) | U(1)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices starts[0], starts[0] + 1, ..., starts[1], ... of all pieces in a row."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.asarray(starts, dtype=np.int64) - np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return np.repeat(shift, lengths) + np.arange(total)


def group_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each of the consecutive pieces of ``values``; 0 for empty pieces."""
    out = np.zeros(len(lengths), values.dtype)
    full = np.flatnonzero(lengths)
    if len(full):
        out[full] = np.add.reduceat(values, np.concatenate(([0], np.cumsum(lengths[full])[:-1])))
    return out


def sequence_hash(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hashes of the pieces values[start : start + length]."""
    if not len(starts):
        return np.zeros(0, U)
    lengths = np.asarray(lengths, dtype=np.int64)
    table = multipliers(int(lengths.max()) or 1, seed)
    total = np.concatenate(([0], np.cumsum(lengths)))
    out = np.empty(len(starts), U)
    begin = 0
    while begin < len(starts):
        end = max(begin + 1, int(np.searchsorted(total, total[begin] + CHUNK, side="right")) - 1)
        size = lengths[begin:end]
        terms = values[ragged(starts[begin:end], size)].astype(U) * table[ragged(np.zeros(end - begin, np.int64), size)]
        out[begin:end] = mix(group_sums(terms, size) + size.astype(U))
        begin = end
    return out


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


@dataclass
class Words:
    """Words of a batch: byte positions in ``data``, the row of each, and where each row's words begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray  # n rows + 1

    @property
    def lengths(self) -> np.ndarray:
        return self.ends - self.starts

    def hashes(self) -> np.ndarray:
        return sequence_hash(self.data, self.starts, self.lengths, 0) if len(self.starts) else np.zeros(0, U)

    def joined(self) -> tuple[bytes, np.ndarray]:
        """All words with one space after each, and where each word begins there."""
        lengths = self.lengths
        at = np.concatenate(([0], np.cumsum(lengths + 1)))
        out = np.full(int(at[-1]), 0x20, np.uint8)
        out[ragged(at[:-1], lengths)] = self.data[ragged(self.starts, lengths)]
        return out.tobytes(), at


def words(column: pa.Array, lower: bool = False) -> Words:
    data, bounds = flat(column)
    n = len(data)
    if lower:
        data = LOWER[data]
    inside = IN_WORD[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    begins, ends = inside.copy(), inside.copy()
    if n:
        begins[1:] &= edge[1:n] | ~inside[:-1]
        ends[:-1] &= edge[1:n] | ~inside[1:]
    starts = np.flatnonzero(begins)
    row = np.searchsorted(bounds, starts, side="right") - 1
    first = np.searchsorted(row, np.arange(len(bounds)), side="left")
    return Words(data, starts, np.flatnonzero(ends) + 1, row, first)


def slices(batch: pa.RecordBatch, *columns: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``most`` bytes of these columns each (one row at least)."""
    total = np.cumsum(sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns))
    begin = 0
    while begin < batch.num_rows:
        done = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, done + most, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end
