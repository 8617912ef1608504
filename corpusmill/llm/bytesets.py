"""Vectorised helpers on concatenated UTF-8 bytes, run inside Python workers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# ASCII white space: U+0020 and U+0009-U+000D; everything else belongs to words.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def column_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow column; null rows are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks else pa.array([], col.type)
    col = col.cast(pa.large_binary()).fill_null(b"")
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1] if len(col) \
        else np.zeros(1, np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offs[0]:offs[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def join_bytes(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offs = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offs[1:])
    return np.frombuffer(b"".join(parts), np.uint8), offs


def word_bounds(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and each text's first word number (one more entry at the end)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POW.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up = np.full(size, base, np.uint64)
        down = np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = _POW[base] = (np.cumprod(up), np.cumprod(down))
    return have[0][:n], have[1][:n]


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Position-independent 64-bit hash of ``values[start:end]`` for many ranges at once."""
    n = len(values)
    up, down = _powers(n + 1, base)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` consecutive values (length n - width + 1)."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def take_ranges(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``data[s:s+l]`` for every pair."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, data.dtype)
    ends = np.cumsum(lengths)
    index = np.repeat((starts - (ends - lengths)).astype(np.int64), lengths)
    index += np.arange(total, dtype=np.int64)
    return data[index]


def byte_list(col: pa.Array) -> list[bytes]:
    """The values of a large binary array without nulls: one copy of the data, then slices."""
    data, offs = column_bytes(col)
    raw, edge = data.tobytes(), offs.tolist()
    return [raw[a:b] for a, b in zip(edge, edge[1:])]


def room(values: np.ndarray, need: int) -> np.ndarray:
    """The array, grown to twice its length at least where ``need`` is beyond it."""
    if need <= len(values):
        return values
    out = np.zeros(max(need, 2 * len(values)), values.dtype)
    out[:len(values)] = values
    return out


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Boolean mask of the positions inside any of the ranges."""
    delta = np.bincount(starts, minlength=n + 1)[:n + 1] - np.bincount(ends, minlength=n + 1)[:n + 1]
    return np.cumsum(delta[:n]) > 0


def runs_of(mask: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of True; runs stop at text borders ``offs``."""
    n = len(mask)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    prev = np.concatenate(([False], mask[:-1])) & ~edge[:-1]
    nxt = np.concatenate((mask[1:], [False])) & ~edge[1:]
    return np.flatnonzero(mask & ~prev), np.flatnonzero(mask & ~nxt) + 1
