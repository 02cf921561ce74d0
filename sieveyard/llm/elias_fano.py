"""Elias-Fano sequences over NumPy arrays: built in memory, written to one file, queried in place through a memory map."""

from __future__ import annotations

import json
import os
import uuid

import numpy as np

_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)
#: Place of the r-th zero, and of the r-th one, of each byte value; 8 where there is none.
_ZERO_AT = np.array([([k for k in range(8) if not b >> k & 1] + [8] * 8)[:8] for b in range(256)], np.uint8)
_ONE_AT = np.array([([k for k in range(8) if b >> k & 1] + [8] * 8)[:8] for b in range(256)], np.uint8)


def encode(values: np.ndarray, universe_bits: int, low_bits: int | None = None) -> dict[str, np.ndarray]:
    """Arrays of a sequence of n sorted unsigned numbers below 2 ** universe_bits.

    Low bits stand packed side by side; the number of values for each value of the high bits stands in
    unary: a one for each value, then a zero. `zeros` counts the zeros before each word of 64 bits. With
    low_bits given, the high bits can be what a caller groups by: the unary part is then its pointers.
    """
    values = values.astype(np.uint64)
    n = len(values)
    low = min(max(universe_bits - max(n, 1).bit_length() + 1, 0), 57) if low_bits is None else low_bits
    high = (values >> np.uint64(low)).astype(np.int64)
    top = (int(high[-1]) if n else 0) + 1
    bits = np.zeros(-(-(n + top) // 64) * 64, np.uint8)
    bits[high + np.arange(n)] = 1
    packed = np.packbits(bits, bitorder="little")
    ones = np.cumsum(_POP[packed].reshape(-1, 8).sum(axis=1, dtype=np.int64))
    zeros = np.arange(1, len(ones)) * 64 - ones[:-1]
    parts = []
    if low:
        for at in range(0, n, 1 << 16):  # a multiple of 8 values fills whole bytes
            own = values[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
            parts.append(np.packbits(np.unpackbits(own, axis=1, bitorder="little")[:, :low].reshape(-1), bitorder="little"))
    lows = np.concatenate([*parts, np.zeros(8, np.uint8)])
    kind = np.int32 if n + top < 1 << 31 else np.int64
    return {"meta": np.array([n, low, top], np.int64), "lows": lows, "high": packed, "zeros": np.concatenate([[0], zeros]).astype(kind)}


class Sequence:
    """A sequence as encode() laid it out. All methods take and return arrays, and touch only the bytes they need."""

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.n, self.low, self.top = (int(x) for x in arrays["meta"])
        lows = arrays["lows"]
        self._lows = np.ndarray((len(lows) - 7,), "<u8", buffer=lows, strides=(1,))
        self._high = arrays["high"]
        self._words = arrays["high"].reshape(-1, 8)
        self._zeros = arrays["zeros"]
        self._mask = np.uint64((1 << self.low) - 1)

    def _select(self, k: np.ndarray, zero: bool) -> np.ndarray:
        """Places of the k-th zeros or ones: the directory gives the word, its bytes' counts the byte, a table the bit."""
        before = self._zeros if zero else np.arange(len(self._zeros)) * 64 - self._zeros
        word = np.searchsorted(before, k.astype(before.dtype), side="right") - 1
        rows = self._words[word]
        count = np.cumsum(8 - _POP[rows] if zero else _POP[rows], axis=1, dtype=np.uint8)
        rest = k - before[word]
        byte = (count <= rest[:, None]).sum(axis=1)
        lines = np.arange(len(k))
        rest = rest - np.where(byte > 0, count[lines, byte - 1], 0)
        return (word * 8 + byte) * 8 + (_ZERO_AT if zero else _ONE_AT)[rows[lines, byte], rest]

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low
        return (self._lows[bit >> 3] >> (bit & 7).astype(np.uint64)) & self._mask

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        return (self._select(i, False) - i).astype(np.uint64) << np.uint64(self.low) | self.lows(i)

    def _start(self, high: np.ndarray) -> np.ndarray:
        """The bit after the zero that ends the bucket before."""
        out = np.zeros(len(high), np.int64)
        some = np.flatnonzero(high > 0)
        out[some] = self._select(high[some] - 1, True) + 1
        return out

    def bucket(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[first, end) of the values with these high bits, all below top."""
        return self._start(high) - high, self._select(high, True) - high

    def search(self, first: np.ndarray, end: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The place of the value with these low bits in each range of one bucket, or -1: the successor, if equal."""
        at, stop = first.copy(), end.copy()
        active = np.flatnonzero(at < stop)
        while len(active):
            middle = (at[active] + stop[active]) >> 1
            below = self.lows(middle) < low[active]
            at[active[below]] = middle[below] + 1
            stop[active[~below]] = middle[~below]
            active = active[at[active] < stop[active]]
        out = np.full(len(low), -1, np.int64)
        hit = np.flatnonzero(at < end)
        hit = hit[self.lows(at[hit]) == low[hit]]
        out[hit] = at[hit]
        return out

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of each x, or -1. For values spread evenly: a bucket's few values are read one by one."""
        out = np.full(len(x), -1, np.int64)
        x = x.astype(np.uint64)
        high = (x >> np.uint64(self.low)).astype(np.int64)
        active = np.flatnonzero((high >= 0) & (high < self.top)) if self.n else np.empty(0, np.int64)
        bit = self._start(high[active])
        place, want = bit - high[active], x[active] & self._mask
        while len(active):
            there = (self._high[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
            active, bit, place, want = active[there], bit[there], place[there], want[there]
            own = self.lows(place)
            hit = own == want
            out[active[hit]] = place[hit]
            on = own < want
            active, bit, place, want = active[on], bit[on] + 1, place[on] + 1, want[on]
        return out


def write_arrays(path: str, arrays: dict[str, np.ndarray]) -> None:
    """All arrays in one file, whole or not at all: a task that runs twice replaces the file by its like."""
    head, offset = {}, 0
    for name, a in arrays.items():
        head[name] = [a.dtype.str, offset, len(a)]
        offset += -(-a.nbytes // 64) * 64
    line = json.dumps(head).encode()
    line += b" " * (-(len(line) + 1) % 64) + b"\n"
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as out:
        out.write(line)
        for a in arrays.values():
            out.write(a.tobytes())
            out.write(bytes(-a.nbytes % 64))
    os.replace(own, path)


def map_arrays(path: str) -> dict[str, np.ndarray]:
    with open(path, "rb") as lines:
        line = lines.readline()
    whole = np.memmap(path, np.uint8, "r")
    out = {}
    for name, (kind, offset, n) in json.loads(line).items():
        at = len(line) + offset
        out[name] = whole[at : at + n * np.dtype(kind).itemsize].view(kind)
    return out


def named(prefix: str, arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {f"{prefix}.{k}": v for k, v in arrays.items()}


def part(prefix: str, arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {k[len(prefix) + 1 :]: v for k, v in arrays.items() if k.startswith(f"{prefix}.")}
