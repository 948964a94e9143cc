"""Words, word windows and their hashes, computed for many documents at once.

A word is a maximal run of bytes other than ``\\x20`` and ``\\x09-\\x0D``.  These
separators are ASCII, so splitting UTF-8 bytes equals splitting code points.
Texts of an Arrow batch are joined by a separator and hashed with array
arithmetic modulo 2**64; nothing runs per character in Python.  Work is done
in chunks of bounded size, so a batch of very long texts needs no more memory
than its longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 21  # bytes of text hashed at once
_SEP = np.zeros(256, dtype=bool)
_SEP[[32, 9, 10, 11, 12, 13]] = True
_U = np.uint64


def _odd(seed: int) -> int:
    return int(np.random.default_rng(seed).integers(1 << 62, (1 << 63) - 1)) | 1


class _Poly:
    """Powers of an odd base and of its inverse, and a random value for each byte."""

    def __init__(self, seed: int):
        base = _odd(seed)
        self.base, self.inverse = _U(base), _U(pow(base, -1, 1 << 64))
        self.values = np.random.default_rng(seed + 1).integers(1, (1 << 63) - 1, 256, dtype=np.uint64)
        self.step = _U(_odd(seed + 2))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up = np.cumprod(np.concatenate(([_U(1)], np.full(size - 1, self.base))), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate(([_U(1)], np.full(size - 1, self.inverse))), dtype=np.uint64)
        return self.up, self.down


_POLY = {seed: _Poly(seed) for seed in (11, 29)}
HASHES = tuple(_POLY)  # two independent 64-bit hashes make one 128-bit identity


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def encoded(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null counts as empty."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most ``limit`` bytes together, or of one longer text."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > limit:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


class Words:
    """The words of several texts: byte ranges in ``buf``; words of text i are ``bounds[i]:bounds[i + 1]``."""

    def __init__(self, texts: list[bytes]):
        self.buf = b"\n".join(texts) + b"\n"
        self.bytes = np.frombuffer(self.buf, dtype=np.uint8)
        inside = ~_SEP[self.bytes]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.concatenate(([0], edge))
        self.starts, self.ends = edge[0::2], edge[1::2]
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        p = _POLY[seed]
        out = np.empty(len(self.starts), dtype=np.uint64)
        at = 0
        while at < len(out):  # segments that end with a word keep the power tables small
            base = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, base + (1 << 18), side="right")))
            raw = self.bytes[base:self.ends[to - 1]]
            up, down = p.powers(len(raw) + 1)
            sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(p.values[raw] * up[:len(raw)], dtype=np.uint64)))
            s, e = self.starts[at:to] - base, self.ends[at:to] - base
            out[at:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
            at = to
        return out

    def windows(self, n: int) -> np.ndarray:
        """Indexes of the words that start a window of ``n`` words of one text."""
        owner = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        if len(owner) < n:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1:])


def rolled(word_hashes: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A hash of every ``n`` consecutive words (also across texts; mask with :meth:`Words.windows`)."""
    size = max(0, len(word_hashes) - n + 1)
    step, out = _POLY[seed].step, np.zeros(size, dtype=np.uint64)
    for k in range(n):
        out = out * step + word_hashes[k:k + size]
    return mix(out)


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window of ``n`` words that begins at one of ``starts``."""
    steps = np.zeros(size + n + 1, dtype=np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + n, -1)
    return np.cumsum(steps)[:size] > 0
