"""Hashed sets of word shingles, by numpy over blocks of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BLOCK = 1 << 21


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all others."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTES = np.arange(256, dtype=np.uint64)
_BYTES[65:91] += np.uint64(32)  # A-Z count as a-z
_VALUE = mixed(_BYTES + np.uint64(0x1234567))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as a block needs them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, _BLOCK)
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _INVERSE)]), dtype=np.uint64)
        return self.up[:n], self.down[:n]


def word_hashes(data: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of ``data`` (bytes, ending with white space)."""
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    up, down = powers.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[:-1], out=total[1:])
    return starts, mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(texts: list[bytes], width: int, powers: Powers) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text: runs of ``width`` words, or all words if there are fewer; none without words."""
    at = 0
    while at < len(texts):
        size, upto = 0, at
        while upto < len(texts) and (upto == at or size + len(texts[upto]) < _BLOCK):
            size += len(texts[upto]) + 1
            upto += 1
        block = texts[at:upto]
        data = np.frombuffer(b" ".join([*block, b""]), np.uint8)
        starts, hashes = word_hashes(data, powers)
        bounds = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in block]))
        run = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
        for i in range(width):
            run = (run + hashes[i : i + len(run)]) * _STEP
        run = mixed(run + np.uint64(width))
        for first, last in zip(bounds[:-1], bounds[1:], strict=True):
            if last - first >= width:
                yield np.unique(run[first : last - width + 1])
            elif last > first:
                short = np.zeros(1, np.uint64)
                for i in range(first, last):
                    short = (short + hashes[i]) * _STEP
                yield mixed(short + np.uint64(last - first))
            else:
                yield np.zeros(0, np.uint64)
        at = upto


class MinHash:
    """``size`` minima of a set under fixed multiplications of its 32-bit hashes."""

    def __init__(self, size: int) -> None:
        seeds = mixed(np.arange(1, 2 * size + 1, dtype=np.uint64) * _BASE)
        self.mask = (seeds[:size] >> np.uint64(32)).astype(np.uint32)
        self.factor = (seeds[size:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.mask), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 2048):
            low = np.minimum(low, ((x[i : i + 2048, None] ^ self.mask) * self.factor).min(axis=0))
        return low
