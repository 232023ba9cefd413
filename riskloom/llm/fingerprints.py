"""Fingerprints that cut bytes into segments so that equal windows meet under one key.

Every window of `length` bytes has the smallest hash among its runs of `GRAM` bytes as key, the leftmost
of equal ones.  Neighbouring windows whose key lies in one place form a segment.  Equal windows have equal
keys, in different places, so windows need comparing only between the segments of a key; and
equal segments, told by one digest, have only equal windows.
"""

import numpy as np

GRAM = 48
# Bytes looked at together; a place in them has PLACE bits.
CHUNK, PLACE = 4_000_000, 22

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(7).integers(1, 2**63, 256).astype(np.uint64) * _U(2) + _U(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and its inverse modulo 2**64, for i up to n."""
    if len(_powers["up"]) <= n:
        size = max(n + 1, 2 * len(_powers["up"]))
        for name, factor in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            factors = np.full(size, factor, np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"], _powers["down"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of `width` values."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(-1, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def segments(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """key, digest, first and last window start of each segment; none for shorter texts."""
    parts = [_segments(data[at : at + CHUNK + length - 1], length, at) for at in range(0, max(0, len(data) - length + 1), CHUNK)]
    if not parts:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _segments(data: bytes, length: int, offset: int):
    gram = min(GRAM, length)
    b = np.frombuffer(data, np.uint8)
    up, down = _power(len(b))
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_VALUES[b] * up[: len(b)], out=total[1:])
    grams = _mix((total[gram:] - total[:-gram]) * down[: len(b) - gram + 1])
    places = _U((1 << PLACE) - 1)
    least = _sliding_min((grams & ~places) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    start = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    size = np.diff(np.append(start, len(least)))
    last = start + size - 1
    digest = _mix(_mix((total[last + length] - total[start]) * down[start]) ^ size.astype(np.uint64))
    return grams[least[start] & places], digest, start + offset, last + offset
