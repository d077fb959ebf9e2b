"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Separators are ASCII, so cutting at bytes is the same as cutting at characters.
A word's 64-bit hash comes from one running sum over the bytes: each byte has a
random 64-bit value, times an odd multiplier to the power of its place; the
difference of two sums, shifted to place 0, depends on the word alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_rng = np.random.default_rng(20)
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
for _b in range(65, 91):  # A-Z count as a-z
    _VALUES[_b] = _VALUES[_b + 32]
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)

#: True at space and at \t to \r.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: True at every ASCII byte that is no letter or digit.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = max(n, 1 << 20)
        got = np.full(size, base, np.uint64)
        got[0] = 1
        got = np.multiply.accumulate(got)
        _powers.clear() if len(_powers) > 2 else None
        _powers[base] = got
    return got[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (splitmix64's finishing step)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(column: pa.Array, most: int = 600_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) over runs of rows with about ``most`` bytes; one
    text is never cut. ``column`` holds strings without nulls."""
    a = column.cast(pa.large_binary())
    _, offs, data = a.buffers()
    offs = np.frombuffer(offs, np.int64)[a.offset:a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(a):
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + most, "right")) - 1)
        yield at, data[offs[at]:offs[end]], offs[at:end + 1] - offs[at]
        at = end


def word_hashes(data: np.ndarray, offs: np.ndarray, separators: np.ndarray = SPACE,
                places: bool = False):
    """(hash of each word, words before each text's start); with ``places`` also
    each word's first and last byte + 1."""
    n = len(data)
    inside = ~separators[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offs[1:-1]
    cuts = cuts[cuts < n]
    first[cuts] |= inside[cuts]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    back = cuts[cuts > 0] - 1
    last[back] |= inside[back]
    ends = np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[data] * _power(_P, n), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power(_P_INV, n + 1)[starts]
    h = mix(h + (ends - starts).astype(np.uint64) * np.uint64(_P))
    bounds = np.searchsorted(starts, offs)
    return (h, bounds, starts, ends) if places else (h, bounds)


def grams(h: np.ndarray, bounds: np.ndarray, n: int, short: bool = False):
    """(hashes of all runs of ``n`` words within a text, row of each, number of its
    first word). With ``short`` a text of fewer words gives one run of all its words."""
    parts = np.zeros(max(len(h) - n + 1, 0), np.uint64)
    for i in range(n):
        parts += mix(h[i:i + len(parts)] + np.uint64((i + 1) * 0xD6E8FEB86659FD93 & (2 ** 64 - 1)))
    count = np.diff(bounds)
    runs = np.maximum(count - n + 1, 0)
    row = np.repeat(np.arange(len(count)), runs)
    where = bounds[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs))
    out = mix(parts[where] + np.uint64(n))
    if short:
        few = np.flatnonzero((count > 0) & (count < n))
        if len(few):
            own = np.array([_whole(h[bounds[r]:bounds[r + 1]]) for r in few], np.uint64)
            out, row, where = (np.concatenate([out, own]), np.concatenate([row, few]),
                               np.concatenate([where, bounds[few]]))
    return out, row, where


def _whole(h: np.ndarray) -> int:
    total = 0
    for i, x in enumerate(h.tolist()):
        total += int(mix(np.array([x + (i + 1) * 0xD6E8FEB86659FD93 & (2 ** 64 - 1)], np.uint64))[0])
    return int(mix(np.array([total + len(h) & (2 ** 64 - 1)], np.uint64))[0])
