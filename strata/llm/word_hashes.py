"""Words of many texts at once: where they lie in a buffer, and 64-bit hashes of them, by array operations alone.

A word's hash is a polynomial of its bytes, taken from running sums over the buffer, and then mixed. Long words, whose
polynomials could be made to collide, are hashed one by one instead.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd bases of the polynomials; a second one gives a second, independent hash. Fixed values.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Bytes of a buffer that are hashed together (few enough to stay in a processor's cache), and the length from which a word is
#: hashed on its own.
CHUNK = 1 << 18
LONG_WORD = 256

_MIX = np.uint64(0xFF51AFD7ED558CCD)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _MIX
    return x ^ (x >> np.uint64(29))


class _Powers:
    """Powers of a base and of its inverse, modulo 2 to the 64, as far as they were needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            more = len(self.up)
            up, down = (np.uint64(pow(x, more, 1 << 64)) for x in (self.base, self.inverse))
            self.up, self.down = np.concatenate([self.up, self.up * up]), np.concatenate([self.down, self.down * down])


_POWERS = tuple(_Powers(b) for b in BASES)


def _chunks(buffer: bytes, blanks: tuple[bytes, ...]) -> list[tuple[int, int]]:
    """Parts of about ``CHUNK`` bytes that end after a blank, or where the buffer does."""
    out, at = [], 0
    while at < len(buffer):
        end = at + CHUNK
        if end < len(buffer):
            after = [buffer.find(b, end) for b in blanks]
            end = min((a for a in after if a >= 0), default=len(buffer) - 1) + 1
        out.append((at, min(end, len(buffer))))
        at = out[-1][1]
    return out


def words(buffer: bytes, blanks: bytes, hashes: int = 1) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Starts and ends of the words of ``buffer``, which ``blanks`` part, and one array of hashes per base."""
    table = np.zeros(256, dtype=bool)
    table[list(blanks)] = True
    starts, ends, found = [], [], [[] for _ in range(hashes)]
    for at, end in _chunks(buffer, tuple(bytes([b]) for b in blanks)):
        raw = np.frombuffer(buffer, dtype=np.uint8, count=end - at, offset=at)
        outside = np.empty(len(raw) + 2, dtype=bool)
        outside[0] = outside[-1] = True
        np.take(table, raw, out=outside[1:-1])
        edge = np.flatnonzero(outside[1:] != outside[:-1])
        first, last = edge[0::2], edge[1::2]
        long = np.flatnonzero(last - first > LONG_WORD)
        for k, powers in enumerate(_POWERS[:hashes]):
            powers.reach(len(raw) + 1)
            upto = np.empty(len(raw) + 1, dtype=np.uint64)
            upto[0] = 0
            np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers.up[: len(raw)], out=upto[1:])
            value = mixed((upto[last] - upto[first]) * powers.down[first])
            for i in long.tolist():
                value[i] = xxhash.xxh3_64_intdigest(buffer[at + first[i] : at + last[i]], seed=k)
            found[k].append(value)
        starts.append(first + at)
        ends.append(last + at)
    none = np.empty(0, np.int64)
    return (
        np.concatenate(starts) if starts else none, np.concatenate(ends) if ends else none,
        [np.concatenate(f) if f else np.empty(0, np.uint64) for f in found])
