"""Vectorised 64-bit fingerprints of byte strings, for use inside tasks.

A fingerprint of ``buf[a:b]`` depends on its bytes alone, not on its place. ``Rolling``
gives those of any substrings: prefix sums of table values times powers of an odd number,
divided by the power at ``a``. Such sums are linear, and strings of some hundred bytes can be
made that agree in them, so they serve features and short strings. ``codes`` chains
mixed blocks, which no such structure passes through, and serves where equality counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from hashlib import blake2b

import numpy as np

MASK = (1 << 64) - 1
# Odd multipliers of the splitmix64 finaliser.
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of ``x`` over all bits; one-to-one."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    have = 1
    while have < n:
        step = np.uint64(pow(base, have, 1 << 64))
        more = min(have, n - have)
        out[have:have + more] = out[:more] * step
        have += more
    return out


@cache
def _tables(seed: int) -> tuple[np.ndarray, int]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, MASK, 256, dtype=np.uint64), int(rng.integers(1, MASK, dtype=np.uint64)) | 1


_grown: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    held = _grown.get(seed)
    if held is None or len(held[0]) < n:
        base, size = _tables(seed)[1], 1 << max(16, int(n - 1).bit_length())
        held = _powers(base, size), _powers(pow(base, -1, 1 << 64), size)
        if size <= 1 << 24:
            _grown[seed] = held
    return held


class Rolling:
    """Fingerprints of any substrings of one buffer."""

    def __init__(self, buf: np.ndarray, seed: int = 1) -> None:
        n = len(buf)
        table, _ = _tables(seed)
        powers, self._inverse = _power_tables(seed, n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[buf] * powers[:n], out=self._sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """One fingerprint for each ``buf[start:end]``; the length counts as well."""
        return mix((self._sums[end] - self._sums[start]) * self._inverse[start] + (end - start).astype(np.uint64))

    def grams(self, n: int) -> np.ndarray:
        """Fingerprints of all substrings of ``n`` bytes, by where they start."""
        if len(self._sums) <= n:
            return np.zeros(0, np.uint64)
        return mix((self._sums[n:] - self._sums[:-n]) * self._inverse[: len(self._sums) - n] + np.uint64(n))


# Bytes that count of the last block of a span, by how many are left; spans beyond the bound are hashed one by one.
LEFT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LONG_SPAN = 512


def codes(buf: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """One fingerprint for each ``buf[first:last]``: its length, mixed with one block of eight bytes after the other."""
    lengths = last - first
    out = mix(lengths.astype(np.uint64) + MIX_1)
    eight = np.ndarray(len(buf) + 1, "<u8", np.concatenate([buf, np.zeros(8, np.uint8)]), 0, (1,))
    left = np.flatnonzero((lengths > 0) & (lengths <= LONG_SPAN))
    step = 0
    while len(left):
        rest = lengths[left] - step
        out[left] = mix(out[left] ^ (eight[first[left] + step] & LEFT[np.minimum(rest, 8)]))
        left, step = left[rest > 8], step + 8
    for i in np.flatnonzero(lengths > LONG_SPAN):
        out[i] = int.from_bytes(blake2b(buf[first[i]:last[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def joined(texts: list[bytes], gap: bytes = b"") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one buffer, and where each starts and ends in it."""
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    ends = np.cumsum(lengths + len(gap)) - len(gap)
    return np.frombuffer(gap.join(texts), np.uint8), ends - lengths, ends


def chunks(ids: Iterable, texts: Iterable, limit: int) -> Iterator[tuple[list, list[bytes]]]:
    """Lists of whole texts of about ``limit`` bytes together; a longer text makes a list of its own."""
    held_ids, held, size = [], [], 0
    for i, t in zip(ids, texts):
        data = b"" if t is None else t.encode("utf-8", "surrogatepass") if isinstance(t, str) else t
        if held and size + len(data) > limit:
            yield held_ids, held
            held_ids, held, size = [], [], 0
        held_ids.append(i)
        held.append(data)
        size += len(data)
    if held:
        yield held_ids, held


WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


def words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs without white space (space, tab to carriage return) start and end."""
    solid = np.zeros(len(buf) + 2, np.int8)
    solid[1:-1] = ~WHITE[buf]
    edge = np.diff(solid)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
