"""Terms of texts inside tasks: runs of ASCII letters, digits and all other characters beyond ASCII, only A to Z lower-cased."""

from __future__ import annotations

import numpy as np

from tidemark.llm.rolling import joined, words

SPACE = 0x20
# What each byte counts as: itself, its lower case, or a space.
COUNTS_AS = np.full(256, SPACE, np.uint8)
COUNTS_AS[0x80:] = np.arange(0x80, 0x100)
for _low, _high, _shift in ((ord("0"), ord("9"), 0), (ord("a"), ord("z"), 0), (ord("A"), ord("Z"), 32)):
    COUNTS_AS[_low:_high + 1] = np.arange(_low, _high + 1) + _shift


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one lower-cased buffer, where each term starts and ends in it, and the place of its text in the list."""
    buf, _, ends = joined(texts, b" ")
    buf = COUNTS_AS[buf]
    first, last = words(buf)
    return buf, first, last, np.searchsorted(ends, first, "right")


def stream(buf: np.ndarray, first: np.ndarray, last: np.ndarray, spare: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """The terms with one space before each and one after the last, ``spare`` zero bytes after that, and where the spaces are."""
    lengths = last - first
    spaces = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = np.full(spaces[-1] + 1 + spare, SPACE, np.uint8)
    out[spaces[-1] + 1:] = 0
    inside = np.zeros(len(buf) + 1, np.int8)
    inside[first] += 1
    inside[last] -= 1
    kept = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
    filled = np.ones(spaces[-1] + 1, bool)
    filled[spaces] = False
    out[: spaces[-1] + 1][filled] = buf[kept]
    return out, spaces


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, without a copy."""
    return np.ndarray(len(data) - 7, "<u8", data, 0, (1,))


def ramps(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
