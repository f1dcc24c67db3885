"""Vectorised 64-bit hashes of the words of whole texts, for use inside tasks.

A word is a run of bytes without separators. Its hash is a polynomial in an odd base over
random byte codes, taken from one running sum, so the cost does not depend on the number
of words. Buffers are worked through in windows that end at a separator, so the memory
beyond the text itself is bounded (one word may extend a window).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

WINDOW_BYTES = 1 << 20

# Bytes between words: the ASCII white space (fixed values).
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# Everything but ASCII letters and the bytes of longer UTF-8 characters.
NON_LETTERS = np.ones(256, dtype=bool)
NON_LETTERS[0x80:] = False
NON_LETTERS[ord("a"):ord("z") + 1] = False
NON_LETTERS[ord("A"):ord("Z") + 1] = False

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[ord("A"):ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15
_CODES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LENGTH = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.forward = self.inverse = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.forward) < n:
            size = max(n, WINDOW_BYTES + 4096)
            steps = np.full(size, _BASE, dtype=np.uint64)
            back = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
            steps[0] = back[0] = 1
            self.forward, self.inverse = np.cumprod(steps), np.cumprod(back)
        return self.forward[:n], self.inverse[:n]


_POWERS = _Powers()


def _windows(buffer: np.ndarray, separators: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive pieces; none but the last ends inside a word."""
    start, size = 0, len(buffer)
    while start < size:
        end = min(size, start + WINDOW_BYTES)
        while end < size and not separators[buffer[end - 1]]:
            ahead = np.flatnonzero(separators[buffer[end:end + 4096]])
            end = end + int(ahead[0]) + 1 if len(ahead) else min(size, end + 4096)
        yield start, end
        start = end


def word_hashes(
    buffer: np.ndarray, separators: np.ndarray = SPACES, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hashes of all words in a byte buffer, where they start, and hashes of prefixes.

    For each length in ``prefixes`` one array holds the hash of that many leading bytes
    of every word, or 0 for shorter words.
    """
    hashes, starts, leading = [], [], [[] for _ in prefixes]
    for low, high in _windows(buffer, separators):
        piece = buffer[low:high]
        inside = np.zeros(len(piece) + 2, dtype=np.int8)
        inside[1:-1] = ~separators[piece]
        edges = np.diff(inside)
        first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        powers, inverse = _POWERS.upto(len(piece))
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_CODES[piece] * powers, out=sums[1:])
        length = last - first
        hashes.append(mix((sums[last] - sums[first]) * inverse[first] + length.astype(np.uint64) * _LENGTH))
        starts.append(first + low)
        for n, found in zip(prefixes, leading):
            end = np.minimum(first + n, last)
            value = mix((sums[end] - sums[first]) * inverse[first] + np.uint64((1000 + n) * int(_LENGTH) % 2**64))
            found.append(np.where(length >= n, value, np.uint64(0)))
    if not hashes:
        none = np.zeros(0, dtype=np.uint64)
        return none, np.zeros(0, dtype=np.int64), [none for _ in prefixes]
    return np.concatenate(hashes), np.concatenate(starts), [np.concatenate(x) for x in leading]


def chunks(texts: Iterable[str | None], limit: int = WINDOW_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts as UTF-8 (null: empty), in groups of about ``limit`` bytes.

    Yields the place of the first text of each group with the group.
    """
    group, held, first = [], 0, 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        if group and held + len(data) > limit:
            yield first, group
            first, group, held = first + len(group), [], 0
        group.append(data)
        held += len(data)
    if group:
        yield first, group


def batch_words(
    group: list[bytes], separators: np.ndarray = SPACES, lower: bool = True, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Word hashes of a group of texts, the bounds of each text's words, and prefix hashes."""
    buffer = np.frombuffer(b"\n".join(group) + b"\n", dtype=np.uint8)
    if lower:
        buffer = ASCII_LOWER[buffer]
    hashes, starts, leading = word_hashes(buffer, separators, prefixes)
    offsets = np.zeros(len(group) + 1, dtype=np.int64)
    np.cumsum([len(text) + 1 for text in group], out=offsets[1:])
    return hashes, np.searchsorted(starts, offsets), leading


def sequence_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words; order matters."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    value = np.full(count, size, dtype=np.uint64)
    for place in range(size):
        value = mix(value * _LENGTH + words[place:place + count])
    return value
