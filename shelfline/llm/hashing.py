"""Words and n-grams of many texts at once, as numpy arrays.

Texts are handled as UTF-8 bytes.  All separators used here are ASCII, so word bounds on bytes and on code
points agree.  A hash is a polynomial over a random table, taken from prefix sums, then mixed; two texts of
n bytes with different words share a 64-bit hash with a chance of about 2**-64."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

U64 = np.uint64


def _byte_set(outside: bytes) -> np.ndarray:
    inside = np.ones(256, dtype=bool)
    inside[np.frombuffer(outside, dtype=np.uint8)] = False
    return inside


#: Bytes of a word: everything but space and \t \n \v \f \r.
PLAIN = _byte_set(b" \t\n\v\f\r")
#: Bytes of a word of letters and digits; bytes from 0x80 belong to words.
ALNUM = _byte_set(bytes(b for b in range(0x80) if not (48 <= b <= 57 or 97 <= b <= 122)))


@lru_cache(maxsize=8)
def _table(seed: int, rows: int = 256) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, rows, dtype=np.uint64) | U64(1)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i below ``size``."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < size:
        room = max(size, 1 << 16)
        pair = []
        for b in (base, pow(base, -1, 2**64)):
            p = np.full(room, b, dtype=np.uint64)
            p[0] = 1
            pair.append(np.cumprod(p, dtype=np.uint64))
        have = (pair[0], pair[1])
        if room <= 1 << 20:  # longer ones are made again: a worker would hold them through all its later work
            _POWERS[base] = have
    return have[0][:size], have[1][:size]


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finalizer that spreads every input bit over the word."""
    h = h + U64((0x9E3779B97F4A7C15 * (salt + 1)) % 2**64)
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


BYTE_BASE, WORD_BASE, SECOND_BASE = 0xD1342543DE82EF95, 0x2545F4914F6CDD1D, 0xAEF17502108EF2D9


@dataclass(frozen=True)
class Words:
    """Words of a list of texts; ``first[d]`` is the first word of text d, ``first[-1]`` the number of words."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Text of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def text_end(self) -> np.ndarray:
        """For every word, the end (in words) of its text."""
        return np.repeat(self.first[1:], self.counts)


def words_of(texts: list[bytes], inside: np.ndarray = PLAIN) -> Words:
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    flags = inside[data].view(np.int8)
    edge = np.diff(flags, prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    return Words(data, starts, ends, np.searchsorted(starts, bounds))


def word_hashes(words: Words, seed: int = 1) -> np.ndarray:
    if not len(words.starts):
        return np.empty(0, dtype=np.uint64)
    up, down = powers(BYTE_BASE, len(words.data))
    total = np.zeros(len(words.data) + 1, dtype=np.uint64)
    np.cumsum(_table(seed)[words.data] * up, out=total[1:])
    return mix((total[words.ends] - total[words.starts]) * down[words.starts])


def ngram_hashes(hashes: np.ndarray, n: int, base: int = WORD_BASE, salt: int = 0) -> np.ndarray:
    """Hash of the n words from each position on; fewer entries than words by n - 1.  Windows that run over
    the end of a text are hashed too; ``Words.text_end`` tells them apart."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, dtype=np.uint64)
    up, down = powers(base, len(hashes))
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up, out=total[1:])
    return mix((total[n:] - total[:-n]) * down[:size], salt + n)


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` positions lie in a window of ``n`` from one of the flagged starts."""
    steps = np.zeros(size + 1, dtype=np.int32)
    at = np.flatnonzero(starts)
    np.add.at(steps, at, 1)
    np.add.at(steps, np.minimum(at + n, size), -1)
    return np.cumsum(steps[:size]) > 0


def number(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on in the narrowest width, with that width in the first byte."""
    kind = np.min_scalar_type(int(values.max()) if len(values) else 0)
    return bytes([kind.itemsize]) + values.astype(kind).tobytes()


def numbers(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=f"<u{blob[0]}", offset=1)
