"""Words of many texts at once, as NumPy arrays over their joined bytes.

A word is a longest run of digits, lower-cased A-Z and characters beyond ASCII.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = True
_IN_WORD[128:] = True

_RANDOM = np.random.default_rng(11)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(1, 1 << 63, 1 << 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ h >> np.uint64(33)


@dataclass
class Words:
    """Words of the texts in order. ``first[d]:first[d + 1]`` are those of text d."""

    low: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    _whole: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.starts)

    def text_of(self) -> np.ndarray:
        """For each word its text's number."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def whole(self) -> np.ndarray:
        """64-bit hashes of the words, computed once."""
        if self._whole is None:
            self._whole = self.hashes()[0]
        return self._whole

    def hashes(self, *prefixes: int) -> list[np.ndarray]:
        """64-bit hashes of the whole words, then of their first bytes, as many as each of ``prefixes`` says."""
        if not len(self):
            return [np.zeros(0, dtype=np.uint64) for _ in (0, *prefixes)]
        size = self.ends - self.starts
        heads = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(heads, size)
        at = place + np.repeat(self.starts, size)
        value = _BYTE[self.low[at]] * _PLACE[place & 4095] + place.astype(np.uint64)
        out = [mix(np.add.reduceat(value, heads) + size.astype(np.uint64))]
        for k in prefixes:
            cut = np.minimum(size, k)
            out.append(mix(np.add.reduceat(np.where(place < k, value, 0).astype(np.uint64), heads) + cut.astype(np.uint64)))
        return out

    def word(self, i: int) -> bytes:
        return self.low[self.starts[i]:self.ends[i]].tobytes()


def words(texts: list[str]) -> Words:
    raw = [t.encode() for t in texts]
    joined = b"\n" + b"\n".join(raw) + b"\n"
    low = _LOWER[np.frombuffer(joined, dtype=np.uint8)]
    inside = _IN_WORD[low]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    sizes = np.array([len(r) + 1 for r in raw], dtype=np.int64)
    first = np.searchsorted(starts, np.concatenate(([1], 1 + np.cumsum(sizes))))
    return Words(low, starts, ends, first)


_STEPS = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of ``size`` words per text: text number, 48-bit hash, how often; ordered by text and hash.

    A text with fewer words, but at least one, has one shingle of all its words.
    """
    h, many = found.whole(), np.diff(found.first)
    n, texts = len(h), len(many)
    assert texts < 1 << 16 and size <= len(_STEPS)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    run = np.zeros(max(n - size + 1, 0), dtype=np.uint64)
    for k in range(size):
        run += h[k:k + len(run)] * _STEPS[k]
    # Runs that end in the text they start in.
    text_of = found.text_of()
    inside = text_of[:len(run)] == text_of[size - 1:size - 1 + len(run)]
    key = (text_of[:len(run)][inside].astype(np.uint64) << np.uint64(48)) | (mix(run[inside]) >> np.uint64(16))
    short = np.flatnonzero((many > 0) & (many < size))
    if len(short):
        whole = many[short].astype(np.uint64)
        for k in range(size - 1):
            some = many[short] > k
            whole[some] += h[found.first[short[some]] + k] * _STEPS[k]
        key = np.concatenate([key, (short.astype(np.uint64) << np.uint64(48)) | (mix(whole) >> np.uint64(16))])
    key.sort()
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    count = np.diff(np.concatenate((first, [len(key)])))
    key = key[first]
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), count


def sequence_hashes(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each text's words in order; 0 where there are none."""
    h = found.whole()
    some = np.diff(found.first) > 0
    place = (np.arange(len(h)) - found.first[:-1][found.text_of()]).astype(np.uint64)
    value = mix(h + place * _STEPS[0])
    out = []
    for part in (value, (value ^ value >> np.uint64(29)) * _STEPS[1]):
        total = np.zeros(len(some), dtype=np.uint64)
        if len(h):
            total[some] = np.add.reduceat(part, found.first[:-1][some])
        out.append(np.where(some, mix(total | np.uint64(1)) | np.uint64(1), np.uint64(0)))
    return out[0], out[1]
