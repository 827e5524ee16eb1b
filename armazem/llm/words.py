"""Words of many texts at once: byte positions and 64-bit hashes, as numpy arrays.

A hash is a polynomial over random 64-bit codes of the bytes, mixed at the end; it does not
depend on where the word stands. Identity by hash leaves a chance of about n^2 / 2^65 that any
two of n distinct words are taken for one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BLOCK = 1 << 18
_CODES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}

#: Bytes that separate words: blank and \t \n \v \f \r.
BLANKS = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Bytes that separate runs of letters and digits; bytes of other scripts count as letters.
MARKS = np.array([not (b >= 128 or chr(b).isalnum()) for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        steps = np.full(max(n, _BLOCK), base, np.uint64)
        steps[0] = 1
        known = _powers[int(base)] = np.multiply.accumulate(steps)
    return known[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of the texts in order: first byte, end, and the index of each text's first word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, lower: bool = False, prefixes: tuple[int, ...] = ()) -> list[np.ndarray]:
        """Hash of each word, then of its first k bytes for each k (of the word if shorter)."""
        codes = _CODES[LOWER] if lower else _CODES
        out = [np.empty(len(self), np.uint64) for _ in range(1 + len(prefixes))]
        at = 0
        while at < len(self):
            floor = self.start[at]
            upto = max(at + 1, int(np.searchsorted(self.end, floor + _BLOCK, side="right")))
            piece = codes.take(self.data[floor:self.end[upto - 1]])
            piece *= powers(_BASE, len(piece))
            sums = np.empty(len(piece) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(piece, out=sums[1:])
            begin, end = self.start[at:upto] - floor, self.end[at:upto] - floor
            back = powers(_INVERSE, len(sums))[begin]
            for k, into in enumerate(out):
                stop = end if not k else np.minimum(begin + prefixes[k - 1], end)
                into[at:upto] = mixed((sums[stop] - sums[begin]) * back)
            at = upto
        return out


def words(offsets: np.ndarray, data: np.ndarray, breaks: np.ndarray = BLANKS) -> Words:
    """Maximal runs of bytes that are no breaks, within each text."""
    n = len(data)
    inside = np.frombuffer(data.tobytes().translate((~breaks).tobytes()), bool)
    edge = np.zeros(n + 1, bool)  # a text begins or ends here
    edge[offsets] = True
    edge[0] = edge[n] = True
    opens, closes = inside.copy(), inside.copy()
    if n:
        opens[1:] &= ~inside[:-1] | edge[1:n]
        closes[:-1] &= ~inside[1:] | edge[1:n]
    start = np.flatnonzero(opens)
    return Words(data, start, np.flatnonzero(closes) + 1, np.searchsorted(start, offsets))


def windows(h: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every run of `size` words within one text."""
    counts = np.diff(first)
    fits = np.maximum(counts - size + 1, 0)
    total = int(fits.sum())
    begin = np.arange(total) + np.repeat(first[:-1] - (np.cumsum(fits) - fits), fits)
    return begin, run_hash(h, begin, size)


def run_hash(h: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words from each begin."""
    sums = np.empty(len(h) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(h * powers(_BASE, len(h)), out=sums[1:])
    return mixed((sums[begin + size] - sums[begin]) * powers(_INVERSE, len(sums))[begin])


def joined(w: Words, lower: bool, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, end): the words, or the kept ones, each followed by one blank."""
    kept = slice(None) if keep is None else keep
    begin, stop = w.start[kept], w.end[kept]
    size = stop - begin + 1
    end = np.cumsum(size)
    start = end - size
    total = int(end[-1]) if len(end) else 0
    source = np.arange(total) + np.repeat(begin - start, size)
    source[end - 1] = 0
    out = w.data[source] if total else np.zeros(0, np.uint8)
    if lower:
        out = LOWER[out]
    out[end - 1] = 32
    return out, start, end - 1
