"""Words of many texts at once: positions, hashes and shingle hashes as numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# The bytes that separate words, [\x20\x09-\x0D].
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# The ASCII punctuation that separates words where only letters and digits count.
_PUNCTUATION = _SPACE.copy()
_PUNCTUATION[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 19


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit values (the finishing step of splitmix64)."""
    h = (h + np.uint64((seed * 0x632BE59BD9B4E019 + 0x1234567) & (2**64 - 1))).astype(np.uint64, copy=False)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each ``buf[start:end]``; spans ascend by start.

    Prefix sums are kept for one block of the buffer at a time, so memory does
    not grow with the length of a text.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(starts, lo + _BLOCK)))
        hi = int(ends[i:j].max(initial=lo))
        p = powers(hi - lo + 1)
        prefix = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum((buf[lo:hi].astype(np.uint64) + np.uint64(1)) * p[: hi - lo], out=prefix[1:])
        back = powers(int(starts[j - 1]) - lo + 1, _BASE_INVERSE)
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((prefix[e] - prefix[s]) * back[s] + (e - s).astype(np.uint64))
        i = j
    return out


@dataclass
class Words:
    """The words of a run of texts; ``doc`` is the index of the text in the run, ascending."""

    buf: np.ndarray
    base: np.ndarray  # first byte of each text in buf, and one past the last separator
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.base) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.starts, self.ends)

    def shingles(self, k: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``(hash of the k words from i on, i)`` for each i whose k words lie in one text."""
        h = self.hashes() if hashes is None else hashes
        if len(h) < k:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        n = len(h) - k + 1
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1:])
        out = h[at]
        for d in range(1, k):
            out = out * np.uint64(0xD6E8FEB86659FD93) + h[at + d]
        return mix(out), at


def split(texts: list[bytes], lower: bool = False, punctuation: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text.

    ``lower`` lower-cases A-Z first, ``punctuation`` lets ASCII punctuation separate words too.
    """
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    if lower:
        buf = _LOWER[buf]
    base = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=base[1:])
    inside = ~(_PUNCTUATION if punctuation else _SPACE)[buf]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    starts, ends = edge[0::2], edge[1::2]
    doc = np.searchsorted(base, starts, side="right") - 1
    return Words(buf, base, starts, ends, doc)


def code_points_before(buf: np.ndarray) -> np.ndarray:
    """Number of code points that begin before each byte, and in all."""
    out = np.zeros(len(buf) + 1, dtype=np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=out[1:])
    return out
