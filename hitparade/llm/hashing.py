"""Words of whole texts and their 64-bit hashes, vectorised over a batch."""

from __future__ import annotations

import numpy as np

#: A-Z lower-cased; ASCII other than digits and letters becomes a space; other bytes belong to words.
TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS: list[np.ndarray] = []


def words_of(text: str | None) -> list[bytes]:
    """The normalised words of a text."""
    return text.encode().translate(TO_WORDS).split() if text else []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        _POWERS[:] = made
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each run (starts ascending, ends exclusive)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[1:], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def word_hashes(normal: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, words before each text)`` of texts given as space-joined words."""
    data = np.frombuffer(b" ".join(normal), np.uint8)
    counts = np.fromiter((x.count(b" ") + 1 if x else 0 for x in normal), np.int64, len(normal))
    word = np.concatenate([[False], data != 32, [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    return run_hashes(data, edge[::2], edge[1::2]), np.concatenate([[0], np.cumsum(counts)])


def shingles(normal: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, shingles before each text)``: every run of ``width`` words of each text; a text
    of fewer words, but not none, is one shingle."""
    h, at = word_hashes(normal)
    n = np.diff(at)
    made = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(made)])
    out = np.zeros(first[-1], np.uint64)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(h) >= width:
        m = len(h) - width + 1
        run = np.zeros(m, np.uint64)
        for k in range(width):
            run = run * np.uint64(_BASE) + h[k : k + m]
        text = np.repeat(np.arange(len(n)), n)
        long = n >= width
        inside = (text[:m] == text[width - 1 :]) & long[text[:m]]
        keep = np.ones(first[-1], bool)
        keep[first[short]] = False
        out[keep] = mix(run[inside])
    for i in short.tolist():
        x = 0
        for w in h[at[i] : at[i + 1]].tolist():
            x = (x * _BASE + w + 1) & 0xFFFFFFFFFFFFFFFF
        out[first[i]] = x
    return out, first
