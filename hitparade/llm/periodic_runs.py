"""Periodic run detection by internal pattern matching.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal) of at least ``max(MIN_WORDS, MIN_EXPONENT * q)`` words, which no neighbouring word
extends keeping the period.

Texts are words (ASCII white space separates them), numbered exactly. Some texts at
a time are laid out one after the other, each closed by a word of its own:

1. Words are sorted into ranks of 1, 2, 4 ... words (prefix doubling), which gives the
   suffix array and, at each of its places, the length from which neighbours differ. The
   occurrences of any block of 2^k words are one interval of it.
2. A wavelet matrix over the suffix array answers range successor: the first, second and
   last occurrence of a block in a window of the text.
3. A run of period q in [L, 2L) holds an aligned (dyadic) block of L words together with the same
   words q later. So each block asks for its occurrences at the distances [L, 2L). Blocks of 8
   words ask for [1, 8] and [9, 15], as runs of smaller periods are long enough for them.
4. In such a window three or more occurrences are an arithmetic progression whose
   difference p is the block's own period. A run around them has period p, or the
   distance of corresponding ends of the p-periodic stretches around the block and
   around its occurrences. Fewer occurrences are candidates themselves.
5. A candidate (block, distance d) is extended to both sides while words d apart agree (hashes
   of prefixes, binary search); the found stretch is then compared word by word. The
   least period found for a stretch is its smallest period, because that period is found too.

Texts in which no 16 words occur twice hold no run and go no further than that test.

Rows: a null, empty or white-space text has no words and no runs, its collapsed text is
empty. Texts are whole whatever their length; a text longer than a slice is a slice of
its own. Repeated rows give repeated results; an empty table gives an empty one. An
input column with the name of an output column is replaced by it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hitparade.llm.arrow import slices
from hitparade.llm.hashing import mix

MIN_WORDS, MIN_EXPONENT = 24, 3
#: Words of the shortest block that is looked up; runs of smaller periods are three such blocks long.
BASE = 8
#: Words that occur twice in every text with a run.
_REPEATED = MIN_WORDS - BASE

_ODD = 0x9E3779B97F4A7C15


def words_of(text: str | None) -> list[bytes]:
    """The words of a text; ``bytes.split`` separates at ASCII white space only."""
    return text.encode().split() if text else []


class WaveletMatrix:
    """Order statistics of any interval of an array of distinct numbers below ``2 ** bits``."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.levels = []
        v = values.astype(np.int64)
        for b in range(self.bits - 1, -1, -1):
            one = ((v >> b) & 1).astype(bool)
            packed = np.packbits(one, bitorder="little")
            words = np.zeros(len(v) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
            self.levels.append((words, before, int(len(v) - one.sum())))
            v = np.concatenate([v[~one], v[one]])

    @staticmethod
    def _ones(level, at: np.ndarray) -> np.ndarray:
        words, before, _ = level
        cell = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[cell] + np.bitwise_count(words[cell] & mask).astype(np.int64)

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many numbers of places ``lo`` to ``hi`` are less than ``x``."""
        total = np.zeros(len(lo), np.int64)
        over = x >> self.bits > 0
        whole = hi - lo
        for k, level in enumerate(self.levels):
            one = ((x >> (self.bits - 1 - k)) & 1).astype(bool)
            a, b = self._ones(level, lo), self._ones(level, hi)
            total += np.where(one, (hi - b) - (lo - a), 0)
            lo, hi = np.where(one, level[2] + a, lo - a), np.where(one, level[2] + b, hi - b)
        return np.where(over, whole, total)

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The ``k``-th least number (from 0) of places ``lo`` to ``hi``."""
        out = np.zeros(len(lo), np.int64)
        for level in self.levels:
            a, b = self._ones(level, lo), self._ones(level, hi)
            zeros = (hi - b) - (lo - a)
            one = k >= zeros
            k = np.where(one, k - zeros, k)
            out = out * 2 + one
            lo, hi = np.where(one, level[2] + a, lo - a), np.where(one, level[2] + b, hi - b)
        return out


def suffix_array(ids: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """``(suffixes in order, round in which each place parted from the one before)``: suffixes equal
    in their first 2^k words share an interval without a place of round k or less inside;
    told apart up to at least ``longest`` words."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    parted = np.full(n, 127, np.int8)
    w = ids[order]
    fresh = np.ones(n, bool)
    fresh[1:] = w[1:] != w[:-1]
    parted[fresh] = 0
    place = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, place, 0))
    step, half = 1, 1
    while half < longest:
        last = np.append(fresh[1:], True)
        open_ = np.flatnonzero(~(fresh & last))
        if not len(open_):
            break
        at = order[open_]
        follow = np.where(at + half < n, rank[np.minimum(at + half, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + follow
        by = np.argsort(key, kind="stable")
        order[open_] = at[by]
        key = key[by]
        new = np.ones(len(open_), bool)
        new[1:] = key[1:] != key[:-1]
        parted[open_[new & ~fresh[open_]]] = step
        fresh[open_[new]] = True
        starts = np.maximum.accumulate(np.where(new, open_, 0))
        rank[order[open_]] = starts
        step, half = step + 1, half * 2
    return order, parted


class Layout:
    """The words of some texts in one array, a word of its own after each text."""

    def __init__(self, texts: list[list[bytes]]):
        vocab: dict[bytes, int] = {}
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.first = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.ids = np.empty(self.first[-1], np.int64)
        for i, words in enumerate(texts):
            a = self.first[i]
            self.ids[a : a + len(words)] = [vocab.setdefault(w, len(vocab)) for w in words]
            self.ids[a + len(words)] = -1 - i
        self.sizes = sizes
        h = mix(self.ids.astype(np.uint64)) | np.uint64(1)
        powers = np.full(len(h) + 1, _ODD, np.uint64)
        powers[0] = 1
        self.powers = np.multiply.accumulate(powers)
        self.sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * self.powers[:-1], out=self.sums[1:])

    def _same(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether ``n`` words from ``i`` and from ``j`` (later) hash alike."""
        return (self.sums[i + n] - self.sums[i]) * self.powers[j - i] == self.sums[j + n] - self.sums[j]

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i`` on and from ``j`` on agree (``i`` before ``j``)."""
        return self._longest(lambda n: self._same(i, j, n), len(self.ids) - j)

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before ``i`` and before ``j`` agree (``i`` before ``j``)."""
        return self._longest(lambda n: self._same(i - n, j - n, n), i.copy())

    @staticmethod
    def _longest(same: Callable[[np.ndarray], np.ndarray], limit: np.ndarray) -> np.ndarray:
        got = np.zeros(len(limit), np.int64)
        if not len(limit):
            return got
        for b in range(int(limit.max()).bit_length() - 1, -1, -1):
            more = got + (1 << b)
            fits = more <= limit
            ok = fits & same(np.where(fits, more, got))
            got = np.where(ok, more, got)
        return got

    def suspects(self) -> np.ndarray:
        """The texts in which some ``_REPEATED`` words occur twice."""
        n = len(self.ids) - _REPEATED + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        text = np.repeat(np.arange(len(self.sizes)), self.sizes + 1)
        inside = text[:n] == text[_REPEATED - 1 :]
        inside &= self.ids[_REPEATED - 1 :] >= 0
        at = np.flatnonzero(inside)
        h = self._grams(at)
        order = np.lexsort((h, text[at]))
        h, t = h[order], text[at][order]
        again = (h[1:] == h[:-1]) & (t[1:] == t[:-1])
        return np.unique(t[1:][again])

    def _grams(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the ``_REPEATED`` words from each place."""
        h = mix(self.ids.astype(np.uint64))
        run = h
        width = 1
        while width < _REPEATED:  # a power of two
            run = mix(run[:-width] * np.uint64(3) + run[width:])
            width *= 2
        return run[at]


def _candidates(lay: Layout) -> tuple[np.ndarray, np.ndarray]:
    """``(place of a block, distance)`` of possible runs."""
    ids, n = lay.ids, len(lay.ids)
    longest = int(lay.sizes.max(initial=0)) // MIN_EXPONENT
    order, parted = suffix_array(ids, max(longest, BASE))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    tree = WaveletMatrix(order)
    text = np.repeat(np.arange(len(lay.sizes)), lay.sizes + 1)
    blocks, distances = [], []
    k = BASE.bit_length() - 1
    while (1 << k) <= max(longest, BASE):
        size = 1 << k
        # blocks aligned within their text, and whole in it
        at = np.arange(n) - lay.first[text]
        at = np.flatnonzero((at % size == 0) & (at + size <= lay.sizes[text]))
        edges = np.append(np.flatnonzero(parted <= k), n)
        part = np.searchsorted(edges, place[at], side="right")
        lo, hi = edges[part - 1], edges[part]
        several = hi - lo > 1
        at, lo, hi = at[several], lo[several], hi[several]
        windows = [(1, size + 1), (size + 1, 2 * size)] if size == BASE else [(size, 2 * size)]
        for begin, end in windows:
            low = tree.below(lo, hi, at + begin)
            count = tree.below(lo, hi, np.minimum(at + end, n)) - low
            here = np.flatnonzero(count > 0)
            if not len(here):
                continue
            a, l, h, c, less = at[here], lo[here], hi[here], count[here], low[here]
            one = tree.smallest(l, h, less) - a
            blocks.append(a)
            distances.append(one)
            two = np.flatnonzero(c > 1)
            if not len(two):
                continue
            a, l, h, c, less, one = a[two], l[two], h[two], c[two], less[two], one[two]
            second = tree.smallest(l, h, less + 1) - a
            blocks.append(a)
            distances.append(second)
            more = np.flatnonzero(c > 2)
            if len(more):
                a, one, second = a[more], one[more], second[more]
                last = tree.smallest(l[more], h[more], less[more] + c[more] - 1) - a
                p = second - one
                there = a + one
                left = lay.behind(there, there + p) - lay.behind(a, a + p)
                right = lay.ahead(there, there + p) - lay.ahead(a, a + p)
                for d in (one - left, one + right):
                    good = (d >= one) & (d <= last)
                    blocks.append(a[good])
                    distances.append(d[good])
        k += 1
    if not blocks:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.unique(np.stack([np.concatenate(blocks), np.concatenate(distances)], axis=1), axis=0)
    return both[:, 0], both[:, 1]


def _extend_exactly(ids: np.ndarray, at: int, d: int) -> tuple[int, int]:
    """The stretch around ``at`` in which words ``d`` apart are equal, word by word."""
    a, b = at, at
    while b + d < len(ids) and ids[b] == ids[b + d]:
        b += 1
    while a and ids[a - 1] == ids[a - 1 + d]:
        a -= 1
    return a, b + d


def find_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs ``(start, length, period)`` of each text, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    lay = Layout(texts)
    suspects = lay.suspects()
    if not len(suspects):
        return out
    lay = Layout([texts[i] for i in suspects])
    at, d = _candidates(lay)
    start = at - lay.behind(at, at + d)
    end = at + lay.ahead(at, at + d) + d
    length = end - start
    good = length >= np.maximum(MIN_WORDS, MIN_EXPONENT * d)
    if not good.any():
        return out
    at = at[good]
    found = np.stack([start[good], end[good], d[good]], axis=1)
    # the least period of a stretch; a block of each stretch stays for the exact comparison
    order = np.lexsort((found[:, 2], found[:, 1], found[:, 0]))
    found, at = found[order], at[order]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    exact = set()
    for (a, b, q), block in zip(found[first].tolist(), at[first].tolist(), strict=True):
        ends_ok = (a == 0 or lay.ids[a - 1] != lay.ids[a - 1 + q]) and (b == len(lay.ids) or lay.ids[b] != lay.ids[b - q])
        if not (ends_ok and np.array_equal(lay.ids[a : b - q], lay.ids[a + q : b])):
            a, b = _extend_exactly(lay.ids, block, q)  # two different stretches hashed alike
        if b - a >= max(MIN_WORDS, MIN_EXPONENT * q):
            exact.add((a, q, b))
    for a, q, b in sorted(exact):
        i = int(np.searchsorted(lay.first, a, side="right")) - 1
        out[suspects[i]].append((a - int(lay.first[i]), b - a, q))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(step[:-1]) == 0)
    return [words[i] for i in kept.tolist()]


_RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(_RUN)),
    T.StructField("collapsed", T.StringType()),
]
_RUN_TYPE = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def find(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    edit: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """``docs`` without the text, with ``n_words``, ``runs`` (start, length, period by start, then period)
    and ``collapsed`` (the words outside the repeats of runs, space-joined). ``edit(id, words)``, if
    given, says which words are looked at. One Arrow pass, no shuffle."""
    new = [f.name for f in FIELDS]
    names = [c for c in docs.columns if c not in new and c != text_col]
    base = docs.select(*names, text_col)
    out = T.StructType([*(docs.schema[c] for c in names), *FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                words = [words_of(t) for t in part.column(text_col).to_pylist()]
                if edit is not None:
                    words = [edit(i, w) for i, w in zip(part.column(id_col).to_pylist(), words, strict=True)]
                runs = find_runs(words)
                made = [
                    pa.array(list(map(len, words)), pa.int64()),
                    pa.array([[{"start": s, "length": n, "period": q} for s, n, q in rs] for rs in runs], _RUN_TYPE),
                    pa.array([b" ".join(collapse(w, rs)) for w, rs in zip(words, runs, strict=True)], pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *made], names=[*names, *new])

    return base.mapInArrow(run, out)
