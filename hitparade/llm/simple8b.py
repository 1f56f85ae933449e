"""Simple-8b: word-aligned packing of unsigned integers, vectorised with numpy.

A 64-bit word holds a 4-bit selector (top bits) and a 60-bit payload of equally
wide values, lowest bits first. Selector 0 is the escape: its payload is an
index into the block's list of values of 2**60 and more. A block is packed on
its own; zeros pad its last word, and its value count says where it ends.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the coding: values in a word and bits of a value, by selector.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

_LIMIT = np.array([1 << int(b) for b in BITS[1:]], np.uint64)  # values a selector (from 1) can't hold
_PAD = int(COUNTS.max())
_NEED = (np.searchsorted(_LIMIT, np.arange(1 << 16, dtype=np.uint64), side="right") + 1).astype(np.uint8)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(words, escaped values)`` of one block of unsigned integers."""
    v = np.asarray(values, np.uint64)
    n = len(v)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    # the narrowest selector that holds a value: 1..15, or 16 for an escape
    need = np.ones(n + _PAD, np.uint8)
    need[:n] = _NEED[v] if v.max() < len(_NEED) else np.searchsorted(_LIMIT, v, side="right") + 1
    # top: the largest need among the values that a selector would take; denser
    # selectors take more values of less width, so where one fits, all before it do
    widest = {1: need}
    fits = np.zeros(n, np.uint8)
    for s in range(15, 0, -1):
        c = int(COUNTS[s])
        k = 1 << (c.bit_length() - 1)
        while k not in widest:
            half = max(widest)
            nxt = widest[half].copy()
            np.maximum(nxt[:-half], nxt[half:].copy(), out=nxt[:-half])
            widest[2 * half] = nxt
        fit = np.maximum(widest[k][:n], widest[k][c - k : c - k + n]) <= s
        if not fit.any():
            break
        fits += fit
    select = np.where(fits, 16 - fits, 0).astype(np.uint8)
    jump = COUNTS[select].tolist()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i += jump[i]
    at = np.array(starts)
    sel = select[at]
    words = sel.astype(np.uint64) << np.uint64(60)
    padded = np.zeros(n + _PAD, np.uint64)
    padded[:n] = v
    escaped = padded[at[sel == 0]]
    words[sel == 0] |= np.arange(len(escaped), dtype=np.uint64)
    for s in range(2, 16):
        mine = np.flatnonzero(sel == s)
        if len(mine):
            c, b = int(COUNTS[s]), int(BITS[s])
            part = padded[at[mine][:, None] + np.arange(c)] << (np.arange(c) * b).astype(np.uint64)
            words[mine] |= np.bitwise_or.reduce(part, axis=1)
    return words, escaped


def unpack(words: np.ndarray, escaped: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of a block."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(COUNTS[sel])
    starts = ends - COUNTS[sel]
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    payload = words & np.uint64((1 << 60) - 1)
    mine = np.flatnonzero(sel == 0)
    if len(mine):
        out[starts[mine]] = escaped[payload[mine].astype(np.int64)]
    for s in range(2, 16):
        mine = np.flatnonzero(sel == s)
        if len(mine):
            c, b = int(COUNTS[s]), int(BITS[s])
            shift, mask = (np.arange(c) * b).astype(np.uint64), np.uint64((1 << b) - 1)
            out[starts[mine][:, None] + np.arange(c)] = (payload[mine][:, None] >> shift) & mask
    return out[:n]
