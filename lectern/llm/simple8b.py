"""Simple-8b word-aligned coding of token ids, in numpy over whole packs.

A 64-bit word is a 4-bit selector and 60 bits that hold ``COUNT[s]`` ids of ``BITS[s]`` bits,
lowest first.  A list is cut into blocks of 256 ids that start on a word of their own; the
word offset of each block is stored, so blocks decode independently and all at once.  Only
the last word of a block may be part-filled.  Selector 15 is the escape: its word holds the
number of the block's escaped id, whose 64 bits follow the block words (ids of 2^60 and more).
"""

from __future__ import annotations

import numpy as np

#: selectors 1 to 14
COUNT = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1], np.int64)
BITS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60], np.int64)
ESCAPE = 15
BLOCK = 256
_U = np.uint64


_SMALL = np.maximum(np.frexp(np.arange(1 << 16, dtype=np.float64))[1], 1).astype(np.uint8)


def _widths(v: np.ndarray) -> np.ndarray:
    """Bits of each value, 1 at least."""
    if v.max() < len(_SMALL):
        return _SMALL[v.astype(np.int64)]
    high = v >> _U(32)
    w = np.frexp(v.astype(np.float64) if not high.any() else (v & _U(0xFFFFFFFF)).astype(np.float64))[1].astype(np.uint8)
    over = np.flatnonzero(high)
    w[over] = 32 + np.frexp(high[over].astype(np.float64))[1].astype(np.uint8)
    return np.maximum(w, 1, out=w)


def encode(ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lists ids[off[i]:off[i+1]] -> (words, word offsets of lists, block starts within the
    list's words, block offsets of lists, escaped values as (list, value) rows)."""
    v = ids.astype(np.uint64)
    n_list = np.diff(off)
    n_block = -(-n_list // BLOCK)
    blocks = int(n_block.sum())
    which = np.repeat(np.arange(len(n_list)), n_block)
    nth = np.arange(blocks) - np.repeat(np.cumsum(n_block) - n_block, n_block)
    start = off[:-1][which] + nth * BLOCK
    end = np.minimum(start + BLOCK, off[1:][which])
    big = v >= _U(1 << 60)
    escapes = np.flatnonzero(big)
    lists_of = np.searchsorted(off, escapes, "right") - 1 if len(escapes) else np.zeros(0, np.int64)
    order = np.arange(len(escapes)) - np.searchsorted(lists_of, lists_of)
    kept = v[escapes]
    if len(escapes):
        v = v.copy()
        v[escapes] = order.astype(np.uint64)
    n = len(v)
    if not n:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64), z, np.zeros(len(off), np.int64), np.zeros((0, 2), np.uint64)
    width = _widths(v)
    width[escapes] = 61
    # one row per block, width 0 behind its last id: a part-filled word fits like a full one
    cell = np.arange(n) + np.repeat(np.arange(blocks) * BLOCK - start, end - start)
    grid = np.zeros((blocks, BLOCK), np.uint8)
    grid.reshape(-1)[cell] = width
    best = np.full((blocks, BLOCK), ESCAPE, np.uint8)
    window = grid.copy()  # widest of the next ``reach`` ids
    reach = 1
    for s in range(14, 0, -1):
        while reach < COUNT[s]:
            step = min(reach, int(COUNT[s]) - reach)
            np.maximum(window[:, :-step], window[:, step:], out=window[:, :-step])
            reach += step
        fits = (window > np.uint8(BITS[s])).view(np.uint8)  # 0 where it fits
        fits *= np.uint8(ESCAPE)
        fits |= np.uint8(s)
        np.minimum(best, fits, out=best)  # a later selector packs more ids
    # every block takes its next word in each round
    size = end - start
    row, col = np.arange(blocks), np.zeros(blocks, np.int64)
    starts = np.zeros((blocks, BLOCK), bool)
    while len(row):
        starts[row, col] = True
        col = col + COUNT[best[row, col]]
        on = col < size[row]
        row, col = row[on], col[on]
    at = np.flatnonzero(starts)  # words in order
    b, sel = at // BLOCK, best.reshape(-1)[at].astype(np.int64)
    m = np.minimum(COUNT[sel], size[b] - at % BLOCK)
    i = start[b] + at % BLOCK
    slot = np.arange(n) - np.repeat(i, m)
    shifted = v << (slot * np.repeat(BITS[sel], m)).astype(np.uint64)
    words = np.bitwise_or.reduceat(shifted, i) | (sel.astype(np.uint64) << _U(60))
    per_block = np.bincount(b, minlength=blocks)
    block_at = np.cumsum(per_block) - per_block
    bo = np.zeros(len(off), np.int64)
    np.cumsum(n_block, out=bo[1:])
    wo = np.append(block_at, len(words))[bo]
    return words, wo, block_at - wo[:-1][which], bo, np.stack([lists_of.astype(np.uint64), kept], 1)


def decode(words: np.ndarray, wo: np.ndarray, block_at: np.ndarray, bo: np.ndarray, counts: np.ndarray,
           escapes: np.ndarray) -> np.ndarray:
    """Ids of all lists, one after another; the inverse of :func:`encode` (counts: ids per list)."""
    if not len(words):
        return np.zeros(0, np.uint64)
    n_block = np.diff(bo)
    which = np.repeat(np.arange(len(counts)), n_block)
    nth = np.arange(len(which)) - np.repeat(bo[:-1], n_block)
    size = np.minimum(BLOCK, counts[which] - nth * BLOCK)
    first = block_at + wo[:-1][which]
    sel = (words >> _U(60)).astype(np.int64)
    m = COUNT[sel]
    last = np.append(first[1:], len(words)) - 1
    run = np.cumsum(m)
    m[last] -= run[last] - np.where(first > 0, run[first - 1], 0) - size
    total = int(m.sum())
    starts = np.cumsum(m) - m
    slot = np.arange(total) - np.repeat(starts, m)
    bits = BITS[sel].astype(np.uint64)
    out = np.repeat(words, m) >> (slot.astype(np.uint64) * np.repeat(bits, m))
    out &= np.repeat((_U(1) << bits) - _U(1), m)
    esc = np.flatnonzero(np.repeat(sel == ESCAPE, m))
    if len(esc):
        list_of = np.searchsorted(np.cumsum(counts), esc, "right").astype(np.uint64)
        base = np.searchsorted(escapes[:, 0], list_of)
        out[esc] = escapes[:, 1][base + out[esc].astype(np.int64)]
    return out
