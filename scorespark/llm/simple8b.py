"""Simple-8b: runs of ids in 64-bit words, the four high bits of a word telling how many bits each id has.

Selector s of 1 to 14 packs COUNTS[s - 1] ids of WIDTHS[s - 1] bits into the 60
low bits, the first id lowest; unused places are zero.  Selector 0 packs up to
240 zeros.  Selector 15 is an escape: the id is the whole next word.  Every word
is made from the ids that are left, longest run first, so a decoder needs the
number of ids only to cut the last word's padding.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the format.
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
ZEROS = 240
ESCAPE = 15


def _widths(ids: np.ndarray) -> np.ndarray:
    """Index into WIDTHS of the narrowest width that holds each id; 14 for an escape."""
    limits = np.array([1 << w for w in WIDTHS], np.uint64)
    return np.searchsorted(limits, ids, side="right")


def pack(ids: np.ndarray) -> np.ndarray:
    """64-bit words for unsigned 64-bit ``ids``.

    How far each selector would reach from every place is found for all places
    at once; only the walk from word to word is a loop, one step per word.
    """
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64)
    need = _widths(ids).astype(np.int8)
    best = np.full(n, ESCAPE, np.int8)
    taken = np.ones(n, np.int16)
    # Places beyond the end need no bits: the last word may have empty places.
    wide = np.zeros(n + ZEROS + 1, np.int32)
    left = np.minimum(n - np.arange(n), ZEROS).astype(np.int16)
    for s in range(len(WIDTHS) - 1, -1, -1):
        np.cumsum(need > s, out=wide[1 : n + 1])
        wide[n + 1 :] = wide[n]
        fits = wide[COUNTS[s] : COUNTS[s] + n] == wide[:n]
        if not fits.any():
            break  # a narrower width asks more of the same ids
        np.copyto(best, s + 1, where=fits)
        np.copyto(taken, COUNTS[s], where=fits)
    np.minimum(taken, left, out=taken)
    if not ids.all():
        np.cumsum(ids != 0, out=wide[1 : n + 1])
        wide[n + 1 :] = wide[n]
        zeros = np.minimum(left, ZEROS)
        only = (wide[ZEROS : ZEROS + n] == wide[:n]) & (zeros > taken)
        best[only], taken[only] = 0, zeros[only]
    starts, at, step = [], 0, taken.tolist()
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts)
    selector, count = best[starts].astype(np.int64), taken[starts]
    place = np.arange(len(starts)) + np.concatenate([[0], np.cumsum(selector == ESCAPE)[:-1]])
    words = np.zeros(len(starts) + int((selector == ESCAPE).sum()), np.uint64)
    words[place] = selector.astype(np.uint64) << np.uint64(60)
    escaped = selector == ESCAPE
    words[place[escaped] + 1] = ids[starts[escaped]]
    for s, width in enumerate(WIDTHS):
        of = np.flatnonzero(selector == s + 1)
        for k in range(COUNTS[s] if len(of) else 0):
            some = of[count[of] > k]
            words[place[some]] |= ids[starts[some] + k] << np.uint64(k * width)
    return words


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids that :func:`pack` wrote, all words of one selector at a time."""
    words = np.ascontiguousarray(words, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    if (selector == ESCAPE).any():
        # The word after an escape is an id; of adjoining candidates every second one is.
        payload = np.zeros(len(words), bool)
        at = 0
        for e in np.flatnonzero(selector == ESCAPE).tolist():
            if e >= at:
                payload[e + 1] = True
                at = e + 2
        heads = np.flatnonzero(~payload)
    else:
        heads = np.arange(len(words))
    selector = selector[heads]
    counts = np.array([ZEROS, *COUNTS, 1])[selector]
    starts = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(int(starts[-1]), np.uint64)
    for s, width in enumerate(WIDTHS):
        of = np.flatnonzero(selector == s + 1)
        if len(of):
            shifts = np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(width)
            values = (words[heads[of]][:, None] >> shifts) & np.uint64((1 << width) - 1)
            out[starts[of][:, None] + np.arange(COUNTS[s])] = values
    of = np.flatnonzero(selector == ESCAPE)
    out[starts[of]] = words[heads[of] + 1]
    return out[:n]
