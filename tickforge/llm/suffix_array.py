"""Suffix array by two-stage sorting, and common prefixes of its neighbours.

Suffixes smaller than their successor (in the text) are sorted directly; all others are
induced from them by one scan over the buckets of first bytes, from the least up.
"""

from __future__ import annotations

import numpy as np


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """For every position whether its suffix is smaller than the one a byte later. The
    last suffix is larger than the empty one behind it; equal bytes go by their run's end."""
    n = len(text)
    out = np.zeros(n, bool)
    if n > 1:
        differs = np.flatnonzero(text[1:] != text[:-1])         # last place of each run but the final one
        run_end = np.full(n, -1)
        run_end[differs] = differs
        # The end of the run a position stands in, -1 in the final run.
        k = np.searchsorted(differs, np.arange(n))
        some = k < len(differs)
        end = differs[np.minimum(k, len(differs) - 1)] if len(differs) else np.zeros(n, np.int64)
        out[some] = text[end[some]] < text[end[some] + 1]
    return out


def suffix_array(data: bytes, depth: int = 400) -> np.ndarray:
    """Positions of all suffixes in the order of (at least) their first ``depth`` bytes."""
    text = np.frombuffer(data, np.uint8)
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    smaller = smaller_than_next(text)
    # Buckets by first byte: induced suffixes come first, then the directly sorted ones.
    induced = np.bincount(text[~smaller], minlength=256)
    sorted_by = np.bincount(text[smaller], minlength=256)
    start = np.cumsum(induced + sorted_by) - induced - sorted_by
    out = np.full(n, -1, np.int64)
    # Stage one: direct sort of the smaller ones, a bucket at a time, so that only one
    # bucket's keys are held.
    places = np.flatnonzero(smaller)
    places = places[np.argsort(text[places], kind="stable")]
    cut = np.concatenate([[0], np.cumsum(sorted_by)])
    for c in np.flatnonzero(sorted_by):
        here = places[cut[c]:cut[c + 1]]
        keys = [data[i:i + depth] for i in here.tolist()]
        at = start[c] + induced[c]
        out[at:at + len(here)] = here[sorted(range(len(keys)), key=keys.__getitem__)]
    head = start.copy()

    def induce(found: np.ndarray) -> int:
        """Put the larger predecessors of suffixes in scan order into their buckets."""
        prior = found[found > 0] - 1
        prior = prior[~smaller[prior]]
        if not len(prior):
            return 0
        first = text[prior]
        order = np.argsort(first, kind="stable")
        prior, first = prior[order], first[order]
        bucket, at, count = np.unique(first, return_index=True, return_counts=True)
        place = np.repeat(head[bucket], count) + np.arange(len(prior)) - np.repeat(at, count)
        out[place] = prior
        head[bucket] += count
        return len(prior)

    # Stage two: the last suffix stands before the rest of its bucket; then one scan.
    out[head[text[n - 1]]] = n - 1
    head[text[n - 1]] += 1
    for c in range(256):
        done = start[c]
        while done < head[c]:                 # a bucket's runs of its own byte come wave by wave
            upto = head[c]
            induce(out[done:upto])
            done = upto
        if sorted_by[c]:
            induce(out[start[c] + induced[c]:start[c] + induced[c] + sorted_by[c]])
    return out


def _compare(data: bytes, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of the suffixes at ``a`` and ``b`` up to ``cap``, eight bytes a step."""
    pad = np.frombuffer(data + b"\0" * 16, np.uint8)
    words = np.lib.stride_tricks.as_strided(pad[:8].view("<u8"), (len(pad) - 7,), (1,))
    out, live = np.full(len(a), cap, np.int64), np.arange(len(a))
    for k in range(0, cap, 8):
        x = words[a + k] ^ words[b + k]
        same = x == 0
        if not same.all():
            y = x[~same]
            low = y & (~y + np.uint64(1))                       # lowest differing bit: first byte, little-endian
            out[live[~same]] = k + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
            live, a, b = live[same], a[same], b[same]
            if not len(live):
                break
    return np.minimum(out, cap)


def common_prefixes(data: bytes, places: np.ndarray, cap: int = 400) -> np.ndarray:
    """Common prefix of each position in ``places`` with the next one, up to ``cap`` bytes.
    All positions must have ``cap`` bytes behind them. Where a position and the one
    behind it have neighbours equally far off, their prefixes differ by the one byte, so
    only the ends of such runs are compared."""
    if len(places) < 2:
        return np.zeros(0, np.int64)
    text = np.frombuffer(data, np.uint8)
    order = np.argsort(places[:-1], kind="stable")
    i, j = places[:-1][order], places[1:][order]
    run = np.zeros(len(i), bool)
    run[:-1] = (i[1:] == i[:-1] + 1) & (j[1:] == j[:-1] + 1)
    run &= text[i] == text[j]
    ends = np.flatnonzero(~run)
    end = np.searchsorted(ends, np.arange(len(i)))
    out = np.empty(len(i), np.int64)
    out[order] = np.minimum(_compare(data, i[ends], j[ends], cap)[end] + ends[end] - np.arange(len(i)), cap)
    return out
