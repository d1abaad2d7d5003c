"""Suffix arrays over numbered words, with vectorised binary search."""

from __future__ import annotations

import numpy as np


def suffix_array(seq: np.ndarray, depth: int) -> np.ndarray:
    """Start of every suffix of ``seq`` (non-negative numbers) that begins above 0, in order.

    0 ends a suffix. Ranks are doubled until all suffixes differ or ``depth`` numbers are
    compared, so a copied passage costs a logarithmic number of sorts.
    """
    n = len(seq)
    if not n:
        return np.empty(0, dtype=np.int64)
    rank = np.zeros(2 * n + 1, dtype=np.int64)
    _, rank[:n] = np.unique(seq, return_inverse=True)
    if seq.min() > 0:
        rank[:n] += 1
    length = 1
    order = None
    while True:
        reach = min(length, n)
        key = rank[:n] * (n + 2) + np.where(rank[:n] > 0, rank[reach : reach + n], 0)
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        steps = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        steps += 1 if sorted_key[0] > 0 else 0
        new = np.zeros_like(rank)
        new[order] = steps
        new[:n][seq == 0] = 0
        rank = new
        length *= 2
        if length >= depth or steps[-1] >= n:
            return order[seq[order] > 0]


def _compare(seq, suffixes, tests, begins, limit):
    """Numbers in common (at most ``limit``) and the sign of test minus suffix behind them."""
    common = np.zeros(len(begins), dtype=np.int64)
    sign = np.zeros(len(begins), dtype=np.int64)
    open_ = np.arange(len(begins))
    at = 0
    while len(open_):
        open_ = open_[limit[open_] > at]
        if not len(open_):
            break
        ours, theirs = begins[open_] + at, suffixes[open_] + at
        a = np.where(ours < len(tests), tests[np.minimum(ours, len(tests) - 1)], 0)
        b = np.where(theirs < len(seq), seq[np.minimum(theirs, len(seq) - 1)], 0)
        same = (a == b) & (a > 0)
        sign[open_[~same]] = np.sign(a[~same] - b[~same])
        common[open_[same]] += 1
        open_ = open_[same]
        at += 1
    return common, sign


def prefix_ranges(seq, order, tests, begins, lengths):
    """Range of ``order`` whose suffixes begin with ``tests[begin : begin + length]``."""
    bounds = []
    for past_equal in (False, True):
        low = np.zeros(len(begins), dtype=np.int64)
        high = np.full(len(begins), len(order), dtype=np.int64)
        while len(order) and np.any(low < high):
            live = np.flatnonzero(low < high)
            middle = (low[live] + high[live]) // 2
            _, sign = _compare(seq, order[middle], tests, begins[live], lengths[live])
            right = sign >= 0 if past_equal else sign > 0
            low[live] = np.where(right, middle + 1, low[live])
            high[live] = np.where(right, high[live], middle)
        bounds.append(low)
    return bounds[0], bounds[1]


def common_lengths(seq, suffixes, tests, begins, limit):
    """Length of the verbatim match of each test suffix with each given suffix."""
    return _compare(seq, suffixes, tests, begins, limit)[0]
