"""Suffix arrays by induced sorting, and permuted common prefixes, as array operations on one shard of text.

The order of all suffixes follows from that of the leftmost-smaller ones (a smaller-than-next suffix after a
larger-than-next one). Their substrings are sorted and named; while names repeat, the string of names, at most half
as long, is sorted the same way, recursively. Bytes are induced by one scan over the buckets in each direction,
all suffixes of a bucket at once; names, whose alphabet is as large as the text, by the characters up to the next
leftmost-smaller suffix and that one's rank.
"""

from __future__ import annotations

import numpy as np


def _smaller_than_next(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it; the end of the text is smaller than all."""
    ends = np.flatnonzero(np.concatenate([t[1:] != t[:-1], [True]]))
    up = np.zeros(len(ends), bool)
    up[:-1] = t[ends[:-1]] < t[ends[:-1] + 1]
    return np.repeat(up, np.diff(np.concatenate([[-1], ends])))


def _ranks(typed: np.ndarray, bits: int, starts: np.ndarray, lengths: np.ndarray, tail: np.ndarray | None = None) -> np.ndarray:
    """Rank (number of smaller ones) of the sequences typed[start : start + length], ties broken by `tail`."""
    per = 63 // bits
    n = len(typed)
    padded = np.concatenate([typed, np.zeros(per, typed.dtype)]).astype(np.uint64)
    packed = np.zeros(n + 1, np.uint64)  # the next `per` characters at every place
    for q in range(per):
        packed[:n] = (packed[:n] << np.uint64(bits)) | padded[q : q + n]
    kept = np.array([((1 << bits * k) - 1) << bits * (per - k) for k in range(per + 1)], np.uint64)

    def column(rows: np.ndarray, j: int) -> np.ndarray:
        at = np.minimum(starts[rows] + j * per, n)
        return packed[at] & kept[np.clip(lengths[rows] - j * per, 0, per)]

    rank = np.zeros(len(starts), np.int64)
    rows, j = np.arange(len(starts)), 0

    def split(rows: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Refine the ranks of tied rows by a key; the rows that are still tied."""
        order = np.argsort(key)
        old = rank[rows]
        if len(rows) and old.min() != old.max():  # ranks and numbered keys in one number
            numbered = np.empty(len(rows), np.int64)
            ranked = key[order]
            numbered[order] = np.cumsum(np.concatenate([[False], ranked[1:] != ranked[:-1]]))
            order = np.argsort(old * len(rows) + numbered)
        rows, key, old = rows[order], key[order], old[order]
        new_old = np.concatenate([[True], old[1:] != old[:-1]])
        new = new_old | np.concatenate([[True], key[1:] != key[:-1]])
        index = np.arange(len(rows))
        rank[rows] = old + np.maximum.accumulate(np.where(new, index, 0)) - np.maximum.accumulate(np.where(new_old, index, 0))
        alone = new & np.concatenate([new[1:], [True]])
        return rows[~alone]

    ended = []
    while len(rows):
        rows = split(rows, column(rows, j))
        j += 1
        if not len(rows) or not (lengths[rows] > j * per).any():
            ended.append(rows)
            break
        going = lengths[rows] >= j * per
        ended.append(rows[~going])
        rows = rows[going]
    left = np.concatenate(ended) if ended else rows
    if tail is not None and len(left):
        split(left, tail[left])
    return rank


def _inverse(rank: np.ndarray) -> np.ndarray:
    """The entries in the order of their ranks, which are all different."""
    order = np.empty(len(rank), np.int64)
    order[rank] = np.arange(len(rank))
    return order


def _induced_bytes(t: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Suffix array of bytes, given their sorted leftmost-smaller suffixes."""
    heads = t[lms]
    edges = np.searchsorted(heads, np.arange(257))

    def deal(found: list[list[np.ndarray]], before: np.ndarray) -> None:
        chars = t[before]
        order = np.argsort(chars, kind="stable")
        chars, before = chars[order], before[order]
        cuts = np.flatnonzero(chars[1:] != chars[:-1]) + 1
        for part in np.split(before, cuts):
            if len(part):
                found[int(t[part[0]])].append(part)

    large: list[list[np.ndarray]] = [[] for _ in range(256)]
    larger_sorted: list[np.ndarray] = []
    large[int(t[-1])].append(np.array([len(t) - 1]))
    none = np.zeros(0, np.int64)
    for c in range(256):
        wave = np.concatenate(large[c]) if large[c] else none
        waves = [wave]
        while len(wave):  # runs of one character: each wave is one step further to the left
            before = wave[wave > 0] - 1
            wave = before[t[before] == c]
            waves.append(wave)
        own = np.concatenate(waves)
        larger_sorted.append(own)
        scan = np.concatenate([own, lms[edges[c] : edges[c + 1]]])
        before = scan[scan > 0] - 1
        deal(large, before[t[before] > c])
    smaller: list[list[np.ndarray]] = [[] for _ in range(256)]
    smaller_sorted: list[np.ndarray] = [none] * 256
    for c in range(255, -1, -1):
        wave = np.concatenate(smaller[c]) if smaller[c] else none
        waves = [wave]
        while len(wave):
            before = wave[wave > 0] - 1
            wave = before[t[before] == c]
            waves.append(wave)
        own = np.concatenate(waves)
        smaller_sorted[c] = own[::-1]
        scan = np.concatenate([own, larger_sorted[c][::-1]])
        before = scan[scan > 0] - 1
        deal(smaller, before[t[before] < c])
    return np.concatenate([x for pair in zip(larger_sorted, smaller_sorted) for x in pair])


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in ascending order; a suffix that is a prefix of another comes first."""
    n = len(t)
    if n < 2:
        return np.arange(n)
    small = _smaller_than_next(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    is_bytes = t.dtype == np.uint8
    bits = 10 if is_bytes else int(2 * int(t.max()) + 3).bit_length()
    typed = 2 * t.astype(np.int64) + small + 1
    if len(lms):
        rank = _ranks(typed, bits, lms, np.concatenate([lms[1:], [n - 1]]) - lms + 1)
        present = np.zeros(len(lms), bool)
        present[rank] = True
        order = _inverse(rank) if present.all() else suffix_array(np.cumsum(present)[rank] - 1)
        lms_sorted = lms[order]
    else:
        lms_sorted = lms
    if is_bytes:
        return _induced_bytes(t, small, lms_sorted)
    of_lms = np.full(n, -1, np.int64)
    of_lms[lms_sorted] = np.arange(len(lms))
    following = np.searchsorted(lms, np.arange(n), side="right")
    until = np.concatenate([lms, [n - 1]])[following]
    tail = np.where(following < len(lms), of_lms[until], -1)
    return _inverse(_ranks(typed, bits, np.arange(n), until - np.arange(n) + 1, tail))


def permuted_prefixes(t: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For every position in text order: bytes (up to `most`, or a few more) shared with the suffix before it in order.

    `sa` may hold some of the suffixes only; the others get 0."""
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([t, np.zeros(most + 16, np.uint8)])
    words = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,)).copy()
    shared = np.zeros(n, np.int64)
    rows = np.flatnonzero(before >= 0)
    for step in range(0, most, 8):
        diff = words[rows + step] ^ words[before[rows] + step]
        lowest = diff & (~diff + np.uint64(1))
        shared[rows] += np.where(diff == 0, 8, np.log2(np.maximum(lowest, np.uint64(1)).astype(np.float64)).astype(np.int64) >> 3)
        rows = rows[diff == 0]
    return np.minimum(shared, n - np.maximum(np.arange(n), before))
