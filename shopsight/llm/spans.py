"""Words, windows and hashes of whole texts, computed on Arrow buffers without Python strings.

A text is its UTF-8 bytes; a word is a run of bytes other than space and \\t \\n \\v \\f \\r (these
bytes never occur inside a longer code point). Texts are worked off in slices of a few megabytes,
so memory follows the slice, or the longest single text if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)  # odd, hence invertible modulo 2**64
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (splitmix64 finaliser)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _BASE)


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 1024), base, dtype=_U)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= 4 * SLICE_BYTES:
            _powers[name] = have
    return have[:n]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch of about `limit` text bytes: the rows, their bytes, the n + 1 offsets. A null text is empty."""
    if not batch.num_rows:
        return
    texts = batch.column(batch.schema.get_field_index(column))
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    binary = texts.cast(pa.large_string()).cast(pa.large_binary())
    _, offsets, data = binary.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[binary.offset : binary.offset + len(binary) + 1]
    every = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(ends, ends[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        part = ends[first : last + 1]
        yield batch.slice(first, last - first), every[part[0] : part[-1]], part - part[0]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and number of the text of every word, in order."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inner = (data != 32) & ((data < 9) | (data > 13))
    begins = inner.copy()
    begins[1:] &= ~inner[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = inner[heads]
    ends = inner.copy()
    ends[:-1] &= ~inner[1:]
    ends[heads[1:] - 1] = inner[heads[1:] - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(offsets, starts, side="right") - 1


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums, from which `span_hash` takes the hash of any span."""
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_BYTE[data] * _power(_BASE, "up", len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes in each span; equal bytes have equal hashes wherever they stand."""
    down = _power(_INVERSE, "down", len(sums))
    return mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(_U))


def every_hash(sums: np.ndarray, width: int) -> np.ndarray:
    """`span_hash` of every run of `width` bytes, in order."""
    n = len(sums) - width
    if n <= 0:
        return np.zeros(0, _U)
    return mix((sums[width:] - sums[:-width]) * _power(_INVERSE, "down", len(sums))[:n] + _U(width))


def repeated(values: np.ndarray) -> np.ndarray:
    """Places, ascending, of all values that come more than once."""
    order = np.argsort(values)
    ranked = values[order]
    same = ranked[1:] == ranked[:-1]
    often = np.zeros(len(values), bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    return np.flatnonzero(often)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def combine(values: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of `length` values, in order; shorter input gives none."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, _U)
    total = np.zeros(n, _U)
    factor = 1
    for i in range(length):
        factor = factor * int(_BASE) % (1 << 64)
        total += values[i : i + n] * _U(factor)
    return mix(total + _U(length))


def window_texts(texts: np.ndarray, length: int) -> np.ndarray:
    """For every run of `length` words: whether it lies in one text."""
    n = len(texts) - length + 1
    return texts[:n] == texts[length - 1 :] if n > 0 else np.zeros(0, bool)


def per_text(texts: np.ndarray, n_texts: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Count, or sum of integer weights, of the entries of every text."""
    if weights is None:
        return np.bincount(texts, minlength=n_texts).astype(np.int64)
    edges = np.searchsorted(texts, np.arange(n_texts + 1))
    sums = np.concatenate([[0], np.cumsum(weights, dtype=np.int64)])
    return sums[edges[1:]] - sums[edges[:-1]]


def covered(flags: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n positions lie in a flagged window of `length` positions."""
    begun = np.zeros(n, np.int32)
    begun[: len(flags)] = flags[:n]
    np.cumsum(begun, out=begun)
    found = begun > 0
    found[length:] = begun[length:] > begun[:-length]
    return found


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest value (upper 32 bits; the last of equals) in every run of `width` values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = _U(0xFFFFFFFF)
    best, span = (values & ~low) | (low - np.arange(len(values), dtype=_U)), 1
    while span < width:  # minima of runs of `span` give those of up to twice that
        step = min(span, width - span)
        best = np.minimum(best[:-step], best[step:])
        span += step
    return (low - (best & low)).astype(np.int64)
