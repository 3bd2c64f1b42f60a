"""Helpers for tasks that work on Arrow batches with numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one numpy pass works on; a longer text is a pass of its own.
PASS_BYTES = 2 << 20

#: Word separators: blank and the ASCII control characters 9 to 13.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[32, 9, 10, 11, 12, 13]] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_codes(seed: int) -> np.ndarray:
    """One pseudo-random 64-bit number for each byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64) * _ODD + np.uint64(seed))


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def range_hasher(codes: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function of (starts, ends) that hashes ``codes[start:end]`` for every range, by content only and not by place."""
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(len(codes), _ODD)[:-1], out=sums[1:])
    down = powers(len(codes), _ODD_INVERSE)
    return lambda starts, ends: mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def range_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hasher(codes)(starts, ends)


def passes(texts: pa.Array, limit: int = PASS_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of whole texts: (first row, end row, UTF-8 bytes, byte bounds of the texts).

    Nulls are empty texts.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_ranges(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each text the number of words before it (one more entry than texts)."""
    inside = ~SEPARATOR[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def group_ids(bounds: np.ndarray) -> np.ndarray:
    """0 for the entries of the first range, 1 for those of the second, and so on."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def forest_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the sets of ``a`` and ``b`` pairwise; ``labels`` holds each entry's smallest known member."""
    while True:
        x, y = labels[a], labels[b]
        if (x == y).all():
            return labels
        low = np.minimum(x, y)
        np.minimum.at(labels, x, low)
        np.minimum.at(labels, y, low)
        while (labels[labels] != labels).any():
            labels = labels[labels]


def runs(columns: list[np.ndarray]) -> np.ndarray:
    """Bounds of the runs of equal rows."""
    n = len(columns[0])
    change = np.ones(n + 1, bool)
    if n:
        change[1:n] = False
        for c in columns:
            change[1:n] |= c[1:] != c[:-1]
    else:
        change[:] = True
    return np.flatnonzero(change)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 1 << 16) -> Iterator[pa.Table]:
    """Regroup batches that are sorted by ``keys`` into tables of whole groups, at least ``rows`` rows where there are more.

    What is held is one such table plus the group at its end.
    """
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held)
        cut = int(runs([table.column(k).to_numpy() for k in keys])[-2])
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
        held, count = rest.to_batches(), rest.num_rows if cut else 0
    if held:
        yield pa.Table.from_batches(held)
