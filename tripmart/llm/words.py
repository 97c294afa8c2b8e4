"""Hashes of the words of whole Arrow string columns, in numpy."""

from __future__ import annotations

import numpy as np

_P = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def string_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string array and len + 1 offsets into them; null is empty."""
    import pyarrow as pa

    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return (raw[offsets[0] : offsets[-1]] if n else raw[:0]), offsets - offsets[0] if n else np.zeros(1, np.int64)


def slices(column, most: int = 1 << 20):
    """Cuts an Arrow string array into runs of rows of about `most` bytes; a longer row stands alone."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start = 0
    while start < len(sizes):
        end = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), most, side="right")))
        yield start, end
        start = end


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = True, seed: int = 1):
    """Words are runs of bytes other than 0x20 and 0x09-0x0D; A-Z counts as a-z if `lower`.

    Returns 64-bit hashes of all words, their first and end bytes, and for each row the number of
    the first word (with one more at the end). A hash is a polynomial over random byte values.
    """
    n = len(raw)
    rows = len(offsets) - 1
    if not n:
        empty = np.empty(0, np.int64)
        return np.empty(0, np.uint64), empty, empty, np.zeros(rows + 1, np.int64)
    values = np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64)
    if lower:
        values[65:91] = values[97:123]
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    # A word ends where its row ends too
    first = ~blank
    first[1:] &= blank[:-1]
    starts_of_rows = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[starts_of_rows] = ~blank[starts_of_rows]
    last = ~blank
    last[:-1] &= blank[1:]
    ends_of_rows = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[ends_of_rows] = ~blank[ends_of_rows]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[raw] * _powers(int(_P), n), out=sums[1:])
    back = _powers(pow(int(_P), -1, 1 << 64), n)
    hashes = mix((sums[end] - sums[begin]) * back[begin])
    return hashes, begin, end, np.searchsorted(begin, offsets)


_R = 0xD6E8FEB86659FD93  # odd too


def run_sums(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a word sequence, from which `run_hashes` takes the hash of any run of words."""
    n = len(hashes)
    sums = np.zeros(n + 1, np.uint64)
    if not n:
        return sums, np.ones(1, np.uint64)
    np.cumsum(hashes * _powers(_R, n), out=sums[1:])
    return sums, _powers(pow(_R, -1, 1 << 64), n + 1)


def run_hashes(sums: tuple[np.ndarray, np.ndarray], begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs of words begin[i] to end[i]; equal runs have equal hashes wherever they stand."""
    return mix((sums[0][end] - sums[0][begin]) * sums[1][begin])
