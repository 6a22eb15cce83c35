"""Byte-level views of Arrow string columns for vectorised work inside Spark tasks.

Hashes are polynomial prefix sums modulo 2**64 over a fixed random byte table, so the hash
of any substring is one subtraction and one multiplication.  They only propose candidates;
operators verify on the texts themselves.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
# A-Z hash like a-z; every other byte stands for itself.
FOLDED_VALUE = BYTE_VALUE.copy()
FOLDED_VALUE[65:91] = BYTE_VALUE[97:123]
# White space as in the word pattern [^\x20\x09-\x0D]+.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _powers(kind: str, n: int) -> np.ndarray:
    have = _POWERS.get(kind)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, BASE if kind == "up" else BASE_INVERSE, dtype=U64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 1 << 22:
            _POWERS[kind] = have
    return have[:n]


def prefix_sums(data: np.ndarray, values: np.ndarray = BYTE_VALUE) -> np.ndarray:
    out = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(values[data] * _powers("up", len(data)), out=out[1:])
    return out


def substring_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each pair, the same wherever the bytes stand."""
    inverse = _powers("down", len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U64))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): row i of the column is bytes[offsets[i]:offsets[i + 1]]; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null(b"" if "binary" in str(column.type) else "")
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def blocks(offsets: np.ndarray, limit: int = 1 << 20):
    """Row ranges (i, j) of at most ``limit`` bytes; a longer row is a block of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word of the rows; a row's end also ends a word."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~IS_SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    start = np.flatnonzero(begins)
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, np.flatnonzero(ends) + 1, row


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct k-word shingles of each row, A-Z folded, sorted by row
    and hash.  A row with 1 to k-1 words has one shingle, the whole sequence; a row without
    words has none."""
    start, end, row = words(data, offsets)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, U64)
    word = substring_hash(prefix_sums(data, FOLDED_VALUE), start, end)
    places = mix(np.arange(1, k + 1, dtype=U64) * U64(0xA24BAED4963EE407)) | U64(1)
    count = np.bincount(row, minlength=len(offsets) - 1)
    n = len(word) - k + 1
    rows, hashes = [], []
    if n > 0:
        total = np.zeros(n, dtype=U64)
        for j in range(k):
            total += word[j:j + n] * places[j]
        whole = row[:n] == row[k - 1:]
        rows.append(row[:n][whole])
        hashes.append(mix(total[whole]))
    short = (count > 0) & (count < k)
    if short.any():
        sel = short[row]
        r, w = row[sel], word[sel]
        begin = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        place = np.arange(len(r)) - np.repeat(begin, np.diff(np.r_[begin, len(r)]))
        total = np.add.reduceat(w * places[place], begin)
        rows.append(r[begin])
        hashes.append(mix(total + count[r[begin]].astype(U64)))
    rows, hashes = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    keep = np.r_[True, (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])]
    return rows[keep], hashes[keep]


def released(run):
    """``run`` (a function of Arrow batches) that gives freed memory back when it ends: Python workers
    live on between tasks, and what they keep adds up beside the JVM's heap."""
    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except AttributeError:                 # not the GNU C library
            pass
    return wrapped
