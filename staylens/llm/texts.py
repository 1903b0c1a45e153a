"""Texts in Arrow batches as flat byte arrays, and vectorised word boundaries over them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

# Code points of Unicode's White_Space property.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
LETTER, NUMBER, SPACE = 1, 2, 3


class Texts:
    """Some rows of a string column: ``data`` holds their UTF-8 bytes, row i is ``data[at[i]:at[i + 1]]``.

    Null is the empty text. Bytes that are not UTF-8 become U+FFFD.
    """

    def __init__(self, column: pa.Array):
        data, at = flat_bytes(column)
        try:
            text = data.tobytes().decode()
        except UnicodeDecodeError:
            parts = [data[a:b].tobytes().decode(errors="replace").encode() for a, b in zip(at[:-1], at[1:], strict=True)]
            at = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
            data = np.frombuffer(b"".join(parts), np.uint8)
            text = data.tobytes().decode()
        self.data, self.at, self.text = data, at, text

    def code_points(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code points, the byte at which each starts (and the end), and where each row starts among them."""
        points = np.frombuffer(self.text.encode("utf-32-le"), np.uint32)
        if len(points) == len(self.data):
            return points, np.arange(len(points) + 1), self.at
        starts = np.append(np.flatnonzero((self.data & 0xC0) != 0x80), len(self.data))
        return points, starts, np.searchsorted(starts, self.at)


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column, nulls being empty."""
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, values = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32, n + 1 + column.offset)[column.offset :].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches again, cut into runs of rows with about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        _, at = flat_bytes(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last


@cache
def classes() -> np.ndarray:
    """Class of each code point: letter, number, white space or 0."""
    import regex

    table = np.zeros(0x110000, np.uint8)
    # From one array: a million strings and numbers would take 130 MB for a moment, in every worker.
    points = np.delete(np.arange(0x110000, dtype="<u4"), np.s_[0xD800:0xE000]).tobytes().decode("utf-32-le")
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, points):
            shift = 0x800 if m.start() >= 0xD800 else 0
            table[m.start() + shift : m.end() + shift] = kind
            if m.start() < 0xD800 < m.end():
                table[0xD800 : m.end() + 0x800] = kind
                table[0xD800:0xE000] = 0
    table[list(WHITE_SPACE)] = SPACE
    return table


def pattern_pieces(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Where the matches of the tokenizers' split pattern begin: byte offsets (with the end), and per row its first match.

    Same cuts as searching ``public_tokenizers.PATTERN`` row by row: runs of one class,
    a blank joining the run after it, the last of several white spaces standing apart
    before a word, and the seven contractions.
    """
    points, starts, rows = texts.code_points()
    n = len(points)
    if not n:
        return np.zeros(1, np.int64), np.zeros(len(rows), np.int64)
    kind = classes()[points]
    row_start = np.zeros(n + 1, bool)
    row_start[rows] = True
    row_start = row_start[:n]
    cut = row_start.copy()
    cut[1:] |= kind[1:] != kind[:-1]
    after = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~row_start[1:]) + 1
    cut[after - 1] = True
    cut[after] = points[after - 1] != 0x20
    quote = np.flatnonzero((points == 0x27) & cut)
    quote = quote[quote + 1 < n]
    quote = quote[~row_start[quote + 1]]
    if len(quote):
        a = points[quote + 1]
        b = np.where(quote + 2 < n, points[np.minimum(quote + 2, n - 1)], 0)
        b = np.where(row_start[np.minimum(quote + 2, n - 1)], 0, b)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        size = np.where(one, 2, np.where(two, 3, 0))
        quote, size = quote[size > 0], size[size > 0]
        cut[quote + 1] = False
        end = quote + size
        end = end[end < n]
        cut[end[kind[end] == LETTER]] = True
    at = np.flatnonzero(cut)
    return np.append(starts[at], len(texts.data)).astype(np.int64), np.searchsorted(at, rows)


def blank_words(texts: Texts, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between white space: byte starts, byte ends, and per row its first word."""
    points, starts, rows = texts.code_points()
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(rows), np.int64)
    inside = classes()[points] != SPACE
    first, last = inside.copy(), inside.copy()
    edge = np.zeros(n + 1, bool)
    edge[rows] = True
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts[begin].astype(np.int64), starts[end].astype(np.int64), np.searchsorted(begin, rows)


_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64's constants)."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def words_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each offset as an integer; ``data`` must have eight bytes of padding."""
    view = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data).data, strides=(1,))
    return view[at]


def piece_keys(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit key of each byte string: the bytes themselves up to seven, a hash with the top bit set beyond."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    size = (end - begin).astype(np.uint64)
    head = words_at(padded, begin)
    short = np.minimum(size, np.uint64(7))
    keys = (head & ((np.uint64(1) << (short * np.uint64(8))) - np.uint64(1))) | (short << np.uint64(56))
    long = np.flatnonzero(size > 7)
    if len(long):
        h, left, at = size[long] * _M1, size[long].astype(np.int64), begin[long].copy()
        live = np.arange(len(long))
        while len(live):
            take = np.minimum(left[live], 8).astype(np.uint64)
            word = words_at(padded, at[live])
            word = np.where(take == 8, word, word & ((np.uint64(1) << ((take & np.uint64(7)) * np.uint64(8))) - np.uint64(1)))
            h[live] = mix((h[live] ^ word) + _M1)
            at[live] += 8
            left[live] -= 8
            live = live[left[live] > 0]
        keys[long] = h | np.uint64(1 << 63)
    return keys


def gather(flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``flat[at[i]:at[i] + size[i]]`` for all i, one after the other."""
    total = int(size.sum())
    shift = at - np.concatenate(([0], np.cumsum(size)[:-1])) if len(size) else at
    place = np.repeat(shift, size)
    place += np.arange(total)
    return flat[place]


def as_binary(flat: np.ndarray, at: np.ndarray) -> pa.Array:
    """A binary column whose row i is ``flat[at[i]:at[i + 1]]``."""
    width = flat.dtype.itemsize
    raw = np.ascontiguousarray(flat).view(np.uint8)
    offsets = (np.asarray(at, np.int64) * width)
    kind, dtype = (pa.binary(), np.int32) if offsets[-1] < 2**31 else (pa.large_binary(), np.int64)
    array = pa.Array.from_buffers(kind, len(at) - 1, [None, pa.py_buffer(offsets.astype(dtype)), pa.py_buffer(raw)])
    return array
