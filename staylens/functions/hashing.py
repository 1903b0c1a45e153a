"""Term counts of many texts at once, by numpy over Arrow batches: the words, stop words and buckets of the MLlib text stages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from staylens.functions.stopwords import ENGLISH_STOP_WORDS

# Bytes of text that are worked on at a time.
SLICE_BYTES = 1 << 20

# The characters of the pattern \s, each one byte in UTF-8.
BLANK = np.zeros(256, bool)
BLANK[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column without nulls, row i being ``data[at[i]:at[i + 1]]``."""
    _, offsets, values = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins and ends, and its row: pieces between single blanks, without empty ones at the end of a row.

    An empty row has one empty word, a row of blanks has none.
    """
    begin, end = at[:-1], at[1:].copy()
    blank = BLANK[data]
    solid = np.flatnonzero(~blank)
    last = np.searchsorted(solid, end) - 1
    found = last >= 0
    found[found] = solid[last[found]] >= begin[found]
    has_words = found | (begin == end)
    end[found] = solid[last[found]] + 1
    cut = np.flatnonzero(blank)
    row = np.searchsorted(at, cut, "right") - 1
    inside = found[row] & (cut < end[row])
    cut, row = cut[inside], row[inside]
    rows = np.flatnonzero(has_words)
    first, after = np.searchsorted(row, rows), np.searchsorted(row, rows, "right")
    return np.insert(cut + 1, first, begin[rows]), np.insert(cut, after, end[rows]), np.insert(row, first, rows)


def unaligned(padded: np.ndarray, kind: str) -> np.ndarray:
    """The number of type ``kind`` that begins at each byte."""
    size = np.dtype(kind).itemsize
    return np.ndarray((len(padded) - size + 1,), kind, padded.data, strides=(1,))


def murmur3(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The standard 32-bit MurmurHash3 (seed 42) of byte strings, as signed integers."""

    def mixed(k: np.ndarray) -> np.ndarray:
        k = k * np.uint32(0xCC9E2D51)
        return (k << np.uint32(15) | k >> np.uint32(17)) * np.uint32(0x1B873593)

    view = unaligned(np.concatenate((data, np.zeros(8, np.uint8))), "<u4")
    h, whole = np.full(len(begin), 42, np.uint32), size // 4
    live = np.flatnonzero(whole)
    step = 0
    while len(live):
        x = h[live] ^ mixed(view[begin[live] + 4 * step])
        h[live] = (x << np.uint32(13) | x >> np.uint32(19)) * np.uint32(5) + np.uint32(0xE6546B64)
        step += 1
        live = live[whole[live] > step]
    rest = (size & 3).astype(np.uint32)
    tail = view[begin + 4 * whole] & ((np.uint32(1) << (rest * np.uint32(8))) - np.uint32(1))
    h ^= mixed(tail)  # nothing is mixed in where nothing is left over
    h ^= size.astype(np.uint32)
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return (h ^ h >> np.uint32(16)).view(np.int32)


def listed(data: np.ndarray, begin: np.ndarray, size: np.ndarray, stop_words: list[str]) -> np.ndarray:
    """Which byte strings are in the list; compared in full, in numbers of up to eight bytes."""
    view = unaligned(np.concatenate((data, np.zeros(16, np.uint8))), "<u8")

    def key(at: np.ndarray, length: np.ndarray) -> np.ndarray:
        bits = np.minimum(length, 7).astype(np.uint64) * np.uint64(8)
        return view[at] & ((np.uint64(1) << bits) - np.uint64(1)) | length.astype(np.uint64) << np.uint64(56)

    stops = [w.lower().encode() for w in stop_words]
    short = np.array([int.from_bytes(w, "little") | len(w) << 56 for w in stops if len(w) < 8], np.uint64)
    hit = (size < 8) & np.isin(key(begin, np.minimum(size, 8)), short)
    for word in (w for w in stops if len(w) >= 8):
        same = np.flatnonzero(size == len(word))
        for i in range(0, len(word), 7):
            part = word[i : i + 7]
            same = same[key(begin[same] + i, np.full(len(same), len(part))) == np.uint64(int.from_bytes(part, "little") | len(part) << 56)]
        hit[same] = True
    return hit


def term_counts(data: np.ndarray, at: np.ndarray, buckets: int, stop_words: list[str] = ENGLISH_STOP_WORDS) -> tuple[np.ndarray, ...]:
    """Buckets, counts, and where each row's begin (with the end); buckets ascend within a row. Rows are lower-cased texts."""
    begin, end, row = words(data, at)
    size = end - begin
    kept = ~listed(data, begin, size, stop_words)
    begin, size, row = begin[kept], size[kept], row[kept]
    bucket = murmur3(data, begin, size).astype(np.int64) % buckets
    keys, counts = np.unique(row * buckets + bucket, return_counts=True)
    return (keys % buckets).astype(np.int32), counts.astype(np.float64), np.searchsorted(keys, np.arange(len(at)) * buckets)


def vector_batches(text: str, output: str, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: the column ``text`` replaced by sparse count vectors, as rows of the vector type's fields."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = flat(batch.column(text))[1]
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(at, at[first] + SLICE_BYTES, "right")) - 1)
                part = batch.slice(first, last - first)
                indices, counts, cut = term_counts(*flat(part.column(text)), buckets)
                n, cut = part.num_rows, pa.array(cut.astype(np.int32))
                vectors = pa.StructArray.from_arrays(
                    [
                        pa.array(np.zeros(n, np.int8)),
                        pa.array(np.full(n, buckets, np.int32)),
                        pa.ListArray.from_arrays(cut, pa.array(indices)),
                        pa.ListArray.from_arrays(cut, pa.array(counts)),
                    ],
                    ["type", "size", "indices", "values"],
                )
                others = [c for c in part.schema.names if c != text]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), vectors], [*others, output])
                first = last

    return run
