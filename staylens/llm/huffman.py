"""Token ids as canonical, length-limited Huffman codes in independently decodable blocks."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.base import new_path, query, staged, table
from staylens.llm.texts import Texts, as_binary, flat_bytes, gather, pattern_pieces, piece_keys, slices

LONGEST = 16
MOST_IDS = 1 << LONGEST
STRIDE = 512
TEXT_BYTES = 2 << 20
END_ID = 2
CACHED_BYTES = 24 << 20


# --- tokenizing -----------------------------------------------------------------------

# The bytes that byte-level BPE files write as the character of the same number.
# The others are written as U+0100 onward, in order.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: 0x100 + i for i, b in enumerate(sorted({*range(0x100)} - {*PRINTABLE}))}
CHARS = np.array([BYTE_CHARS.get(b, b) for b in range(0x100)], "<u4")


@functools.lru_cache(maxsize=1)
def loaded(path: str) -> tuple:
    """A tokenizer file, once a process, and the texts of its added tokens."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    return model, [t.content.encode() for t in model.get_added_tokens_decoder().values() if t.content]


class Encoder:
    """A tokenizer, and the ids of words met lately: about ``CACHED_BYTES`` of them, as long as the task lasts.

    Keys are ascending; the ids of word i are ``ids[at[i]:at[i] + size[i]]``.
    """

    def __init__(self, path: str):
        self.model, self.added = loaded(path)
        self.forget()

    def forget(self) -> None:
        self.keys, self.at, self.size, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def places(self, keys: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where each of the ascending ``keys`` stands, after encoding the words ``data[begin:end]`` that are not yet known."""
        if sum(x.nbytes for x in (self.keys, self.at, self.size, self.ids)) > CACHED_BYTES:
            self.forget()
        place = np.searchsorted(self.keys, keys)
        new = np.append(self.keys, np.uint64(0))[place] != keys
        new[place == len(self.keys)] = True
        if not new.any():
            return place
        length = end[new] - begin[new]
        text = CHARS[gather(data, begin[new], length)].tobytes().decode("utf-32-le")
        after = np.cumsum(length).tolist()
        encode = self.model.model.tokenize
        found = [[t.id for t in encode(text[a:b])] for a, b in zip([0, *after], after, strict=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        at = len(self.ids) + np.cumsum(size) - size
        self.ids = np.append(self.ids, np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum())))
        self.keys, self.at, self.size = (np.insert(x, place[new], y) for x, y in ((self.keys, keys[new]), (self.at, at), (self.size, size)))
        return np.searchsorted(self.keys, keys)


def encode_texts(column: pa.Array, encoder: Encoder) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them, and where each row's begin.

    The library's model encodes each different pre-token once, as long as its ids are kept. Only for byte-level BPE files, whose pre-tokens are encoded one by one. Rows in which an added
    token of the file is written out are encoded by the library as a whole, which cuts them there.
    """
    model, added = encoder.model, encoder.added
    texts = Texts(column)
    cuts, rows = pattern_pieces(texts)
    if len(cuts) < 2:
        return np.zeros(0, np.uint32), np.zeros(len(column) + 1, np.int64)
    begin, end = cuts[:-1], cuts[1:]
    keys, first, word = np.unique(piece_keys(texts.data, begin, end), return_index=True, return_inverse=True)
    place = encoder.places(keys, texts.data, begin[first], end[first])[word]
    size = encoder.size[place]
    out = gather(encoder.ids, encoder.at[place], size)
    ends = np.concatenate(([0], np.cumsum(size)))
    at = ends[rows]
    raw = texts.data.tobytes()
    whole = rows_with(raw, texts.at, added)
    if not whole:
        return out, at
    parts, done = [], 0
    count = np.diff(at)
    for row in whole:
        found = model.encode(raw[texts.at[row] : texts.at[row + 1]].decode(), add_special_tokens=False).ids
        parts += [out[at[done] : at[row]], np.array(found, out.dtype)]
        count[row], done = len(found), row + 1
    return np.concatenate([*parts, out[at[done] :]]), np.concatenate(([0], np.cumsum(count)))


def rows_with(raw: bytes, at: np.ndarray, words: list[bytes]) -> list[int]:
    """Rows of ``raw`` that hold one of ``words``, in order."""
    found = set()
    for word in words:
        place = raw.find(word)
        while place >= 0:
            row = int(np.searchsorted(at, place, "right")) - 1
            inside = place + len(word) <= at[row + 1]
            if inside:
                found.add(row)
            place = raw.find(word, int(at[row + 1]) if inside else place + 1)
    return sorted(found)


def tokenize(docs: DataFrame, tokenizer: str, end_id: int | None, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian integers of 16 bits, which the code's longest words allow for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for part in slices(batches, "text", TEXT_BYTES):
            ids, at = encode_texts(part.column("text"), encoder)
            if end_id is not None:
                ids = np.insert(ids, at[1:], end_id)
                at = at + np.arange(len(at))
            if len(ids) and ids.max() >= MOST_IDS:
                raise ValueError(f"id {ids.max()} does not fit 16 bits")
            flat = ids.astype("<u2")
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(at)), as_binary(flat, at)], ["doc_id", "n_tokens", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids binary"
    )


# --- the code -------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most ``longest`` bits (package-merge); 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids need codes of more than {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64)
    n = len(order)
    # Level by level, packages are pairs of the cheapest items; ``is_leaf`` remembers what was taken.
    levels, items, leaf = [], weight, np.ones(n, bool)
    for _ in range(longest - 1):
        levels.append(leaf)
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(1)
        merged = np.concatenate((weight, pairs))
        place = np.argsort(merged, kind="stable")
        items, leaf = merged[place], place < n
    levels.append(leaf)
    take, length = 2 * n - 2, np.zeros(n, np.int64)
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())
        length[:leaves] += 1
        take = 2 * (take - leaves)
    out[order] = length
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        step = np.uint64(1) << (LONGEST - lengths[order].astype(np.uint64))
        start = np.concatenate(([0], np.cumsum(step)[:-1].astype(np.int64)))
        codes[order] = start >> (LONGEST - lengths[order].astype(np.int64))
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id and length for each possible next ``LONGEST`` bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    span = 1 << (LONGEST - lengths[order].astype(np.int64))
    ids, size = np.zeros(1 << LONGEST, np.uint32), np.ones(1 << LONGEST, np.uint8)
    ids[: span.sum()] = np.repeat(order, span)
    size[: span.sum()] = np.repeat(lengths[order], span)
    return ids, size


def pack(ids: np.ndarray, at: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code rows of ids. Each row starts at a 64-bit word, filled from the high bit.

    Returns the words, the word at which each row starts, the bit offset in its row of each
    ``STRIDE``-th id (a checkpoint) and where each row's checkpoints begin.
    """
    wide = np.minimum(np.uint64(64) - lengths, np.uint64(63))
    left = codes.astype(np.uint64) << wide
    size = lengths[ids]
    total = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(size, out=total[1:])
    count = np.diff(at)
    row_words = (total[at[1:]] - total[at[:-1]] + 63) >> 6
    word_at = np.concatenate(([0], np.cumsum(row_words)))
    bit = total[:-1] + np.repeat((word_at[:-1] << 6) - total[at[:-1]], count)
    out = np.zeros(int(word_at[-1]) + 1, np.uint64)
    if len(ids):
        word, shift = bit >> 6, (bit & 63).astype(np.uint8)
        value = left[ids]
        new = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        out[word[new]] = np.add.reduceat(value >> shift, new)
        over = np.flatnonzero(shift + size > 64)
        out[word[over] + 1] += value[over] << (np.uint64(64) - shift[over])
    points = np.maximum(count - 1, 0) // STRIDE
    point_at = np.concatenate(([0], np.cumsum(points)))
    which = np.repeat(at[:-1], points) + STRIDE * (np.arange(point_at[-1]) - np.repeat(point_at[:-1], points) + 1)
    checkpoints = bit[which] - np.repeat(word_at[:-1] << 6, points)
    return out[:-1], word_at, checkpoints, point_at


def unpack(words: np.ndarray, word_at: np.ndarray, count: np.ndarray, checkpoints: np.ndarray, point_at: np.ndarray, decoder: tuple) -> np.ndarray:
    """Ids of all rows, one after the other. All stretches between checkpoints are decoded side by side."""
    symbol, length = decoder
    stretches = (count + STRIDE - 1) // STRIDE
    row = np.repeat(np.arange(len(count)), stretches)
    place = np.arange(len(row)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    offset = np.zeros(len(row), np.int64)
    later = place > 0
    offset[later] = checkpoints[point_at[row[later]] + place[later] - 1]
    bit = (word_at[row] << 6) + offset
    todo = np.minimum(STRIDE, count[row] - place * STRIDE)
    start = np.cumsum(todo) - todo
    order = np.argsort(-todo, kind="stable")
    bit, start = bit[order].astype(np.uint64), start[order]
    live_at = np.searchsorted(-todo[order], -np.arange(STRIDE), "left")
    wide = np.concatenate((words, np.zeros(2, np.uint64)))
    out = np.zeros(int(count.sum()), np.uint32)
    six, one, top, low = np.uint64(6), np.uint64(1), np.uint64(64 - LONGEST), np.uint64(63)
    for k, live in enumerate(live_at.tolist()):
        if not live:
            break
        b = bit[:live]
        w, shift = b >> six, b & low
        peek = ((wide[w] << shift) | ((wide[w + one] >> one) >> (low - shift))) >> top
        out[start[:live] + k] = symbol[peek]
        b += length[peek]
    return out


# --- files ----------------------------------------------------------------------------


def write_coded(tokens: DataFrame, path: str, vocabulary: int) -> None:
    """Write ``tokens`` (doc_id, n_tokens, ids) to ``path`` in ascending doc_id order.

    ``codebook/`` has the code length of each id that occurs: with canonical codes that is the
    whole code. ``blocks/`` has, for each document in order, its coded words, its number of ids
    and the bit offset of every ``STRIDE``-th id; rows start at a word of their own, and every
    stretch between checkpoints can be decoded by itself. ``parts/`` has the number of
    ids in each file of ``blocks/``.

    Ids are counted over all rows in one pass with a histogram a task; the codebook has one
    number for each id of the vocabulary, whatever the input. One range shuffle puts the rows
    in order; they are coded behind it.
    """
    spark = tokens.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(vocabulary, np.int64)
        for batch in batches:
            found += np.bincount(flat_bytes(batch.column(0))[0].view("<u2"), minlength=vocabulary)
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(found[used])], ["id", "n"])

    seen = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(vocabulary, np.int64)
    counts[seen["id"].to_numpy(np.int64)] = seen["n"].to_numpy(np.int64)
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths)
    book = spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id long, bits int")
    book.coalesce(1).write.parquet(f"{path}/codebook")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, file, start = canonical_codes(lengths), TaskContext.get().partitionId(), 0
        for part in slices(batches, "ids", TEXT_BYTES):
            raw, at = flat_bytes(part.column("ids"))
            words, word_at, points, point_at = pack(raw.view("<u2"), at // 2, lengths, codes)
            n = part.column("n_tokens").to_numpy()
            first = start + np.cumsum(n) - n
            start += int(n.sum())
            arrays = [part.column("doc_id"), part.column("n_tokens"), as_binary(words, word_at), as_binary(points.astype("<i8"), point_at)]
            arrays += [pa.array(np.full(part.num_rows, file, np.int32)), pa.array(first)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "words", "checkpoints", "part", "start_in_part"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    in_order = tokens.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    coded = in_order.mapInArrow(code, f"doc_id {kind}, n_tokens long, words binary, checkpoints binary, part int, start_in_part long")
    coded.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    parts = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    parts.coalesce(1).write.parquet(f"{path}/parts")


def read_coded(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from files of ``write_coded``; ids as little-endian 32-bit integers.

    The driver reads the codebook (one row an id of the vocabulary) and the totals by file
    (one row a file of ``blocks/``), nothing else.
    """
    book = spark.read.parquet(f"{path}/codebook").toPandas()
    lengths = np.zeros(int(book["id"].max()) + 1 if len(book) else 1, np.uint8)
    lengths[book["id"].to_numpy(np.int64)] = book["bits"].to_numpy(np.uint8)
    parts = spark.read.parquet(f"{path}/parts").orderBy("part").toPandas()
    base = np.cumsum(parts["part_tokens"].to_numpy(np.int64)) - parts["part_tokens"].to_numpy(np.int64)
    base_of = dict(zip(parts["part"].tolist(), base.tolist(), strict=True))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = decode_table(lengths)
        for part in slices(batches, "words", TEXT_BYTES):
            words, at = flat_bytes(part.column("words"))
            points, point_at = flat_bytes(part.column("checkpoints"))
            count = part.column("n_tokens").to_numpy()
            ids = unpack(words.view("<u8"), at // 8, count, points.view("<i8"), point_at // 8, decoder)
            start = part.column("start_in_part").to_numpy() + np.array([base_of[p] for p in part.column("part").to_pylist()], np.int64)
            rows = np.concatenate(([0], np.cumsum(count)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(start), part.column("n_tokens"), as_binary(ids, rows)], ["doc_id", "start", "n_tokens", "ids"]
            )

    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_id"].dataType.simpleString()
    return blocks.mapInArrow(decode, f"doc_id {kind}, start long, n_tokens long, ids binary")


def huffman_round_trip(
    docs: DataFrame, *, tokenizer: str, vocabulary: int, end_id: int | None = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode the texts, write them in coded form to the shared folder and return what is read back.

    Null text is empty and gives the end id alone; repeated ids stay, in any order among
    themselves; a null id comes first; an empty table gives an empty result; only the two
    named columns are read. More than 65,536 ids are refused.
    """
    if vocabulary > MOST_IDS or (end_id or 0) >= MOST_IDS:
        raise ValueError(f"{vocabulary} ids with end id {end_id} do not fit 16 bits")
    path = new_path(docs.sparkSession, "coded")
    write_coded(staged(tokenize(docs, tokenizer, end_id, id_col, text_col), "token-ids"), path, vocabulary)
    return read_coded(docs.sparkSession, path)


@query("op4_token_output")
def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    read = huffman_round_trip(docs, tokenizer=public_tokenizers.path("byte_bpe_50k.json"), vocabulary=50_257)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = flat_bytes(batch.column("ids"))
            view = memoryview(np.ascontiguousarray(raw))
            crc = [zlib.crc32(view[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            columns = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return read.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
