"""Byte-level BPE with Spark's higher-order functions over distinct words, and decoding by concatenation."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.base import leanly, query, table
from staylens.llm.texts import Texts, as_binary, flat_bytes, gather, pattern_pieces, piece_keys, slices

TEXT_BYTES = 1 << 19
CODE_BYTES = 1 << 18
WORDS = 1_000_000
SHARED = 4
BITS = 17
TRIES = 4_096
NONE = (1 << BITS) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the bytes, then the rank, on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def last_pairs(ranks: dict[bytes, int]) -> tuple[dict[tuple[int, int], int], dict[bytes, int]]:
    """The two ids that each entry longer than a byte is joined from, and the entries that no merging reaches.

    Merges inside a span do not depend on what surrounds it until one crosses its edge, so
    an entry can only arise from the pair that merging its own bytes ends with.
    """
    if any(bytes([byte]) not in ranks for byte in range(256)):
        raise ValueError("ranks must hold all single bytes")
    pairs, unreached = {}, {}
    for entry, rank in ranks.items():
        pieces = [entry[i : i + 1] for i in range(len(entry))]
        while len(pieces) > 2:
            found = [(ranks[x + y], i) for i, (x, y) in enumerate(zip(pieces, pieces[1:], strict=False)) if x + y in ranks]
            if not found:
                break
            i = min(found)[1]
            pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
        if len(pieces) == 2:
            pairs[ranks[pieces[0]], ranks[pieces[1]]] = rank
        elif len(pieces) > 2:
            unreached[entry] = rank
    return pairs, unreached


def pair_rows(pairs: dict[tuple[int, int], int], ids: int) -> tuple[np.ndarray, np.ndarray]:
    """``pairs`` as a literal table: (a, b) is at ``place[a] + b``, as ``a << BITS | rank``.

    Rows of one left id are laid over each other where they leave gaps, largest first. ``ids`` itself stands for an edge.
    """
    rows: dict[int, list[int]] = {}
    for a, b in pairs:
        rows.setdefault(a, []).append(b)
    place, used = np.zeros(ids + 1, np.int64), np.zeros(8 * (ids + 1) + 8 * len(pairs) + 2 * TRIES, bool)
    for a in sorted(rows, key=lambda a: (-len(rows[a]), a)):
        at = np.zeros(0, np.int64)
        first = 0
        while not len(at):
            at = np.arange(first, first + TRIES)
            for b in rows[a]:
                at = at[~used[at + b]]
            first += TRIES
        place[a] = at[0]
        used[at[0] + np.array(rows[a])] = True
    entries = np.full(int(place.max()) + ids + 1, 1 << 60, np.int64)
    for (a, b), rank in pairs.items():
        entries[place[a] + b] = a << BITS | rank
    return place, entries


def literal(numbers: np.ndarray, kind: str) -> Column:
    return F.split(F.lit(",".join(map(str, numbers.tolist()))), ",").cast(f"array<{kind}>")


def bind(value: Column, use: callable) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


class Merges:
    """The pairs of a vocabulary as a literal table, and the state that merging a word starts from.

    A state is one number an id: the rank of joining it with the next (``NONE`` where there is none), then the id.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.edge = max(ranks.values(), default=0) + 1
        if self.edge >= NONE:
            raise ValueError(f"ranks must be below {NONE - 1}")
        pairs, unreached = last_pairs(ranks)
        self.place, self.entries = pair_rows(pairs, self.edge)
        self.byte_ids = np.array([ranks[bytes([byte])] for byte in range(256)], np.int64)
        spelled = {entry: self.start(np.array([self.edge, *self.byte_ids[list(entry)], self.edge])) for entry in unreached}
        self.unreached = {" ".join(map(str, state.tolist())): unreached[entry] for entry, state in spelled.items()}

    def start(self, ids: np.ndarray) -> np.ndarray:
        """States of words of byte ids, one after the other, each between two edges."""
        after = np.append(ids[1:], self.edge)
        rank = np.minimum(self.entries[self.place[ids] + after] ^ (ids << BITS), NONE)
        return rank << BITS | ids


def merge_ranks(state: Column, merges: Merges) -> Column:
    """Ids of a word, from its ``Merges.start``: adjacent ids of the lowest rank are joined, leftmost first, until none has a rank.

    A fold over as many steps as there are bytes less one. A rank is the id of what it joins
    to, so a merge looks up two new ranks. The rank map is a literal, bound once: every
    place that named it itself would hold a copy of it, in the driver and in each task.
    All numbers are longs, as casts inside a lambda are evaluated for each element; the ends are
    taken by ``filter``, as ``slice`` goes through a boxed sequence each time.
    """
    none = F.lit(NONE).cast("long")

    def fold(place: Column, entries: Column) -> Column:
        def with_next(a: Column, b: Column) -> Column:
            rank = F.least(F.get(entries, F.get(place, a) + b).bitwiseXOR(F.shiftleft(a, BITS)), none)
            return F.shiftleft(rank, BITS).bitwiseOR(a)

        def id_at(state: Column, i: Column) -> Column:
            return F.get(state, i).bitwiseAND(none)

        def step(state: Column, _: Column) -> Column:
            def merged(lowest: Column) -> Column:
                new = F.shiftright(lowest, BITS)

                def put(i: Column) -> Column:
                    # i is the place before the pair, counted from 0.
                    pair = bind(id_at(state, i), lambda a: F.array(with_next(a, new), with_next(new, id_at(state, i + 3))))
                    return F.concat(F.filter(state, lambda _, j: j < i), pair, F.filter(state, lambda _, j: j - 2 > i))

                joined = bind(F.array_position(state, lowest).cast("int") - 2, put)
                return F.when(lowest >= F.lit(NONE << BITS), state).otherwise(joined)

            return bind(F.array_min(state), merged)

        steps = F.sequence(F.lit(1), F.greatest(F.size(state) - 3, F.lit(1)))
        ids = F.transform(F.aggregate(steps, state, step), lambda x: x.bitwiseAND(none).cast("int"))
        return F.filter(ids, lambda x: x != F.lit(merges.edge))

    folded = bind(literal(merges.place, "long"), lambda p: bind(literal(merges.entries, "long"), lambda e: fold(p, e)))
    if not merges.unreached:
        return folded
    whole = F.try_element_at(F.from_json(F.lit(json.dumps(merges.unreached)), "map<string,int>"), F.array_join(state, " "))
    return F.coalesce(bind(whole, lambda rank: F.when(rank.isNotNull(), F.array(rank))), folded)


def pieces(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that the ids stand for, one after the other, and where each begins (with the end)."""
    by_id = [b""] * (max(ranks.values(), default=0) + 1)
    for piece, rank in ranks.items():
        by_id[rank] = piece
    return np.frombuffer(b"".join(by_id), np.uint8), np.cumsum([0, *map(len, by_id)])


class Grown:
    """Numbers that come in parts; room doubles, so that a part costs its own size."""

    def __init__(self, kind: type):
        self.room, self.size = np.zeros(1 << 12, kind), 0

    def add(self, numbers: np.ndarray) -> None:
        size = self.size + len(numbers)
        if size > len(self.room):
            room = np.zeros(max(size, 2 * len(self.room)), self.room.dtype)
            room[: self.size] = self.all()
            self.room = room
        self.room[self.size : size] = numbers
        self.size = size

    def all(self) -> np.ndarray:
        return self.room[: self.size]


class Coded:
    """Words by number: their ids and the bytes these decode to, and where each word's begin (with the end)."""

    def __init__(self, vocabulary: tuple[np.ndarray, np.ndarray]):
        self.pieces, self.piece_at = vocabulary
        self.ids, self.bytes, self.id_at, self.byte_at = Grown(np.uint32), Grown(np.uint8), Grown(np.int64), Grown(np.int64)
        self.id_at.add(np.zeros(1, np.int64))
        self.byte_at.add(np.zeros(1, np.int64))

    def add(self, ids: np.ndarray, at: np.ndarray) -> None:
        """More words: the next one has ``ids[at[0]:at[1]]``. Bytes are the pieces of the ids, concatenated."""
        begin, size = self.piece_at[ids], np.diff(self.piece_at)[ids]
        self.byte_at.add(self.bytes.size + np.concatenate(([0], np.cumsum(size)))[at[1:]])
        self.bytes.add(gather(self.pieces, begin, size))
        self.id_at.add(self.ids.size + at[1:])
        self.ids.add(ids)


class Known:
    """Numbers of the keys seen so far, in order of their first coming: two sorted arrays, 12 bytes a key."""

    def __init__(self):
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def number(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of ``keys``, which are sorted and distinct; new ones get the next."""
        at = np.searchsorted(self.keys, keys)
        old = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        old[inside] = self.keys[at[inside]] == keys[inside]
        numbers = np.empty(len(keys), np.int32)
        numbers[old] = self.numbers[at[old]]
        numbers[~old] = np.arange(len(self.keys), len(self.keys) + np.count_nonzero(~old))
        self.keys = np.insert(self.keys, at[~old], keys[~old])
        self.numbers = np.insert(self.numbers, at[~old], numbers[~old])
        return numbers


def encode_decode(docs: DataFrame, ranks: dict[bytes, int], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids as little-endian 32-bit integers, and the bytes they decode to.

    Texts are cut where the tokenizers' split pattern cuts them. Within a task each distinct
    word is sent once, ahead of the texts that first hold it, through the merging
    fold; its ids are decoded once, and the texts follow as numbers of words. Nothing is shuffled.
    After ``WORDS`` distinct words a task starts its list anew, which bounds memory and
    repeats some words.

    Null text is empty: no ids, no bytes; ids and repeated rows stay as they are; an empty table
    gives an empty result; only the two named columns are read. Bytes that are not UTF-8
    become U+FFFD first.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    merges, vocabulary = Merges(ranks), pieces(ranks)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known()
        for part in slices(batches, "text", TEXT_BYTES):
            texts = Texts(part.column("text"))
            cuts, rows = pattern_pieces(texts)
            begin, end = cuts[:-1], cuts[1:]
            keys, first, word = np.unique(piece_keys(texts.data, begin, end), return_index=True, return_inverse=True)
            if len(known.keys) > WORDS:
                known = Known()
            before = len(known.keys)
            of_key = known.number(keys)
            new = first[of_key >= before]
            size = end[new] - begin[new]
            after = np.cumsum(size)
            words = np.insert(merges.byte_ids[gather(texts.data, begin[new], size)], np.repeat(np.append(0, after), 2)[1:-1], merges.edge)
            lists = pa.ListArray.from_arrays(np.append(0, after + 2 * np.arange(1, len(new) + 1)).astype(np.int32), merges.start(words))
            n = len(new)
            if n:
                nulls = [pa.nulls(n, part.schema.field("id").type), pa.nulls(n, pa.binary())]
                yield pa.RecordBatch.from_arrays([*nulls, lists, pa.array(np.arange(before, before + n))], ["id", "codes", "word", "code"])
            numbers = as_binary(of_key[word].astype("<i4"), rows)
            m = part.num_rows
            yield pa.RecordBatch.from_arrays([part.column("id"), numbers, pa.nulls(m, lists.type), pa.nulls(m, pa.int64())], ["id", "codes", "word", "code"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = Coded(vocabulary)
        for batch in batches:
            is_word = np.asarray(batch.column("code").is_valid())
            turns = np.flatnonzero(np.diff(is_word)) + 1
            for a, b in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows], strict=True):
                run = batch.slice(a, b - a)
                if is_word[a]:
                    at_zero = np.flatnonzero(run.column("code").to_numpy() == 0)
                    if len(at_zero):
                        coded = Coded(vocabulary)
                        run = run.slice(int(at_zero[0]))
                    lists = run.column("ids")
                    at = np.asarray(lists.offsets, np.int64)
                    coded.add(np.asarray(lists.values, np.uint32)[at[0] : at[-1]], at - at[0])
                    continue
                id_at, byte_at = coded.id_at.all(), coded.byte_at.all()
                for part in slices(iter([run]), "codes", CODE_BYTES):
                    raw, at = flat_bytes(part.column("codes"))
                    word, at = raw.view("<i4"), at // 4
                    size, length = id_at[word + 1] - id_at[word], byte_at[word + 1] - byte_at[word]
                    ends = np.concatenate(([0], np.cumsum(size)))[at]
                    byte_ends = np.concatenate(([0], np.cumsum(length)))[at]
                    ids = gather(coded.ids.all(), id_at[word], size).astype("<u4")
                    back = gather(coded.bytes.all(), byte_at[word], length)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id"), pa.array(np.diff(ends)), as_binary(ids, ends), as_binary(back, byte_ends)], ["doc_id", "n_tokens", "ids", "decoded"]
                    )

    words = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(leanly(split), f"id {kind}, codes binary, word array<long>, code long")
    merged = words.withColumn("ids", F.when(F.col("word").isNotNull(), merge_ranks(F.col("word"), merges)))
    return merged.select("id", "codes", "code", "ids").mapInArrow(leanly(assemble), f"doc_id {kind}, n_tokens long, ids binary, decoded binary")


def multi_ranks() -> dict[bytes, int]:
    import public_tokenizers

    return read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def sharing(files: DataFrame) -> DataFrame:
    """A table as its files hold it, read by tasks of ``SHARED`` of its partitions, but two for each core: words they have in common are folded once."""
    parts = files.rdd.getNumPartitions()
    tasks = max(-(-parts // SHARED), 2 * files.sparkSession.sparkContext.defaultParallelism)
    return files.coalesce(tasks) if tasks < parts else files


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_decode(sharing(table(spark, sf_dir, "documents").select("doc_id", "text")), multi_ranks()))
