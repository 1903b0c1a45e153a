"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staylens.llm.base import MOST_HOT, leanly, query, staged, table
from staylens.llm.texts import Texts, as_binary, blank_words, flat_bytes, mix, piece_keys, slices
from staylens.operators.joins import keyed_join

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9999
ROWS = 6
TEXT_BYTES = 1 << 20
TILE = 512
KEY = ["k1", "k2", "n"]


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` hashes so that a pair of that similarity shares one with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row's runs of ``WORDS`` lower-case words, and where each row's begin.

    A text of fewer words has one shingle of all of them; one of none has no shingle.
    """
    texts = Texts(pc.utf8_lower(column))
    begin, end, first = blank_words(texts)
    words = mix(piece_keys(texts.data, begin, end)) if len(begin) else np.zeros(0, np.uint64)
    bounds = np.append(first[:-1], len(words))
    count = np.diff(bounds)
    each = np.maximum(count - WORDS + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(len(count)), each)
    at = np.repeat(bounds[:-1] - (np.cumsum(each) - each), each) + np.arange(len(row))
    left = np.minimum(count[row], WORDS)
    h = left.astype(np.uint64)
    for k in range(WORDS):
        inside = left > k
        h[inside] = mix(h[inside] * np.uint64(0x9E3779B97F4A7C15) ^ words[at[inside] + k])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], np.searchsorted(row[new], np.arange(len(count) + 1))


def set_keys(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128 bits that name a set of shingles, and its size."""
    n = np.diff(at)
    a, b = (np.append(np.uint64(0), np.cumsum(mix(h ^ np.uint64(salt)), dtype=np.uint64)) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F))
    return (a[at[1:]] - a[at[:-1]]).astype(np.int64), (b[at[1:]] - b[at[:-1]]).astype(np.int64), n


def sketches(docs: DataFrame, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(id, k1, k2, n, bands) of every row: the name and size of its shingle set, and a hash of each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(11)
        factor = rng.integers(0, 2**63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
        shift = rng.integers(0, 2**63, bands * rows, np.uint64)
        for part in slices(batches, "text", TEXT_BYTES):
            h, at = shingle_sets(part.column("text").fill_null(""))
            k1, k2, n = set_keys(h, at)
            full = np.flatnonzero(n)
            out = np.zeros((part.num_rows, bands), np.int64)
            for band in range(bands):
                value = np.full(len(full), band, np.uint64)
                for k in range(band * rows, (band + 1) * rows):
                    value = mix(value ^ np.minimum.reduceat(h * factor[k] + shift[k], at[full])) if len(full) else value
                out[full, band] = value.astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1) * bands, pa.int32()), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(k1), pa.array(k2), pa.array(n, pa.int64()), lists], ["id", *KEY, "bands"])

    columns = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return columns.mapInArrow(leanly(run), "id long, k1 long, k2 long, n long, bands array<long>")


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest node it is connected with.

    Alternating large-star and small-star steps; each round is written to the shared folder, and
    only two sums over the edges come to the driver to tell that nothing changed. Minima are
    combined before the shuffle, and they are dealt anew for the joins, so that Spark can
    split a node with very many edges.
    """

    def spread(least: DataFrame) -> DataFrame:
        return least.withColumn("deal", F.xxhash64("a"))

    def distinct(pairs: DataFrame) -> DataFrame:
        return pairs.where("a <> b").distinct()

    now = staged(distinct(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), name)
    before = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = spread(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = distinct(spread(both.where("b > a")).join(least, ["a", "deal"]).select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = staged(large, name)
        least = spread(large.groupBy("a").agg(F.min("b").alias("m")))
        small = spread(large).join(least, ["a", "deal"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = staged(distinct(small.union(least.select("a", F.col("m").alias("b")))), name)
        sums = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sums == before:
            break
        before = sums
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def verified(tiles: DataFrame, similarity: float) -> DataFrame:
    """(a, b, links): for each row of a tile its linked rows counted (a, null, links), and edges that connect what is linked.

    A tile holds at most two runs of ``TILE`` rows or so. The shared shingles of one row with all others are
    counted in one pass over the tile's sets; linked pairs are never listed.
    """

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids, order = np.unique(group.column("id").to_numpy(), return_index=True)
        side = group.column("side").to_numpy()[order]
        copies = group.column("copies").to_numpy()[order]
        raw, cut = flat_bytes(group.column("shingles").chunk(0).take(pa.array(order)))
        h, at = raw.view("<u8"), cut // 8
        _, code = np.unique(h, return_inverse=True)
        size, mark = np.diff(at), np.zeros(int(code.max()) + 1 if len(code) else 1, np.uint8)
        two = len(np.unique(side)) > 1
        linked = np.zeros((len(ids), len(ids)), bool)
        for i in range(len(ids)):
            own = code[at[i] : at[i + 1]]
            mark[own] = 1
            shared = np.add.reduceat(mark[code], at[:-1], dtype=np.int64)
            mark[own] = 0
            linked[i] = shared >= similarity * (size + size[i] - shared) - 1e-9
            linked[i, i] = False
            if two:
                linked[i, side == side[i]] = False
        links = linked @ copies
        label = np.arange(len(ids))
        while True:
            best = np.where(linked, label, len(ids)).min(1, initial=len(ids))
            new = np.minimum(label, best)
            new = np.minimum(new, new[new])
            if (new == label).all():
                break
            label = new
        edge = np.flatnonzero(label != np.arange(len(ids)))
        a = np.concatenate((ids, ids[edge]))
        b = pa.concat_arrays([pa.nulls(len(ids), pa.int64()), pa.array(ids[label[edge]])])
        return pa.table({"a": a, "b": b, "links": np.concatenate((links, np.zeros(len(edge), np.int64)))})

    return tiles.groupBy("root", "low", "high").applyInArrow(run, "a long, b long, links long")


def jaccard_join(
    docs: DataFrame, *, similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, class_id, copy_of, n_links) of every row.

    Two rows are linked if the Jaccard similarity of their sets of five-word shingles (lower
    case, words between white space) is ``similarity`` or more. ``n_links`` counts a row's
    links, ``class_id`` is the smallest id connected with it by links, ``copy_of`` the smallest id with the
    very same set.

    1. Rows with one set are one representative: an aggregate combined before the shuffle.
    2. Representatives go to their bands' hashes (as many bands as ``recall`` needs at ``similarity``);
       neighbours in a band are candidates, connected ones form a group.
    3. The groups' texts are fetched and all pairs of a group are decided on full shingle sets. A
       group of more than ``TILE`` rows is dealt into runs, and every pair of runs is a task of its own.
    4. Links are counted in place and never listed; only edges that connect what is linked go on.

    Null and empty texts have no links and are classes of their own; texts of one to four words are
    linked if they have the same words; null ids have a null class; repeated rows
    are linked like any copies, and so are different texts of one id, each row by its own text; an empty table gives an empty result; only the two named columns are read.
    """
    bands = bands_for(similarity, recall, rows)
    sketched = staged(sketches(docs, bands, rows, id_col, text_col), "sketches")
    found = sketched.where("n > 0 and id is not null").groupBy(*KEY)
    sets_ = found.agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
    # An id may have several texts, so sets are numbered; the numbers hold once the table is written.
    reps = staged(sets_.withColumn("node", F.monotonically_increasing_id()), "sets")

    in_band = Window.partitionBy("band").orderBy("node")
    banded = reps.select("node", F.explode("bands").alias("band")).withColumn("before", F.lag("node").over(in_band))
    candidates = banded.where("before is not null").select(F.col("node").alias("a"), F.col("before").alias("b")).distinct()
    groups = staged(components(candidates, "candidates"), "groups")
    size = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("runs"))
    size = size.withColumn("deal", F.xxhash64("root"))
    members = groups.withColumn("deal", F.xxhash64("root")).join(size, ["root", "deal"]).join(reps.drop("bands"), "node")
    members = members.select("root", "node", "rep", "copies", "runs", *KEY)

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", TEXT_BYTES):
            h, at = shingle_sets(part.column("text").fill_null(""))
            same = np.ones(part.num_rows, bool)
            for mine, name in zip(set_keys(h, at), KEY, strict=True):
                same &= mine == part.column(name).to_numpy()
            kept = part.append_column("shingles", as_binary(h.astype("<u8"), at)).filter(pa.array(same))
            yield kept.select(["root", "id", "copies", "runs", "shingles"])

    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))
    sets = texts.join(members, "rep").select("root", F.col("node").alias("id"), "copies", "runs", *KEY, "text")
    sets = sets.mapInArrow(leanly(with_sets), "root long, id long, copies long, runs int, shingles binary")
    run = F.pmod(F.xxhash64("id"), F.col("runs")).cast("int")
    tiles = sets.withColumn("side", run).withColumn("other", F.explode(F.expr("sequence(0, runs - 1)")))
    tiles = tiles.select("root", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "id", "side", "copies", "shingles")
    decided = staged(verified(tiles, similarity), "links")

    links = decided.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    classes = components(decided.where("b is not null").select("a", "b"), "classes")
    known = reps.drop("bands").join(links, "node", "left").join(classes, "node", "left")
    known = staged(known.select(*KEY, "rep", F.coalesce("root", "node").alias("root"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")), "known")
    smallest = known.groupBy("root").agg(F.min("rep").alias("class"), F.count(F.lit(1)).alias("_rows"))
    known = keyed_join(known, staged(smallest, "class-ids"), ["root"], "_rows", MOST_HOT)
    known = known.select(*KEY, "rep", F.col("class").alias("root"), "links")
    deal = F.xxhash64(*KEY)
    rows_ = sketched.drop("bands").withColumn("deal", deal).join(known.withColumn("deal", deal), [*KEY, "deal"], "left")
    own = F.col("id").isNotNull()
    return rows_.select(
        F.col("id").alias("doc_id"),
        F.when(own, F.coalesce("root", "id")).alias("class_id"),
        F.when(own, F.coalesce("rep", "id")).alias("copy_of"),
        F.when(own, F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )


@query("op1_jaccard_join")
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))
