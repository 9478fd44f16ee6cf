"""SimHash near-duplicates, found through segment popcounts.

Each fingerprint is mapped to 32 counts, the ones in each two-bit segment. The Manhattan distance of two
count vectors never exceeds the Hamming distance of the fingerprints. The 32 axes form six
groups; two vectors at distance 3 or less differ on three groups at most, so they share the grid cell of at least one
of the 20 choices of three whole groups. Cells are compared in blocks: first by Manhattan
distance, then by the bits themselves. Counts are kept in unary (00, 01, 11), so their Manhattan distance is the
popcount of an exclusive or.

Copies share a fingerprint and are one node; crowded cells are cut into blocks of
``BLOCK`` nodes whose pairs of blocks are spread over tasks, and a block pair returns a spanning forest of its links, never
all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.keys import components, doc_key, packed, unpacked
from ledgermill.llm.textops import chunks, lower_ascii, respaced, space_words, text_bytes, xxh64
from ledgermill.session import settle

MAX_BITS = 3
BLOCK = 256
VOTES = 1 << 14  # shingles whose 64 votes are summed at once, as eight-byte integers
CHUNK = 1 << 19  # bytes of text hashed at once; what a worker keeps in memory follows it
LOW = 0x5555555555555555
GROUPS = 6  # any 3 differences leave 3 of them equal


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _shingles(starts: np.ndarray, ends: np.ndarray, before: np.ndarray, size: int):
    """Start, end and text of each run of ``size`` words; a shorter text is one run."""
    words = np.diff(before)
    runs = np.where(words >= size, words - size + 1, np.minimum(words, 1))
    owner = np.repeat(np.arange(len(words)), runs)
    index = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    first = before[:-1][owner] + index
    last = np.minimum(first + size, before[1:][owner]) - 1
    return starts[first], ends[last], owner


def simhash_batch(texts: pa.Array, size: int = 3) -> np.ndarray:
    """Fingerprints of texts as signed 64-bit integers."""
    raw, offsets = text_bytes(texts)
    low = lower_ascii(raw)
    starts, ends, before = space_words(low, offsets)
    low, starts, ends = respaced(low, starts, ends)
    at, to, owner = _shingles(starts, ends, before, size)
    votes = np.zeros((len(texts), 64), np.int64)
    for i in range(0, len(at), VOTES):
        part = xxh64(low, at[i : i + VOTES], to[i : i + VOTES])
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[i : i + VOTES]
        heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        votes[own[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    total = np.bincount(owner, minlength=len(texts))
    on = (votes * 2 > total[:, None]).astype(np.uint8)
    return np.packbits(on, axis=1, bitorder="little").view("<i8").reshape(-1)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``k_id, k_th, doc_id, fp`` of every row; a text without words (or NULL) has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                fp = pa.array(simhash_batch(part.column("text"), size), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("k_id"), part.column("k_th"), part.column("doc_id"), fp], ["k_id", "k_th", "doc_id", "fp"]
                )

    rows = docs.select(*doc_key(id_col, text_col), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "k_id long, k_th long, doc_id long, fp long")


def unary_counts(fp: Column) -> Column:
    """Ones of each two-bit segment, in unary."""
    one, other = fp.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW))
    return one.bitwiseOR(other).bitwiseOR(F.shiftleft(one.bitwiseAND(other), 1))


def cells(fp: Column) -> Column:
    """The 20 grid cells of a fingerprint, one for each choice of three axis groups."""
    masks = [0] * GROUPS
    for axis in range(32):
        masks[axis % GROUPS] |= 3 << (2 * axis)
    counts = unary_counts(fp)
    keys = [
        F.xxhash64(F.lit(i), counts.bitwiseAND(F.lit(signed(reduce(int.__or__, chosen)))))
        for i, chosen in enumerate(combinations(masks, GROUPS - MAX_BITS))
    ]
    return F.array(*keys)


def _unary(x: np.ndarray) -> np.ndarray:
    one, other = x & np.uint64(LOW), (x >> np.uint64(1)) & np.uint64(LOW)
    return one | other | ((one & other) << np.uint64(1))


def forest(a: np.ndarray, b: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Rows (node, root) that connect what links within ``limit`` bits connect between the two blocks."""
    a, b = a.view(np.uint64), b.view(np.uint64)
    near = np.bitwise_count(_unary(a)[:, None] ^ _unary(b)[None, :]) <= limit
    i, j = np.nonzero(near)
    exact = np.bitwise_count(a[i] ^ b[j]) <= limit
    i, j = i[exact], j[exact]
    other = a[i] != b[j]
    i, j = i[other], j[other]
    if not len(i):
        return np.zeros((0, 2), np.int64)
    nodes, places = np.unique(np.concatenate([a[i], b[j]]), return_inverse=True)
    left, right = places[: len(i)], places[len(i) :]
    root = np.arange(len(nodes))
    while True:
        new = root.copy()
        np.minimum.at(new, left, root[right])
        np.minimum.at(new, right, root[left])
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return np.stack([nodes[moved].view(np.int64), nodes[root[moved]].view(np.int64)], axis=1)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return column.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(column.value_lengths().to_numpy())]

    for batch in batches:
        (a, at_a), (b, at_b) = flat(batch.column(0)), flat(batch.column(1))
        found = [forest(a[at_a[k] : at_a[k + 1]], b[at_b[k] : at_b[k + 1]]) for k in range(batch.num_rows)]
        rows = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["a", "b"])


def linked(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``node, root`` of all distinct fingerprints ``fp`` that have a link."""
    keys = nodes.select("fp", F.explode(cells(F.col("fp"))).alias("cell"))
    crowded = keys.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    placed = keys.join(crowded, "cell").select("cell", "fp", F.ceil(F.col("n") / block).alias("blocks"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64(F.lit(7), "fp"), F.col("blocks")))
    groups = settle(placed.groupBy("cell", "blocks", "block").agg(F.collect_list("fp").alias("a")), "cells")
    alone = groups.where("blocks = 1").select("a", F.col("a").alias("b"))
    many = groups.where("blocks > 1")
    left = many.select("cell", "a", F.explode(F.sequence("block", F.col("blocks") - 1)).alias("other"))
    right = many.select("cell", F.col("block").alias("other"), F.col("a").alias("b"))
    crossed = left.join(right, ["cell", "other"]).select("a", "b").repartition(F.xxhash64("a", "b"))
    return components(alone.union(crossed).mapInArrow(_forests, "a long, b long"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``k_id, k_th, doc_id, fp, root, component_id`` of every row; ``root`` is a fingerprint that names the component.

    Texts are joined at three or fewer differing bits, and so on from text to text; ``component_id`` is the smallest id
    reachable (NULL where no member has an id). NULL, empty and blank texts have fingerprint zero and
    are linked like any other; repeated rows share their component; an empty table gives no row. Only
    the two named columns are read.
    """
    rows = settle(fingerprints(docs, id_col, text_col, size), "simhash")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = linked(nodes.select("fp"))
    member = roots.join(nodes, F.col("node") == F.col("fp")).select("fp", "root", "least")
    smallest = member.groupBy("root").agg(F.min("least").alias("component_id"))
    joined = member.join(smallest, "root").select("fp", "root", "component_id")
    owner = nodes.join(joined, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id")
    )
    # a table of its own, so that Spark can split a fingerprint that many rows share
    return rows.join(settle(owner, "components"), "fp").select("k_id", "k_th", "doc_id", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, the one with the smallest id (then the smallest text hash); NULL ids come first.

    NULL, empty and blank texts are near copies of each other; of repeated rows one stays; an empty table gives no row. All
    columns are kept.
    """
    found = simhash_components(docs, id_col, text_col)
    first = found.groupBy("root").agg(F.min(F.struct("k_id", "k_th")).alias("k")).select("k.k_id", "k.k_th")
    kept = packed(docs, id_col, text_col).join(first, ["k_id", "k_th"], "left_semi")
    return unpacked(kept.groupBy("k_id", "k_th").agg(F.first("row").alias("row")))
