"""Approximate nearest neighbours by cross-polytope hashing.

A table rotates a unit vector by three rounds of random signs and a fast Hadamard transform and takes its largest coordinate,
with sign. A table joins the axes of ``JOINED`` rotations to one key: all but the last name the group, the last one the bucket
in it. A query first probes the ``FIRST`` joint keys of the highest sums of coordinates in each table, then as many more as the
angle of the nearest that it found asks for (``wanted``): the nearer they are, the fewer. No step asks how many rows there are, so a
query that finds the same neighbours is answered alike in a table of any size. A block compares each query with the
vectors in the buckets that it probes, exactly and in double precision, and returns the nearest few. Buckets of a group share blocks of about
``BLOCK`` vectors, larger buckets and more than ``BLOCK`` probing queries are cut; that is layout and changes no result. A
query that finds too few candidates is compared with all vectors, in blocks.

Equal vectors are one class in the tables; a class keeps its smallest ids, as many as one result can hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.textops import spread
from ledgermill.session import settle

TABLES = 16
PROBES = 16  # of single axes
JOINT_PROBES = 256  # of pairs of axes, where the nearest are as far as those of BLOCK random vectors
JOINED = 2  # rotations
FIRST = 16  # joint keys that every query probes
NEAREST = 10
BLOCK = 2048
SEED = 17
CLASS = ["c1", "c2"]


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = rows.shape
    rows, half = rows.copy(), 1
    while half < d:
        pairs = rows.reshape(n, d // (2 * half), 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, d)
        half *= 2
    return rows / np.sqrt(d)


def width(dim: int) -> int:
    return 1 << max(dim - 1, 0).bit_length()


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares of huge or tiny components stay finite
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def rotated(vectors: np.ndarray, place: int) -> np.ndarray:
    """Pseudo-random rotation ``place`` of the unit vectors, padded to a power of two."""
    unit = units(vectors)
    d = width(vectors.shape[1])
    out = np.zeros((len(unit), d))
    out[:, : unit.shape[1]] = unit
    signs = np.random.default_rng([SEED, place, d]).choice([-1.0, 1.0], (3, d))
    for s in signs:
        out = hadamard(out * s)
    return out


def plan(classes: int, dim: int) -> tuple[int, int]:
    """Rotations that a table of so many random vectors could join, and joint keys that a query would probe in it.

    For estimates only: the search does not ask for the number of vectors. Probes fall with the cube root of the number of vectors. Each further rotation makes keys 2 x width times as many and probes
    sixteen times.
    """
    joined, axes = 1, 2 * width(dim)
    while classes > BLOCK * axes ** (joined - 1):
        joined += 1
    if joined == 1:
        return 1, min(PROBES, axes)
    probes = JOINT_PROBES * (BLOCK / classes) ** (1 / 3) * axes ** ((joined - 2) / 3) * 16 ** (joined - 2)
    return joined, min(max(round(probes), 1), axes**joined)


def wanted(cosines: np.ndarray, dim: int) -> np.ndarray:
    """Joint keys that a query probes in each table if the last of the nearest that it found has this cosine.

    Among as many random directions as ``NEAREST`` over the share of the sphere within that angle, the nearest would be as near; probes fall
    with the cube root of that number.
    """
    angles = np.linspace(0, np.pi, 4097)
    share = np.cumsum(np.sin(angles) ** max(dim - 2, 0))
    near = np.interp(np.arccos(np.clip(cosines, -1, 1)), angles, share / share[-1])
    probes = JOINT_PROBES * (BLOCK * near / NEAREST) ** (1 / 3)
    return np.clip(np.round(probes), 1, (2 * width(dim)) ** JOINED).astype(np.int64)


def signed_axes(vectors: np.ndarray, place: int) -> np.ndarray:
    """Coordinate of each signed axis (2 x axis, + 1 if negative) after rotation ``place``."""
    turned = rotated(vectors, place)
    return np.stack([turned, -turned], axis=2).reshape(len(turned), -1)


def joint_keys(vectors: np.ndarray, table: int, joined: int, probes: int) -> np.ndarray:
    """The ``probes`` joint keys of a table with the highest sums of coordinates, best first."""
    keys, sums = np.zeros((len(vectors), 1), np.int64), np.zeros((len(vectors), 1))
    for r in range(joined):
        score = signed_axes(vectors, table * joined + r)
        axes = score.shape[1]
        best = np.argsort(-score, axis=1, kind="stable")[:, : min(axes, probes)]
        both = (sums[:, :, None] + np.take_along_axis(score, best, axis=1)[:, None, :]).reshape(len(vectors), -1)
        order = np.argsort(-both, axis=1, kind="stable")[:, :probes]
        keys = np.take_along_axis(keys, order // best.shape[1], axis=1) * axes + np.take_along_axis(best, order % best.shape[1], axis=1)
        sums = np.take_along_axis(both, order, axis=1)
    return keys


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec, dim, c1, c2``: rows that take part, once each, with the class of their vector."""
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double") + F.lit(0.0))  # -0.0 becomes 0.0
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where("id is not null and size(vec) > 0")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~F.coalesce(bad, F.lit(True))).where(F.exists("vec", lambda x: x != 0))
    return rows.withColumns({"dim": F.size("vec"), "c1": F.xxhash64("vec"), "c2": F.xxhash64(F.lit(SEED), F.reverse("vec"))})


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _indexed(rows: DataFrame) -> DataFrame:
    """Every class under its own key in each table: ``place``, the group ``bucket``, and ``fine`` in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                vectors, axes = _matrix(part.column("vec")), 2 * width(int(dim))
                keys = np.concatenate([joint_keys(vectors, t, JOINED, 1) for t in range(TABLES)], axis=1)
                offsets = pa.array(np.arange(0, keys.size + 1, TABLES, dtype=np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x.reshape(-1))) for x in (keys // axes, keys % axes)]
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], *lists], [*names, "buckets", "fines"])

    names = [*CLASS, "least", "dim", "vec"]
    return rows.select(*names).mapInArrow(run, "c1 long, c2 long, least long, dim int, vec array<double>, buckets array<long>, fines array<long>")


def _probing(rows: DataFrame) -> DataFrame:
    """One row for each group that a query probes, with the buckets in it: its first keys, or those after them if it has a ``cosine``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                probes = np.full(len(own), FIRST)
                if "cosine" in batch.schema.names:
                    probes = wanted(batch.column("cosine").to_numpy()[own], dim)
                skip = FIRST if "cosine" in batch.schema.names else 0
                order = np.argsort(probes, kind="stable")
                own, probes, axes = own[order], probes[order], 2 * width(dim)
                for start in range(0, len(own), 32):
                    some, most = own[start : start + 32], probes[start : start + 32]
                    part = batch.take(pa.array(some))
                    vectors = _matrix(part.column("vec"))
                    owner, place, bucket, fines = [], [], [], []
                    for t in range(TABLES):
                        for k, best in enumerate(joint_keys(vectors, t, JOINED, int(most.max()))):
                            keys = np.sort(best[skip : most[k]])
                            groups, first = np.unique(keys // axes, return_index=True)
                            owner += [k] * len(groups)
                            place += [t] * len(groups)
                            bucket += groups.tolist()
                            fines += [x.tolist() for x in np.split(keys % axes, first[1:])] if len(groups) else []
                    kept = [part.column(n).take(pa.array(owner, pa.int64())) for n in ("c1", "c2", "dim", "vec")]
                    types = (pa.int32(), pa.int64(), pa.list_(pa.int64()))
                    made = [pa.array(x, t) for x, t in zip((place, bucket, fines), types)]
                    yield pa.RecordBatch.from_arrays([*kept, *made], ["q1", "q2", "dim", "vec", "place", "bucket", "fines"])

    return rows.mapInArrow(run, "q1 long, q2 long, dim int, vec array<double>, place int, bucket long, fines array<long>")


def _nearest(index: pa.Table, probes: pa.Table) -> pa.Table:
    """The nearest classes of one block for each query that probes it."""
    found: list[list[np.ndarray]] = [[], [], [], [], [], [], []]
    if index.num_rows and probes.num_rows:
        index, probes = index.combine_chunks(), probes.combine_chunks()
        have, ask = (_matrix(t.column("vec").combine_chunks()) for t in (index, probes))
        c1, c2, least, fine = (index.column(n).to_numpy() for n in ("c1", "c2", "least", "fine"))
        order = np.argsort(fine, kind="stable")
        ranked, asked, turned, facing = fine[order], probes.column("fines").to_pylist(), units(have), units(ask)
        for q1, q2, vector, facing_to, fines in zip(probes.column("q1").to_pylist(), probes.column("q2").to_pylist(), ask, facing, asked):
            fines = np.sort(fines)
            low, high = np.searchsorted(ranked, fines), np.searchsorted(ranked, fines, side="right")
            rows = order[spread(low, high - low)]
            if not len(rows):
                continue
            with np.errstate(over="ignore"):
                row = np.sqrt(((have[rows] - vector) ** 2).sum(axis=1))
            if len(row) > NEAREST:
                some = np.flatnonzero(row <= np.partition(row, NEAREST)[NEAREST])
                rows, row = rows[some], row[some]
            near = np.lexsort((least[rows], row))[: NEAREST + 1]
            rows, row = rows[near], row[near]
            cells = (np.full(len(row), q1), np.full(len(row), q2), c1[rows], c2[rows], least[rows], row, turned[rows] @ facing_to)
            for column, values in zip(found, cells):
                column.append(values)
    arrays = [np.concatenate(c) if c else np.zeros(0) for c in found]
    types = [pa.int64()] * 5 + [pa.float64()] * 2
    names = ["q1", "q2", "c1", "c2", "least", "score", "cosine"]
    return pa.table([pa.array(a, t, from_pandas=False) if len(a) else pa.array([], t) for a, t in zip(arrays, types)], names)


def _search(index: DataFrame, asked: DataFrame) -> DataFrame:
    """``q1, q2, c1, c2, least, score, cosine``: nearest classes that the queries' probes meet; blocks bound both sides."""
    spot = ["dim", "place", "bucket"]
    asked = settle(asked, "probes")
    placed = index.select(*CLASS, "least", "dim", "vec", F.posexplode(F.arrays_zip("buckets", "fines")).alias("place", "x"))
    placed = placed.select(*CLASS, "least", "dim", "vec", "place", F.col("x.buckets").alias("bucket"), F.col("x.fines").alias("fine"))
    # neighbouring buckets share a block of about BLOCK vectors; one with more is cut by the class
    counts = placed.groupBy(*spot, "fine").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*spot).orderBy("fine")) - F.col("n")
    buckets = counts.select(*spot, "fine", F.floor(before / BLOCK).alias("slice"), F.ceil(F.col("n") / BLOCK).alias("cuts"))
    buckets = settle(buckets, "buckets")
    wide = asked.withColumn("fine", F.explode("fines")).drop("fines").join(buckets, [*spot, "fine"])
    every = asked.where("fines IS NULL").join(buckets, spot).drop("fines").select(wide.columns)
    cuts = F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)
    wide = wide.union(every).withColumn("cut", F.explode(cuts))
    wide = wide.groupBy("q1", "q2", *spot, "slice", "cut").agg(F.first("vec").alias("vec"), F.collect_list("fine").alias("fines"))
    wide = settle(wide, "asked")
    block = [*spot, "slice", "cut"]
    parts = settle(wide.groupBy(*block).agg(F.ceil(F.count("*") / BLOCK).alias("parts")), "blocks")  # blocks that no query probes are left out
    placed = placed.join(buckets, [*spot, "fine"]).withColumn("cut", F.pmod("c1", F.col("cuts"))).join(parts, block)
    placed = placed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    wide = wide.join(parts, block).withColumn("part", F.pmod("q1", F.col("parts")))
    left = placed.select(*block, "part", *CLASS, "least", "vec", "fine").groupBy(*block, "part")
    right = wide.select(*block, "part", "q1", "q2", "vec", "fines").groupBy(*block, "part")
    return left.cogroup(right).applyInArrow(_nearest, "q1 long, q2 long, c1 long, c2 long, least long, score double, cosine double")


def _asking_all(index: DataFrame, queries: DataFrame) -> DataFrame:
    """Every group of the first table, whole (no list of buckets), for each query."""
    groups = index.select("dim", F.col("buckets")[0].alias("bucket")).distinct()
    rows = queries.select(F.col("c1").alias("q1"), F.col("c2").alias("q2"), "dim", "vec").join(groups, "dim")
    return rows.select("q1", "q2", "dim", "vec", F.lit(0).alias("place"), "bucket", F.lit(None).cast("array<long>").alias("fines"))


def _reached(met: DataFrame) -> DataFrame:
    """``c1, c2, cosine`` of a query class: the least cosine of the nearest classes that it met; NULL if they are too few."""
    once = met.groupBy("q1", "q2", "c1", "c2", "least").agg(F.min("score").alias("score"), F.min("cosine").alias("cosine"))
    by_class = Window.partitionBy("q1", "q2").orderBy("score", "least")
    best = once.withColumn("n", F.row_number().over(by_class)).where(F.col("n") <= NEAREST + 1)
    all_of = best.groupBy(F.col("q1").alias("c1"), F.col("q2").alias("c2")).agg(F.count("*").alias("n"), F.min("cosine").alias("cosine"))
    return all_of.select(*CLASS, F.when(F.col("n") > NEAREST, F.col("cosine")).alias("cosine"))


def _answers(met: DataFrame, members: DataFrame, queries: DataFrame) -> DataFrame:
    """``query_id, rank, vec_id, score`` from the classes each query class met."""
    once = met.groupBy("q1", "q2", "c1", "c2", "least").agg(F.min("score").alias("score"))
    by_class = Window.partitionBy("q1", "q2").orderBy("score", "least")
    best = once.withColumn("n", F.row_number().over(by_class)).where(F.col("n") <= NEAREST + 1).drop("n", "least")
    rows = best.join(members, CLASS).select("q1", "q2", F.col("id").alias("vec_id"), "score")
    by_row = Window.partitionBy("q1", "q2").orderBy("score", "vec_id")
    rows = rows.withColumn("n", F.row_number().over(by_row)).where(F.col("n") <= NEAREST + 1).drop("n")
    listed = rows.groupBy("q1", "q2").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    asked = queries.select(F.col("id").alias("query_id"), F.col("c1").alias("q1"), F.col("c2").alias("q2"))
    others = asked.join(listed, ["q1", "q2"]).withColumn("near", F.filter("near", lambda x: x["vec_id"] != F.col("query_id")))
    ranked = others.select("query_id", F.posexplode(F.slice("near", 1, NEAREST)).alias("at", "x"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``NEAREST`` rows found nearest to each query row, by Euclidean distance.

    ``is_query`` is a condition on ``id``. Ties go to the smaller id. Rows with a NULL id, and vectors that are
    NULL, empty, zero or hold NULL or non-finite components, take no part; vectors meet those of
    equal length only; rows equal in id and vector count once; a query without another row gets no line.
    """
    rows = settle(usable(vectors, id_col, vec_col).dropDuplicates(["id", "c1", "c2"]), "vectors")
    first = Window.partitionBy(*CLASS).orderBy("id")
    members = rows.select("id", *CLASS).withColumn("n", F.row_number().over(first)).where(F.col("n") <= NEAREST + 1).drop("n")
    classes = rows.groupBy(*CLASS, "dim").agg(F.min("id").alias("least"), F.first("vec").alias("vec"))
    classes = settle(classes, "classes")
    index = settle(_indexed(classes), "index")
    queries = rows.where(is_query).select("id", *CLASS, "dim")
    asked = index.join(queries.select(*CLASS).distinct(), CLASS, "left_semi").select(*CLASS, "dim", "vec")
    met = settle(_search(index, _probing(asked)), "met")
    again = asked.join(_reached(met), CLASS, "left").withColumn("cosine", F.coalesce("cosine", F.lit(-1.0)))
    met = met.union(settle(_search(index, _probing(again)), "met"))
    found = settle(_answers(met, members, queries), "answers")
    there = rows.groupBy("dim").agg(F.count("*").alias("rows"))
    had = queries.join(found.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("had")), "id", "left")
    few = had.join(there, "dim").where(F.coalesce("had", F.lit(0)) < F.least(F.lit(NEAREST), F.col("rows") - 1))
    short = settle(few.select("id", *CLASS), "short")
    if short.isEmpty():
        return found
    again = index.join(short.select(*CLASS).distinct(), CLASS, "left_semi")
    whole = _answers(settle(_search(index, _asking_all(index, again)), "met"), members, short)
    kept = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti")
    return kept.union(whole.select(*kept.columns))
