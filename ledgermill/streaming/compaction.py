"""Merging the folders of finished micro-batches into one table stored by month.

The base below ``<target>/_base`` holds the newest version of each key, partitioned by year and month. A marker
``<target>/_merged/<n>`` says that batches up to n are in it; it is made last, by one call. Until then readers
take those batches from their own folders, so a merge that dies on the way hides nothing, and its replay
changes nothing. Reading costs the live rows and the few batches since the last merge.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators.exprs import small_side
from ledgermill.operators.materialize import PartitionedMart, file_system
from ledgermill.operators.materialize import newest as newest_of
from ledgermill.session import settle

BATCH = "batch_id"


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def finished_batches(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the batches whose folder is complete."""
    found = [int(n.removeprefix(f"{BATCH}=")) for n in _names(spark, target) if n.startswith(f"{BATCH}=")]
    fs, folder = file_system(spark, target)
    complete = [n for n in found if "_SUCCESS" in _names(spark, f"{target}/{BATCH}={n}")]
    return sorted(complete)


def merged_until(spark: SparkSession, target: str) -> int:
    """The last batch that the base holds; -1 before the first merge."""
    return max((int(n) for n in _names(spark, f"{target}/_merged")), default=-1)


def _batches(spark: SparkSession, target: str, numbers: Sequence[int]) -> DataFrame:
    return spark.read.option("basePath", target).option("mergeSchema", True).parquet(*[f"{target}/{BATCH}={n}" for n in numbers])


def _base(spark: SparkSession, target: str, column: str) -> PartitionedMart:
    return PartitionedMart(spark, f"{target}/_base", column)


def compact(spark: SparkSession, target: str, keys: Sequence[str], version: Column, column: str) -> int:
    """Merge all finished batches into the base, the newest version of a key winning; the last batch merged.

    Only the months of the batches' rows, and those in which their keys stood before, are written again. The batches'
    folders stay as they are meanwhile, so their rows are not copied.
    """
    done = merged_until(spark, target)
    fresh = [n for n in finished_batches(spark, target) if n > done]
    if not fresh:
        return done
    _base(spark, target, column).upsert(_batches(spark, target, fresh), keys, version, kept=True)
    fs, marker = file_system(spark, f"{target}/_merged/{fresh[-1]}")
    fs.mkdirs(marker)
    return fresh[-1]


def discard_merged(spark: SparkSession, target: str) -> int:
    """Remove the folders of batches that the base holds, once no reader of theirs is left; how many there were."""
    done = merged_until(spark, target)
    gone = [n for n in finished_batches(spark, target) if n <= done]
    for n in gone:
        fs, folder = file_system(spark, f"{target}/{BATCH}={n}")
        fs.delete(folder, True)
    return len(gone)


def newest_rows(spark: SparkSession, target: str, keys: Sequence[str], version: Column, column: str) -> DataFrame:
    """The newest version of every key: the base, corrected by the batches since the last merge."""
    done = merged_until(spark, target)
    fresh = [n for n in finished_batches(spark, target) if n > done]
    if done < 0:
        return newest_of(_batches(spark, target, fresh), keys, version)
    base = _base(spark, target, column).read()
    if not fresh:
        return base
    changed = settle(newest_of(_batches(spark, target, fresh), keys, version), "changed")
    known = small_side(changed.select(*[F.col(k).alias(f"_{k}") for k in keys]))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    contested = base.join(known, same, "left_semi").unionByName(changed, allowMissingColumns=True)
    return base.join(known, same, "left_anti").unionByName(newest_of(contested, keys, version), allowMissingColumns=True)
