"""Materialising marts: increments, upserts, partitioned export, views."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import ExitStack, contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators.exprs import small_side
from ledgermill.session import freed_shuffles, run_dir

PARTITIONS = ("part_year", "part_month")
ROWS_PER_MONTH = 100_000
ASIDE = "-aside"
INDEX = "_keys"  # Spark passes over names with an underscore when it lists the mart
INDEX_BUCKETS = 64
MERGED = "_merged"
DONE = "_SUCCESS"
CODEC = "zstd"  # hex digests, most of a transaction, take half of what they take under Spark's own choice
ROWS_PER_TURN = 2_000_000
MOST_TURNS = 8


def newer_rows(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Source rows above the target's highest value; an empty target loads everything."""
    highest = target.select(F.max(column)).scalar()
    return source.filter(highest.isNull() | (F.col(column) > highest))


def newest(rows: DataFrame, keys: Sequence[str], version: str | Column) -> DataFrame:
    """The row of each key with the highest version; versions are combined map-side."""
    columns = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), version).alias("_row"))
    return best.select(*keys, "_row.*")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with the rows of the source's keys replaced; new columns are appended.

    A small change set is broadcast, so the target is scanned but not shuffled.
    """
    replaced = small_side(source.select(*[F.col(k).alias(f"_new_{k}") for k in keys]).distinct())
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    kept = target.join(replaced, same, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def append_new(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Source rows whose key the target does not have, each key once."""
    known = target.select(F.col(key).alias("_known"))
    return source.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti").dropDuplicates([key])


def with_partitions(df: DataFrame, column: str) -> DataFrame:
    """Add ``part_year`` and ``part_month`` of a date, timestamp or ``YYYY-MM`` column."""
    clash = [c for c in PARTITIONS if c in df.columns]
    if clash:
        raise ValueError(f"Columns named like partitions: {clash}")
    if df.schema[column].dataType.typeName() == "string":
        return df.withColumns(
            dict(zip(PARTITIONS, (F.substring(column, 1, 4).cast("int"), F.substring(column, 6, 2).cast("int"))))
        )
    return df.withColumns(dict(zip(PARTITIONS, (F.year(column), F.month(column)))))


def partition_column(df: DataFrame) -> str | None:
    """The column that tells a mart's year and month: a date, or ``month`` as ``YYYY-MM`` or date; None without one."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    calendar = ("date", "timestamp", "timestamp_ntz")
    for name, allowed in (("date", calendar), ("month", (*calendar, "string")), ("transaction_date", calendar)):
        if kinds.get(name) in allowed:
            return name
    return None


def export_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> list[str]:
    """Write a mart partitioned by year and month of its ``partition_column``, all its columns untouched.

    The rebalance hint lets AQE write few files per partition and still split a
    partition that is much larger than the others.
    """
    column = partition_column(df)
    if column is None:
        df.write.mode(mode).parquet(path)
        return []
    keyed = with_partitions(df, column).hint("rebalance", *PARTITIONS)
    keyed.write.mode(mode).partitionBy(*PARTITIONS).parquet(path)
    return list(PARTITIONS)


def export_mart(df: DataFrame, path: str, least_rows: int = ROWS_PER_MONTH) -> list[str]:
    """Write a mart as it is; one with ``least_rows`` rows a month or more is then dealt out by year and month.

    A folder and a file for each month of a small mart cost more at every reading than they save. Rows and months
    are counted while the mart is written, so nothing is computed twice; a large mart is read once more from its files.
    """
    column = partition_column(df)
    if column is None:
        return export_parquet(df, path)
    keyed = with_partitions(df, column)
    seen = Observation()
    month = F.col(PARTITIONS[0]) * 12 + F.col(PARTITIONS[1])
    counted = keyed.observe(seen, F.count("*").alias("rows"), F.min(month).alias("first"), F.max(month).alias("last"))
    aside = f"{path}{ASIDE}"
    counted.drop(*PARTITIONS).hint("rebalance").write.mode("overwrite").parquet(aside)
    found = seen.get
    months = found["last"] - found["first"] + 1 if found["last"] is not None else 1
    if found["rows"] >= least_rows * months:
        return export_parquet(df.sparkSession.read.parquet(aside), path)
    move(df.sparkSession, aside, path)
    return []


def export_marts(marts: Mapping[str, DataFrame], base: str, least_rows: int = ROWS_PER_MONTH) -> dict[str, str]:
    """Export every mart below ``base``; their folders by name."""
    for name, df in marts.items():
        export_mart(df, f"{base}/{name}", least_rows)
    return {name: f"{base}/{name}" for name in marts}


def file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _exists(spark: SparkSession, path: str) -> bool:
    fs, folder = file_system(spark, path)
    return fs.exists(folder)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a finished folder in the place of another."""
    fs, new = file_system(spark, source)
    _, old = file_system(spark, target)
    fs.delete(old, True)
    fs.mkdirs(old.getParent())
    if not fs.rename(new, old):
        raise OSError(f"could not move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, folder = file_system(spark, path)
    fs.delete(folder, True)


@contextmanager
def settled(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """An intermediate result in the shared folder, which goes at the end: nothing lazy may read it later."""
    path = run_dir(df.sparkSession, name)
    try:
        df.write.option("compression", CODEC).parquet(path)
        yield df.sparkSession.read.parquet(path)
    finally:
        remove(df.sparkSession, path)


def stored_months(spark: SparkSession, path: str) -> list[str]:
    """Folders of an exported mart's months, newest first, that of rows without a date last; none if it is not cut by month."""
    found = []
    fs, folder = file_system(spark, path)
    for year in fs.listStatus(folder):
        if year.getPath().getName().startswith(f"{PARTITIONS[0]}="):
            for month in fs.listStatus(year.getPath()):
                values = [p.getName().split("=")[1] for p in (year.getPath(), month.getPath())]
                dated = all(v.lstrip("-").isdigit() for v in values)
                found.append((dated, [int(v) for v in values] if dated else [], month.getPath().toString()))
    return [name for *_, name in sorted(found, reverse=True)]


def export_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSS").json(path)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)


def register_views(spark: SparkSession, marts: Mapping[str, str]) -> None:
    """A temporary view per exported mart, read from its folder."""
    for name, path in marts.items():
        spark.read.option("mergeSchema", True).parquet(path).createOrReplaceTempView(name)


def summary_stats(marts: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row count and bounds (as text) per mart; ``marts`` maps a label to (frame, bound column)."""
    parts = [
        df.agg(
            F.count("*").alias("row_count"),
            F.min(bound).cast("string").alias("min_date"),
            F.max(bound).cast("string").alias("max_date"),
        ).select(F.lit(label).alias("metric"), "row_count", "min_date", "max_date")
        for label, (df, bound) in marts.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def shares(keys: Sequence[str], *frames: DataFrame | None) -> list[Column]:
    """Conditions that cut the keys of stored frames into shares, as many as their rows ask for."""
    rows = sum(df.count() for df in frames if df is not None)
    n = min(MOST_TURNS, rows // ROWS_PER_TURN + 1)
    return [F.pmod(F.xxhash64(*keys), F.lit(n)) == k for k in range(n)]


class PartitionedMart:
    """A mart stored by year and month of one column; loads touch only the partitions of their rows and keys.

    Keys that hold the column name their partition. For other keys, whose rows may move to another month, an
    index is kept with the mart: the hash of each key and every partition it was ever sent to. It is written before
    the rows, so it never lacks a place; a place too many, or two keys of one hash, cost a look and change nothing.

    Merged partitions are written aside first and then replace the stored ones. A load that dies on the way
    is mended by its replay, which reads the same index and gives the same mart.

    A load of more than ``ROWS_PER_TURN`` rows, stored ones included, takes shares of the keys in turn, so that only one
    share's shuffle is on disk; its batch, its index rows and the months aside go with it. Beside the stored months that
    leaves their copy, the batch, and a share's shuffle.
    """

    def __init__(self, spark: SparkSession, path: str, column: str):
        self.spark = spark
        self.path = path
        self.column = column

    def exists(self) -> bool:
        return any(True for _ in self._folders())

    def _folders(self):
        fs, folder = file_system(self.spark, self.path)
        if fs.exists(folder):
            yield from (s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith(PARTITIONS[0]))

    def _stored(self) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(*PARTITIONS)

    def _index(self) -> DataFrame:
        return self.spark.read.schema("part_year int, part_month int, h long, bucket int").parquet(f"{self.path}/{INDEX}")

    def _places(self, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
        h = F.xxhash64(*keys)
        return batch.select(*PARTITIONS, h.alias("h"), F.pmod(h, F.lit(INDEX_BUCKETS)).cast("int").alias("bucket")).distinct()

    def _known_places(self, places: DataFrame) -> DataFrame:
        """Index rows of the keys; a small batch lets Spark skip the other buckets."""
        keys = small_side(places.select(F.col("h").alias("_h"), F.col("bucket").alias("_bucket")).distinct())
        return self._index().join(keys, (F.col("bucket") == F.col("_bucket")) & (F.col("h") == F.col("_h")), "left_semi")

    def _note(self, batch: DataFrame, keys: Sequence[str]) -> list:
        """Note where the batch's keys go; all partitions in which they may stand, before and after."""
        if self.column in keys:
            return batch.select(*PARTITIONS).distinct().collect()
        with ExitStack() as steps:
            places = steps.enter_context(settled(self._places(batch, keys), "places"))
            touched, fresh = places.select(*PARTITIONS), places
            if _exists(self.spark, f"{self.path}/{INDEX}"):
                known = steps.enter_context(settled(self._known_places(places), "places"))
                touched = touched.union(known.select(*PARTITIONS))
                same = F.col("h") == F.col("_h")
                for c in PARTITIONS:
                    same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
                fresh = places.join(known.select(F.col("h").alias("_h"), *[F.col(c).alias(f"_{c}") for c in PARTITIONS]), same, "left_anti")
            parts = touched.distinct().collect()  # the calendar bounds their list
            fresh.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/{INDEX}")
            return parts

    def _touched(self, parts: list) -> DataFrame:
        same = [reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(p[k])) for k in PARTITIONS]) for p in parts]
        return self._stored().filter(reduce(lambda a, b: a | b, same, F.lit(False)))

    def _write_aside(self, merged: DataFrame) -> None:
        writer = merged.hint("rebalance", *PARTITIONS).write.mode("append").partitionBy(*PARTITIONS)
        writer.option("compression", CODEC).parquet(f"{self.path}/{MERGED}")

    def _publish(self, parts: list, replace: bool) -> None:
        """Put the months written aside in the place of the touched ones, of which empty ones go, or add their files to them."""
        folders = ["/".join(f"{k}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for k, v in zip(PARTITIONS, p)) for p in parts]
        for name in (*folders, DONE):
            fs, new = file_system(self.spark, f"{self.path}/{MERGED}/{name}")
            _, old = file_system(self.spark, f"{self.path}/{name}")
            if replace or name == DONE:
                fs.delete(old, True)
            if not fs.exists(new):
                continue
            fs.mkdirs(old.getParent())
            moved = [s.getPath() for s in fs.listStatus(new)] if fs.exists(old) else [new]
            for source in moved:  # a folder takes the other's place, a file goes into it
                if not fs.rename(source, old):
                    raise OSError(f"could not move {source} to {old}")
        remove(self.spark, f"{self.path}/{MERGED}")
        self.spark.catalog.refreshByPath(self.path)

    def upsert(self, source: DataFrame, keys: Sequence[str], version: Column | None = None, kept: bool = False) -> None:
        """Replace the rows of the source's keys, in whatever month they stand, and add the others.

        With ``version``, the highest of the source's rows of a key counts, and a stored row of a higher version stays.
        The source is copied first, unless it is ``kept``: rows of files that no one changes during the load.
        """
        batch = with_partitions(source, self.column)
        with freed_shuffles(self.spark), ExitStack() as steps:
            batch = batch if kept else steps.enter_context(settled(batch, "batch"))
            parts = self._note(batch, keys)
            stored = self._touched(parts) if self.exists() else None
            remove(self.spark, f"{self.path}/{MERGED}")
            for share in shares(keys, batch, stored):
                merged = batch.filter(share)
                if version is not None:
                    both = merged if stored is None else stored.filter(share).unionByName(merged, allowMissingColumns=True)
                    merged = newest(both, keys, version)
                elif stored is not None:
                    merged = upsert(stored.filter(share), merged, keys)
                self._write_aside(merged)
            self._publish(parts, replace=True)

    def append(self, source: DataFrame, key: str) -> None:
        """Add the rows whose key is not stored yet, in whatever month."""
        with freed_shuffles(self.spark), settled(with_partitions(source, self.column), "batch") as batch:
            parts = self._note(batch, [key])
            stored = self._touched(parts).select(key) if self.exists() else None
            remove(self.spark, f"{self.path}/{MERGED}")
            for share in shares([key], batch, stored):
                fresh = batch.filter(share)
                self._write_aside(fresh.dropDuplicates([key]) if stored is None else append_new(stored.filter(share), fresh, key))
            self._publish(parts, replace=False)

    def newer(self, source: DataFrame) -> DataFrame:
        """Source rows above the highest stored value, which is looked up in the last partition only."""
        if not self.exists():
            return source
        stored = self._stored()
        last = stored.select(*PARTITIONS).filter(F.col(PARTITIONS[0]).isNotNull()).agg(F.max(F.struct(*PARTITIONS)).alias("p")).first()["p"]
        if last is None:
            return source
        in_last = stored.filter(reduce(lambda a, b: a & b, [F.col(k) == last[k] for k in PARTITIONS]))
        return newer_rows(source, in_last, self.column)


class VersionedTable:
    """A mart kept as numbered Parquet folders; the newest finished one is current.

    A folder counts as finished once it holds Spark's ``_SUCCESS`` file, so a job
    that dies half-way leaves the current version untouched.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _versions(self, finished: bool) -> list[int]:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(self.path)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        found = [int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit()]
        if finished:
            found = [v for v in found if fs.exists(hadoop.Path(f"{self._folder(v)}/_SUCCESS"))]
        return sorted(found)

    def _folder(self, version: int) -> str:
        return f"{self.path}/v{version:08d}"

    def exists(self) -> bool:
        return bool(self._versions(finished=True))

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self._folder(self._versions(finished=True)[-1]))

    def replace(self, df: DataFrame) -> int:
        """Write a new version. It never overwrites a folder it may be reading from."""
        version = max(self._versions(finished=False), default=0) + 1
        df.write.parquet(self._folder(version))
        return version
