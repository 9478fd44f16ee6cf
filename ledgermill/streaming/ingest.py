"""Continuous ingest of contract records into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgermill.operators.contract import split_valid
from ledgermill.operators.materialize import CODEC, move, newest, remove, settled, shares
from ledgermill.schemas import RAW_TRANSACTION
from ledgermill.session import freed_shuffles
from ledgermill.streaming import compaction

ARRIVAL = "_arrival"


def arrival() -> Column:
    """When a record's file came, and its name for files of the same instant."""
    return F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("file"))


def read_records(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_TRANSACTION)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path).withColumn(ARRIVAL, arrival())


def run_ingest(
    spark: SparkSession,
    path: str,
    target: str,
    quarantine: str,
    checkpoint: str,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Ingest all files that are there now, then stop.

    No record is dropped, however late: a micro-batch keeps the newest version of each key
    that it holds, and ``current_rows`` takes the newest over all batches, so there is no state to bound. Records that
    break the contract go to the quarantine with their reasons. A micro-batch writes only its own
    folders, so its cost does not grow with the table, and a batch that is replayed after a failure replaces itself.
    Its records are parsed once, and shares of the keys of a large one are taken in turn, as when a mart is loaded.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder, aside = f"{target}/{compaction.BATCH}={batch_id}", f"{target}/_{compaction.BATCH}={batch_id}"
        with freed_shuffles(batch.sparkSession), settled(batch, "records") as records:
            valid, broken = split_valid(records)
            remove(spark, aside)
            for share in shares(["txn_id"], records):
                newest(valid.filter(share), ["txn_id"], ARRIVAL).write.mode("append").option("compression", CODEC).parquet(aside)
            move(spark, aside, folder)
            broken.drop(ARRIVAL).write.mode("overwrite").parquet(f"{quarantine}/{compaction.BATCH}={batch_id}")

    return (
        read_records(spark, path, files_per_trigger)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _version() -> Column:
    return F.struct(ARRIVAL, compaction.BATCH)


def current_rows(spark: SparkSession, target: str, keys: Sequence[str] = ("txn_id",)) -> DataFrame:
    """The newest version of every key, from the merged base and the batches since."""
    rows = compaction.newest_rows(spark, target, list(keys), _version(), "posted_at")
    return rows.drop(ARRIVAL, compaction.BATCH)


def merge_batches(spark: SparkSession, target: str, keys: Sequence[str] = ("txn_id",)) -> int:
    """Merge all finished batches into the base by month; the last batch merged."""
    return compaction.compact(spark, target, list(keys), _version(), "posted_at")


def batch_twin(records: DataFrame) -> DataFrame:
    """What the stream has ingested once all records have arrived; ``records`` are read from files."""
    valid, _ = split_valid(records.withColumn(ARRIVAL, arrival()))
    return newest(valid, ["txn_id"], ARRIVAL).drop(ARRIVAL)
