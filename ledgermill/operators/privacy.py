"""Redaction, PII scans and the audit trail as table jobs."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions import pii
from ledgermill.operators.materialize import file_system


def redact_columns(df: DataFrame, columns: list[str], log_style: bool = False) -> DataFrame:
    redact = pii.redact_log if log_style else pii.redact
    return df.withColumns({c: redact(F.col(c)) for c in columns})


def pii_scan(df: DataFrame, text: str, group: str) -> DataFrame:
    """Rows with at least one match, per pattern and group."""
    hits = [F.count(F.when(F.col(text).rlike(p), 1)).alias(kind) for kind, p in pii.PII_PATTERNS.items()]
    return df.groupBy(group).agg(F.count("*").alias("rows"), *hits)


def audit_trail(events: DataFrame, user_id: str | None = None) -> DataFrame:
    """Audit events, optionally of one user."""
    return events if user_id is None else events.filter(F.col("user_id") == user_id)


class AuditLog:
    """Audit events as folders that are appended to, each exactly once by the caller's token.

    A token names the batch (a load, a day, a request). Spark's ``_SUCCESS`` file, written last, commits its folder; one
    without it is not read, and is written anew when the token comes again.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _committed(self, folder: str) -> bool:
        fs, marker = file_system(self.spark, f"{self.path}/{folder}/_SUCCESS")
        return fs.exists(marker)

    def append(self, events: DataFrame, token: str) -> bool:
        """Store a batch; False, and nothing done, if its token is there already."""
        folder = f"batch={hashlib.sha256(token.encode()).hexdigest()}"
        if self._committed(folder):
            return False
        events.write.mode("overwrite").parquet(f"{self.path}/{folder}")
        return True

    def read(self) -> DataFrame:
        """All committed events."""
        fs, folder = file_system(self.spark, self.path)
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        found = [f"{self.path}/{n}" for n in sorted(names) if n.startswith("batch=") and self._committed(n)]
        if not found:
            raise ValueError(f"no audit events below {self.path}")
        return self.spark.read.option("mergeSchema", True).parquet(*found)


def audit_counts(events: DataFrame) -> DataFrame:
    """Events per user and action, split by outcome."""
    return events.groupBy("user_id", "action").agg(
        F.count("*").alias("events"),
        F.count(F.when(F.col("success"), 1)).alias("succeeded"),
        F.count(F.when(~F.col("success"), 1)).alias("failed"),
        F.max("timestamp").alias("last_seen"),
    )
