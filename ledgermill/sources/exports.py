"""CSV exports of banks and cards, by column-mapping spec.

An institution is described by an ``ExportSpec``; adding one to ``SPECS`` is the
way to support another export.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions import clean, hashing
from ledgermill.operators.materialize import file_system
from ledgermill.reference_data import local_rows

CORRUPT = "_corrupt"
LISTERS = 16
REQUIRED = ("posted_at", "amount", "merchant_raw", "description")
FAILURES = T.StructType([T.StructField(c, T.StringType()) for c in ("institution", "file", "reason")])
OPTIONAL = ("mcc", "category_raw", "city", "state", "country", "currency", "balance_after", "account_id")


@dataclass(frozen=True)
class ExportSpec:
    """``mapping`` lists, per target column, the export columns to try in order."""

    institution: str
    columns: Sequence[str]
    mapping: Mapping[str, Sequence[str]]
    file_words: Sequence[str] = ()
    is_credit: bool = False
    source: str = "bank"
    defaults: Mapping[str, str] = field(default_factory=dict)


_STATEMENT = {
    "posted_at": ["Date"],
    "merchant_raw": ["Description"],
    "amount": ["Amount"],
    "description": ["Type"],
    "balance_after": ["Balance"],
}
_STATEMENT_COLUMNS = ["Date", "Description", "Amount", "Type", "Balance"]

# Export headers and their meaning per institution.
SPECS = {
    "chase": ExportSpec(
        "Chase",
        ["Transaction Date", "Post Date", "Description", "Category", "Type", "Amount", "Memo"],
        {
            "posted_at": ["Transaction Date", "Post Date"],
            "merchant_raw": ["Description"],
            "category_raw": ["Category"],
            "description": ["Memo", "Type"],
            "amount": ["Amount"],
        },
        ["chase"],
    ),
    "amex": ExportSpec(
        "American Express",
        ["Date", "Description", "Category", "Amount", "Reference"],
        {
            "posted_at": ["Date"],
            "merchant_raw": ["Description"],
            "category_raw": ["Category"],
            "amount": ["Amount"],
            "description": ["Reference"],
        },
        ["amex", "american_express"],
        is_credit=True,
        source="card",
    ),
    "bank_of_america": ExportSpec("Bank of America", _STATEMENT_COLUMNS, _STATEMENT, ["bank_of_america"]),
    "wells_fargo": ExportSpec("Wells Fargo", _STATEMENT_COLUMNS, _STATEMENT, ["wells_fargo"]),
    "generic": ExportSpec(
        "Unknown",
        ["Date", "Description", "Amount", "Category"],
        {
            "posted_at": ["Date"],
            "merchant_raw": ["Description"],
            "amount": ["Amount"],
            "category_raw": ["Category"],
        },
        defaults={"description": ""},
    ),
}


def spec_for(file_name: str) -> ExportSpec:
    """The spec whose word occurs in the file name; anything else is generic."""
    name = file_name.lower()
    for spec in SPECS.values():
        if any(word in name for word in spec.file_words):
            return spec
    return SPECS["generic"]


@dataclass(frozen=True)
class Ingest:
    """Valid transactions (one per txn_id), quarantined rows, and files that could not be read."""

    valid: DataFrame
    rejected: DataFrame
    failures: DataFrame


def export_files(spark: SparkSession, paths: str | Sequence[str]) -> tuple[list[str], list[str]]:
    """The files that paths, patterns and folders stand for, and the paths that match nothing."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    found, missing = [], []
    for path in [paths] if isinstance(paths, str) else paths:
        place = hadoop.Path(path)
        fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
        names = []
        for status in fs.globStatus(place) or []:
            inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            names += [s.getPath().toString() for s in inside if s.isFile() and s.getPath().getName()[0] not in "._"]
        found += names
        missing += [] if names else [path]
    return found, missing


def _plain(path: str) -> str:
    """A path without scheme slashes and escapes, to match what the reader reports with what was listed."""
    return re.sub(r"^file:/*", "/", unquote(path))


def _in_parallel(work: Callable, files: Sequence[str]) -> list:
    """The driver's file-system calls for many files; each only asks for a line or a size."""
    with ThreadPoolExecutor(LISTERS) as pool:
        return list(pool.map(work, files))


def _first_line(spark: SparkSession, file: str) -> str:
    jvm = spark._jvm
    fs, place = file_system(spark, file)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(place), "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def file_headers(spark: SparkSession, files: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Column names in the first line of each file, which is all that is read; a file without a line has none."""
    headers = {}
    for f, line in zip(files, _in_parallel(lambda f: _first_line(spark, f), files)):
        cells = next(csv.reader([line.removeprefix("\ufeff")]), [])
        headers[f] = tuple(c.strip() for c in cells)
    return headers


def whole_files(spark: SparkSession, files: Sequence[str]) -> tuple[list[str], list[str]]:
    """Files to be read record by record, as their cells may hold line ends, and files that can be split at any line.

    A file that fits one task would not be split anyway. A larger one is split if every line of it has its quotes in pairs, which
    a scan of the large files tells.
    """
    limit = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()

    def size(file: str) -> int:
        fs, place = file_system(spark, file)
        return fs.getFileStatus(place).getLen()

    large = [f for f, n in zip(files, _in_parallel(size, files)) if n > limit]
    if not large:
        return list(files), []
    odd = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1
    lines = spark.read.text(large).where(odd).select(F.col("_metadata.file_path").alias("file")).distinct()
    open_quotes = {_plain(r["file"]) for r in lines.collect()}
    split = [f for f in large if _plain(f) not in open_quotes]
    return [f for f in files if f not in set(split)], split


def header_fault(header: Sequence[str], spec: ExportSpec) -> str | None:
    """Why a file with this header can't be mapped."""
    if not any(header):
        return "no header"
    if len(set(header)) < len(header):
        return "repeated column names"
    mapped = [t for t, names in spec.mapping.items() if any(n in header for n in names)]
    missing = [t for t in REQUIRED if t not in mapped and t not in spec.defaults]
    return f"missing columns: {', '.join(missing)}" if missing else None


def _scan(spark: SparkSession, files: Sequence[str], header: Sequence[str], spec: ExportSpec, split: bool) -> DataFrame:
    """Files of one header as text columns of the spec, by name; other columns are ignored.

    Quotes inside a quoted cell are doubled; unless the files may be split, such a cell may hold line ends. A row that
    does not fit keeps its text in the corrupt-record column instead of failing the file. The parser sees that only if
    it reads all columns of the line.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*header, CORRUPT]])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .option("escape", '"')
        .option("multiLine", not split)
        .csv(list(files))
    )
    own = [F.col(f"`{c}`") if c in header else F.lit(None).cast("string").alias(c) for c in spec.columns]
    return rows.select(*own, CORRUPT, F.col("_metadata.file_path").alias("source_file"))


def read_export(spark: SparkSession, paths: str | Sequence[str], spec: ExportSpec) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """Rows of all readable files (None without one), and the others as (file, reason).

    Files are grouped by their header and each group is read by the names in it, so columns may come in any order.
    """
    files, missing = export_files(spark, paths)
    failed = [(path, "missing file") for path in missing]
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in file_headers(spark, files).items():
        fault = header_fault(header, spec)
        if fault:
            failed.append((file, fault))
        else:
            groups.setdefault(header, []).append(file)
    parts = []
    for header, names in groups.items():
        parts += [_scan(spark, some, header, spec, split=bool(k)) for k, some in enumerate(whole_files(spark, names)) if some]
    return (reduce(DataFrame.unionByName, parts) if parts else None), failed


def check_mapped(columns: Sequence[str], required: Sequence[str] = REQUIRED) -> None:
    missing = [c for c in required if c not in columns]
    if missing:
        raise ValueError(f"Missing required columns after mapping: {missing}")


def map_columns(df: DataFrame, spec: ExportSpec) -> DataFrame:
    """Rename by the spec; several sources of one target are tried in order."""
    found: dict[str, Column] = {}
    for target, names in spec.mapping.items():
        present = [F.nullif(F.trim(F.col(f"`{n}`")), F.lit("")) for n in names if n in df.columns]
        if present:
            found[target] = F.coalesce(*present)
    for target, value in spec.defaults.items():
        found.setdefault(target, F.lit(value))
    check_mapped(list(found))
    for target in OPTIONAL:
        found.setdefault(target, F.lit(None).cast("string"))
    kept = [c for c in (CORRUPT, "source_file") if c in df.columns]
    return df.select(*[c.alias(n) for n, c in found.items()], *kept)


def standardise(mapped: DataFrame, spec: ExportSpec, batch_at: datetime) -> DataFrame:
    """Typed transaction columns plus the reason a row cannot be used, if any."""
    parsed = mapped.withColumns(
        {
            "amount_text": F.col("amount"),
            "date_text": F.col("posted_at"),
            "amount": clean.std_amount(F.col("amount"), spec.is_credit),
            "posted_at": clean.std_date(F.col("posted_at")),
            "currency": clean.std_currency(F.col("currency")),
            "merchant_raw": clean.clean_text(F.col("merchant_raw")),
            "description": clean.clean_text(F.col("description")),
            "balance_after": clean.parse_amount(F.col("balance_after")),
            "institution": F.lit(spec.institution),
            "source": F.lit(spec.source),
            "import_batch_id": F.lit(f"{spec.institution}_{batch_at:%Y%m%d_%H%M%S}"),
            "created_at": F.lit(batch_at).cast("timestamp_ntz"),
        }
    )
    no_amount = clean.parse_amount(F.col("amount_text")).isNull()
    reason = (
        F.when(F.col(CORRUPT).isNotNull(), "malformed row")
        .when(F.col("posted_at").isNull(), "unreadable date")
        .when(no_amount, "unreadable amount")
        .when(F.col("amount") == 0, "zero amount")
    )
    return parsed.withColumns(
        {
            "channel": clean.detect_channel(F.col("description")),
            "txn_id": hashing.txn_id(
                F.col("posted_at"), F.col("amount"), F.col("merchant_raw"), F.col("description"), F.col("institution")
            ),
            "reject_reason": reason,
        }
    )


def ingest(spark: SparkSession, files: Mapping[str, str | Sequence[str]], batch_at: datetime) -> Ingest:
    """Load the export files of all institutions.

    ``files`` maps a key of ``SPECS`` to paths. A file that is missing, or whose header lacks a required
    column, becomes a failure and stops neither its institution nor the others.
    """
    parts, failed = [], []
    for key, paths in files.items():
        spec = SPECS[key]
        rows, faults = read_export(spark, paths, spec)
        failed += [(spec.institution, file, reason) for file, reason in faults]
        if rows is not None:
            parts.append(standardise(map_columns(rows, spec), spec, batch_at))
    if not parts:
        empty = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in [*SPECS["amex"].columns, CORRUPT, "source_file"]]))
        parts.append(standardise(map_columns(empty, SPECS["amex"]), SPECS["amex"], batch_at))
    rows = reduce(DataFrame.unionByName, parts)
    return Ingest(valid_rows(rows), rejected_rows(rows), local_rows(spark, failed, FAILURES))


def valid_rows(rows: DataFrame) -> DataFrame:
    valid = rows.filter(F.col("reject_reason").isNull())
    return valid.dropDuplicates(["txn_id"]).drop("reject_reason", "amount_text", "date_text", CORRUPT)


def rejected_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reject_reason").isNotNull()).select(
        "institution", "source_file", "date_text", "amount_text", "merchant_raw", "reject_reason", CORRUPT
    )


def group_files(names: Sequence[str]) -> dict[str, list[str]]:
    """Paths per spec key, by file name."""
    keys = {id(spec): key for key, spec in SPECS.items()}
    grouped: dict[str, list[str]] = {}
    for name in names:
        grouped.setdefault(keys[id(spec_for(name.rsplit("/", 1)[-1]))], []).append(name)
    return grouped


def to_contract(valid: DataFrame) -> DataFrame:
    """Ingested rows under the names of the raw transaction contract."""
    account = F.coalesce("account_id", "institution")
    return valid.select(
        "txn_id",
        "source",
        account.alias("account_id"),
        "posted_at",
        "amount",
        "currency",
        "merchant_raw",
        F.col("mcc").alias("mcc_raw"),
        F.col("description").alias("description_raw"),
        "category_raw",
        F.lit(None).cast("string").alias("counterparty_raw"),
        "balance_after",
        hashing.row_hash(account, F.col("posted_at"), F.col("amount")).alias("hash_raw"),
        F.col("import_batch_id").alias("ingest_batch_id"),
        "institution",
        "city",
        "state",
        "country",
        "channel",
    )
