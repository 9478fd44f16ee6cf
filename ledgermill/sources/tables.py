"""Seed files and contract records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgermill.schemas import CATEGORY, FX_RATE, MERCHANT_RULE, RAW_TRANSACTION

#: more rules would make one expression too large to compile
RULES_IN_PLAN = 500


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, CATEGORY)


def read_fx_rates(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, FX_RATE)


def read_merchant_rules(spark: SparkSession, path: str) -> Sequence[tuple] | DataFrame:
    """Rules for ``normalise_merchants``: tuples up to ``RULES_IN_PLAN``, which compile into the plan, else a table."""
    table = read_rule_table(spark, path)
    rows = table.limit(RULES_IN_PLAN + 1).collect()
    return [tuple(r) for r in rows] if len(rows) <= RULES_IN_PLAN else table


def read_rule_table(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, MERCHANT_RULE)


def read_contract_json(spark: SparkSession, path: str) -> DataFrame:
    """Contract records, one JSON object per line."""
    return spark.read.schema(RAW_TRANSACTION).option("mode", "PERMISSIVE").json(path)
