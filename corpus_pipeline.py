"""From raw documents to encoded training data, stage by stage.

Every stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet to the shared folder
and read again as the next stage's ``docs``. NULL, empty and letterless texts go in the first stage; of repeated rows,
as of near copies, one is left by the second; an empty table passes through all of them. Columns beside those of
documents are kept, whatever their names, until the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgermill.llm import decontaminate, langid, mix, simhash, wavelet
from ledgermill.llm.keys import table
from ledgermill.session import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is told with enough certainty; those without letters go."""
    return langid.drop_unidentified(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.drop_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the number of copies that brings each source to its target."""
    return mix.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document in the token shards."""
    return wavelet.encoded(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identified),
    ("simhash_dedup", deduplicated),
    ("decontaminate", decontaminated),
    ("mix_sources", mixed),
    ("token_shards", encoded),
]

#: XXH64 and the tokenizer have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
