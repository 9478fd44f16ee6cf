"""One query for each operator, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import decontaminate, langid, linededup, mix, neighbours, passages, periodic, pii, sharding, simhash, spelling, tokencount, wavelet
from ledgermill.llm.keys import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for every hundredth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram tokens of all documents."""
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), tokencount.vocabulary_path())


def op3_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read back from their token shards."""
    return wavelet.encoded(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that repeat earlier ones."""
    return linededup.dedup_lines(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that stand in a benchmark window."""
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("k_id", "k_th")


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of all documents that near-repeat earlier ones."""
    return passages.dedup_passages(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2("base", 256)).drop("base")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of sources takes of all documents."""
    return mix.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents."""
    return langid.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and roots of the words of all documents."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), every=31)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes, equal texts together."""
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all documents, a tenth of which end in a planted one."""
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), planted=True)


_ALL = (
    op1_neighbours,
    op2_token_counts,
    op3_wavelet_shards,
    op4_line_dedup,
    op5_decontaminate,
    op6_passages,
    op7_personal_data,
    op8_simhash,
    op9_mix,
    op10_language_id,
    op11_spelling,
    op12_sharding,
    op13_periodic_runs,
)
QUERIES: dict[str, Query] = {f.__name__: f for f in _ALL}

ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": linededup.SQL,
    "op5_decontaminate": decontaminate.SQL,
    "op9_mix": mix.SQL,
}
