"""Row identity, stored intermediates and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.session import settle

NO_ID = -(1 << 63)
MAX_ROUNDS = 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """``k_id``, ``k_th``: never NULL; rows equal in id and text are one document."""
    return [F.coalesce(F.col(id_col), F.lit(NO_ID)).alias("k_id"), F.xxhash64(text_col).alias("k_th")]


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows with their key, all columns in one struct ``row``, so that no name can clash."""
    return docs.select(*doc_key(id_col, text_col), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of the undirected edges ``a``, ``b``; the root is the least node reachable.

    Alternating large and small stars: each step links every node with the least node next
    to it, with map-side minima and joins that Spark can split, until nothing changes. Edges are
    written to the shared folder after each round.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    edges = settle(edges.distinct(), "links")
    before = _fingerprint(edges)
    if before[0]:
        for _ in range(MAX_ROUNDS):
            both = edges.union(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
            least = both.groupBy(F.col("hi").alias("u")).agg(F.least(F.col("hi"), F.min("lo")).alias("m"))
            large = (
                edges.join(least, F.col("lo") == F.col("u"))  # each link goes to the least node beside its lower end
                .select(F.col("hi"), F.col("m").alias("lo"))
                .distinct()
            )
            low = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
            joined = large.join(low, F.col("hi") == F.col("u"))
            pairs = F.array(
                F.struct(F.col("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            )
            small = joined.select(F.inline(pairs)).where(F.col("hi") != F.col("lo")).distinct()
            edges = settle(small, "links")
            now = _fingerprint(edges)
            if now == before:
                break
            before = now
        else:
            raise RuntimeError("components did not settle")
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots)
