"""Mixing sources to target weights, in native expressions only.

Every document gets a hash-random key. Keys are cut into equal ranges; ranges are summed by source, the sums
accumulated over the ranges, and inside a range by key, so prefix sums need no task that holds a source.
Each source is cut where its budget ends. A budget above the source's size first takes whole epochs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.keys import doc_key, packed, unpacked
from ledgermill.operators.exprs import small_side
from ledgermill.session import settle

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"
KEY_BITS = 60
RANGE_ROWS = 2_000
REPEATS_AT_ONCE = 1 << 14
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(id_col: str, text_col: str, seed: str = SEED) -> Column:
    """60 bits of the MD5 of seed, id and text."""
    parts = [F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_col, text_col)]]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, KEY_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``: one row for each source.

    Targets share the total by weight, and none exceeds ``most`` times its source. With sources ordered by the level at
    which they reach that limit, the level that shares out everything is the highest of the levels found by
    taking the first 0, 1, 2, ... sources as limited.
    """
    everything = Window.partitionBy()
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    rows = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * most)
    rows = rows.withColumn("total", F.sum("source_size").over(everything))
    order = everything.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    limited = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (F.col("total") - limited).cast("double") / open_weight)
    level = F.max("level").over(everything)
    return rows.select("source", "source_size", F.least(F.col("limit").cast("double"), level * F.col("weight")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", range_rows: int = RANGE_ROWS) -> DataFrame:
    """``k_id, k_th, doc_id, source, size, source_size, target, taken, copies, epochs`` of every row.

    ``taken`` adds up to the whole words of the target in every source: the document at the cut is taken in part.
    ``copies`` counts it as a whole if at least half of it is taken. Sizes are words; NULL and blank texts
    have size 0 and take nothing. Rows of equal key (repeated rows) are interchangeable. NULL is a source of its own. An
    empty table gives no row. Only the three named columns are read.
    """
    rows = docs.select(
        *doc_key(id_col, text_col),
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        n_words(F.col(text_col)).alias("size"),
        random_key(id_col, text_col).alias("key"),
    )
    rows = settle(rows.groupBy(*rows.columns).agg(F.count("*").alias("m")), "sizes")  # repeated rows are one unit of m
    sizes = settle(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.sum("m").alias("n")), "sources")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(total, 1) / range_rows)))
    plan = settle(targets(sizes.select("source", "source_size")).withColumn("s", F.xxhash64("source")), "targets")
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - F.col("epochs") * F.col("source_size")
    plan = plan.withColumn("epochs", epochs).withColumn("rest", rest)

    placed = rows.withColumn("part", F.shiftright("key", KEY_BITS - bits))
    words = F.col("size") * F.col("m")
    parts = placed.groupBy("source", "part").agg(F.sum(words).alias("words"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("earlier", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    parts = parts.alias("p").join(small_side(plan).alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")))
    parts = parts.select("p.source", "part", "earlier", "source_size", "target", "epochs", "rest")
    inside = Window.partitionBy("source", "part").orderBy("key", "doc_id", "k_th").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("inside", F.coalesce(F.sum(words).over(inside), F.lit(0)))
    joined = summed.alias("d").join(
        parts.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.part") == F.col("p.part"))
    )
    found = joined.select("d.*", "source_size", "target", "epochs", (F.col("rest") - F.col("earlier") - F.col("inside")).alias("left"))
    return _each_repeat(found).select(
        "k_id",
        "k_th",
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + F.col("partial")).alias("taken"),
        F.when(F.col("size") > 0, F.col("epochs") + F.when((F.col("partial") > 0) & (F.col("partial") * 2 >= F.col("size")), 1).otherwise(0))
        .otherwise(0)
        .alias("copies"),
        "epochs",
    )


def _each_repeat(units: DataFrame) -> DataFrame:
    """One row for each of a unit's m repeated rows, with the ``partial`` words that the cut leaves it; many repeats are spread over tasks."""
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / REPEATS_AT_ONCE))
    many = units.where(F.col("m") > REPEATS_AT_ONCE).withColumn("block", F.explode(blocks)).repartition("key", "block")
    rows = units.where(F.col("m") <= REPEATS_AT_ONCE).withColumn("block", F.lit(0).cast("long")).unionByName(many)
    first = F.col("block") * REPEATS_AT_ONCE
    here = F.sequence(first, F.least(first + REPEATS_AT_ONCE, F.col("m")) - 1)
    rows = rows.withColumn("at", F.explode(here))
    return rows.withColumn("partial", F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("at") * F.col("size"))))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix has copies of it.

    Rows equal in id, text and source share their copies: each gets the whole epochs, and one of them
    stands for those that the last epoch takes. So a source's words differ from its target by half a document at most,
    repeated rows or not. NULL, empty and blank texts have no words and no copy; an empty table gives no row. All
    columns are kept.
    """
    own = ["k_id", "k_th", "s"]
    counted = mix(docs, id_col, text_col, source_col).withColumn("s", F.xxhash64("source"))
    counted = counted.groupBy(*own).agg(F.sum("copies").alias("copies"), F.count("*").alias("m"), F.first("epochs").alias("epochs"))
    counted = settle(counted.where("copies > 0"), "copies")
    rows = packed(docs, id_col, text_col).withColumn("s", F.xxhash64(F.col("row").getField(source_col).cast("string"))).join(counted, own)

    def times(df: DataFrame, n: str) -> DataFrame:
        return df.where(F.col(n) > 0).select("row", F.explode(F.sequence(F.lit(1), F.col(n))).alias("copy"))

    out = times(rows.where("m = 1"), "copies")
    if not counted.where("m > 1").isEmpty():
        repeated = rows.where("m > 1")
        last = F.first(F.col("copies") - F.col("epochs") * F.col("m")).alias("last")
        out = out.union(times(repeated, "epochs")).union(times(repeated.groupBy(*own).agg(F.first("row").alias("row"), last), "last"))
    return unpacked(out.select("row"))


SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 15) AS BIGINT) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY 1),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
             CAST(sum(n) OVER () AS BIGINT) AS total FROM s),
f AS (SELECT *, CAST(total - coalesce(sum(3 * n) OVER (ORDER BY 3 * n / weight, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
             / sum(weight) OVER (ORDER BY 3 * n / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, n, least(CAST(3 * n AS DOUBLE), max(level) OVER () * weight) AS target FROM f),
b AS (SELECT *, CASE WHEN n > 0 THEN CAST(floor(target) AS BIGINT) // n ELSE 0 END AS epochs FROM t),
r AS (SELECT d.*, n AS source_size, target, epochs, CAST(floor(target) AS BIGINT) - epochs * n AS rest,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM r
"""
