"""Merchant rules as a table, matched through an inverted index of character grams.

A merchant can only contain a pattern if it contains each gram of it. Every rule is listed under one gram, the one
that the fewest merchants have; a merchant looks up its own grams, and what it meets is compared
exactly. So the work follows the matches, not merchants times rules, and neither side is broadcast unless it
is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.operators.exprs import small_side
from ledgermill.session import settle

GRAM = 3


def grams(text: Column, size: Column | int) -> Column:
    """Distinct substrings of a length; none for shorter texts."""
    size = F.lit(size) if isinstance(size, int) else size
    last = F.length(text) - size + 1
    found = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, size))
    return F.when(last >= 1, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def best_rules(merchants: DataFrame, rules: DataFrame) -> DataFrame:
    """``text, merchant, category`` of each distinct upper-cased merchant that a rule's pattern occurs in.

    Rule ids are unique; lowest priority, then lowest rule id wins. Patterns shorter than a gram are listed under themselves; the empty
    pattern occurs in every merchant; a NULL pattern or merchant matches nothing.
    """
    slim = rules.select("rule_id", "pattern", F.col("merchant_clean").alias("merchant"), F.col("category_std").alias("category"), "priority")
    slim = settle(slim.where(F.col("pattern").isNotNull()).withColumn("g", F.least(F.length("pattern"), F.lit(GRAM))), "rules")
    lengths = sorted(r.g for r in slim.select("g").distinct().collect())
    texts = settle(merchants.where(F.col("text").isNotNull()).distinct(), "merchants")
    own = [grams(F.col("text"), n) for n in lengths if n]
    listed = texts.select("text", F.explode(F.concat(*own) if own else F.array().cast("array<string>")).alias("gram"))
    listed = settle(listed, "grams")
    common = listed.groupBy("gram").agg(F.count("*").alias("texts"))
    offered = slim.where("g > 0").select("rule_id", "pattern", "priority", F.explode(grams(F.col("pattern"), F.col("g"))).alias("gram"))
    # a gram that no merchant has rules its pattern out
    counted = offered.join(common, "gram", "left")
    rarest = counted.groupBy("rule_id", "pattern", "priority").agg(
        F.min_by("gram", F.struct("texts", "gram")).alias("gram"), F.count(F.when(F.col("texts").isNull(), 1)).alias("missing")
    )
    index = small_side(settle(rarest.where("missing = 0").drop("missing"), "rule-index"))
    met = listed.join(index, "gram").where(F.col("text").contains(F.col("pattern"))).select("text", "priority", "rule_id")
    always = slim.where("g = 0").agg(F.min(F.struct("priority", "rule_id")).alias("r")).first()["r"]
    if always is not None:
        met = met.union(texts.select("text", F.lit(always.priority).cast("int"), F.lit(always.rule_id).cast("int")))
    best = met.groupBy("text").agg(F.min(F.struct("priority", "rule_id")).alias("b"))
    chosen = small_side(slim.select(F.col("rule_id").alias("_id"), F.col("priority").alias("_priority"), "merchant", "category"))
    same = (F.col("b.rule_id") == F.col("_id")) & F.col("b.priority").eqNullSafe(F.col("_priority"))
    return best.join(chosen, same).select("text", "merchant", "category")


def best_rules_joined(with_text: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``_rule_merchant`` and ``_rule_category`` to rows with an upper-cased ``_text``.

    The result has one row for each merchant; beyond a broadcast's size, rows are joined by a shuffle, whose hot merchants Spark splits.
    """
    found = settle(best_rules(with_text.select(F.col("_text").alias("text")), rules), "matches")
    matches = small_side(found.select(F.col("text").alias("_known"), F.col("merchant").alias("_rule_merchant"), F.col("category").alias("_rule_category")))
    return with_text.join(matches, F.col("_text") == F.col("_known"), "left").drop("_known")
