import random

import pytest

from conftest import rows_of
from ledgermill.operators import staging
from ledgermill.reference_data import MERCHANT_RULES, categories
from ledgermill.schemas import CATEGORY, MERCHANT_RULE


def named(spark, merchants, rules):
    raw = spark.createDataFrame([(i, m, c) for i, (m, c) in enumerate(merchants)], "txn_id int, merchant_raw string, category_raw string")
    return rows_of(staging.normalise_merchants(raw, categories(spark), rules), "txn_id", "merchant_clean", "category_std")


@pytest.mark.parametrize("seed", range(3))
def test_table_equals_case(spark, seed):
    """Random short patterns of few letters, so that many overlap, some are contained in others, and some never occur."""
    rng = random.Random(seed)
    word = lambda least, most: "".join(rng.choice("ABC ") for _ in range(rng.randint(least, most)))
    rules = [(i, word(1 if seed else 0, 6), rng.choice([None, f"m{i}"]), "1", rng.choice([None, f"c{i}"]), False, rng.randint(1, 5)) for i in range(60)]
    merchants = [(word(0, 9).lower(), rng.choice([None, "Restaurants", "nothing"])) for _ in range(300)] + [(None, None), ("", None), ("Z\u00dc\u65e5A", None)]
    assert named(spark, merchants, rules) == named(spark, merchants, spark.createDataFrame(rules, MERCHANT_RULE))


def test_usual_rules_as_table(spark):
    merchants = [("Starbucks #1", None), ("amazon mktpl", None), ("corner shop", "Restaurants"), ("xx", "xx")]
    assert named(spark, merchants, MERCHANT_RULES) == named(spark, merchants, spark.createDataFrame(MERCHANT_RULES, MERCHANT_RULE))


def test_many_rules_without_a_product(spark):
    rules = spark.range(100_000).selectExpr("int(id) rule_id", "concat('SHOP ', id) pattern", "concat('Shop ', id) merchant_clean", "'1' mcc", "'Other' category_std", "false risk_flag", "int(10 - length(id)) priority")
    merchants = spark.range(2000).selectExpr("int(id) txn_id", "concat('shop ', id * 37, ' street') merchant_raw", "string(null) category_raw")
    done = staging.normalise_merchants(merchants, categories(spark), rules)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert [r.merchant_clean for r in done.orderBy("txn_id").collect()] == [f"Shop {37 * i}" for i in range(2000)]


def test_no_rules_and_no_merchants(spark):
    none = spark.createDataFrame([], MERCHANT_RULE)
    assert named(spark, [(" a ", None)], none) == [(0, "a", "Other")]
    assert named(spark, [(None, None)], spark.createDataFrame(MERCHANT_RULES, MERCHANT_RULE)) == [(0, "", "Other")]


def tree(spark, *rows):
    frame = spark.createDataFrame([(i, p, n, g, False) for i, p, n, g in rows], CATEGORY)
    return {r.category_name: (r.parent_name, r.root_name, r.root_group) for r in staging.category_tree(frame).collect()}


def test_deep_tree(spark):
    chain = [(i, i - 1 if i > 1 else None, f"c{i}", f"g{i}") for i in range(1, 38)]
    got = tree(spark, *chain, (50, 99, "orphan", "o"))
    assert got["c37"] == ("c36", "c1", "g1") and got["c2"] == ("c1", "c1", "g1") and got["c1"] == (None, "c1", "g1")
    assert got["orphan"] == (None, "orphan", "o") and len(got) == 38


@pytest.mark.parametrize("size", [1, 2, 3, 8])
def test_circles_are_an_error(spark, size):
    rows = [(i, (i + 1) % size, f"c{i}", "g") for i in range(size)] + [(100, None, "r", "g"), (101, 100, "s", "g")]
    with pytest.raises(ValueError, match="circle"):
        tree(spark, *rows)
