"""More hot keys than a plan should list: they are stored and joined, with the same results."""

import pytest
from fixtures import rows
from pyspark.sql import functions as F

from checks.queries import QUERIES
from strata.operators import history as hist
from strata.operators import skew
from strata.operators.fact import build_fact
from strata.operators.lookup import lookup_scd2
from strata.operators.skew import hot_counts, salted_join

SF_DIR = "/root/testdata/sf0.001"


def described(df):
    return df._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_plan_does_not_hold_all_hot_keys(spark, how):
    left = spark.range(60_000).select(
        F.when(F.col("id") % 1000 == 0, None).otherwise(F.col("id") % 6000).alias("k"), "id"
    )
    right = spark.range(0, 12_000, 2).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    found = salted_join(left, right, ["k"], how, hot_rows=6)
    assert len(described(found)) < 20_000
    assert rows(found) == rows(left.join(right, "k", how))


def test_histories_and_lookups_do_not_hold_all_hot_keys(spark):
    feed = spark.range(30_000).select(
        (F.col("id") % 5000).alias("k"), F.col("id").alias("at"), (F.col("id") % 7).alias("state")
    )
    args = (["k"], "at", ["state"], [], [], "half_open", "first")
    history = hist.scd2_history(feed, *args, hot_rows=5)
    assert len(described(history)) < 50_000
    assert rows(history) == rows(hist.scd2_history(feed, *args))
    dim = history.withColumnRenamed("state", "then")
    fact = feed.select("k", (F.col("at") + 1).alias("at"))
    take = {"then": "then"}
    looked = lookup_scd2(fact, dim, {"k": "k"}, "at", take, "half_open", 0, 5)
    assert len(described(looked)) < 100_000
    assert rows(looked) == rows(lookup_scd2(fact, dim, {"k": "k"}, "at", take, "half_open"))


@pytest.mark.parametrize("salts", [None, 4])
def test_salts_of_stored_keys_follow_each_key(spark, monkeypatch, salts):
    """Keys of 2,000, 150 and 3 rows have as many salts as when they are listed."""
    ids = F.col("id")
    left = spark.range(2153).select(F.when(ids < 2000, 1).when(ids < 2150, 2).otherwise(3).alias("k"), "id")
    keys = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    counts = {}
    for limit in (10, 0):
        monkeypatch.setattr(skew, "LISTED_KEYS", limit, raising=False)
        hot = skew.hot_keys(left, ["k"], 100)
        assert hot.few == (limit > 0)
        counts[limit] = rows(hot.with_salts(keys, 100, salts))
    assert counts[0] == counts[10] == ([(1, 4), (2, 4), (3, 1)] if salts else [(1, 64), (2, 4), (3, 1)])
    assert sorted(hot_counts(left, ["k"], 100).values()) == [150, 2000]


@pytest.mark.parametrize("name", ["event_history_hot_users", "lookup_same_day_changes_hot_users", "fact_without_broadcast"])
def test_stored_keys_change_no_result(spark, monkeypatch, name):
    listed = rows(QUERIES[name](spark, SF_DIR))
    monkeypatch.setattr(skew, "LISTED_KEYS", 0, raising=False)
    assert rows(QUERIES[name](spark, SF_DIR)) == listed


def test_a_fact_of_many_hot_orders(spark):
    """Orders of 3 and of 7 lines; 5,000 of them are hot."""
    ids = F.col("id")
    orders = spark.range(6000).select(
        ids.alias("order_id"), (ids % 10).alias("customer_id"), F.lit("2024-02-01").cast("date").alias("order_date"),
        F.lit("O").alias("status"),
    )
    sizes = F.when(F.col("order_id") < 1000, 3).otherwise(7)
    lines = orders.select("order_id", F.explode(F.sequence(F.lit(1), sizes)).alias("line_id")).select(
        "*", (F.col("line_id") % 5).cast("bigint").alias("product_id"), F.lit(1).alias("quantity"),
        *[F.lit(2).cast("decimal(10,2)").alias(c) for c in ("unit_price", "discount_pct", "line_amount")],
    )
    customers = spark.range(10).select(
        ids.alias("customer_sk"), ids.alias("customer_id"), F.lit("2024-01-01").cast("date").alias("valid_from"),
        F.lit("9999-12-31").cast("date").alias("valid_to"), F.lit(True).alias("is_current"),
    )
    products = spark.range(5).select(ids.alias("product_sk"), ids.alias("product_id"))
    given = (lines, orders, customers, products, "closed", 0)
    found = build_fact(*given, hot_rows=6)
    assert len(described(found)) < 100_000
    assert rows(found) == rows(build_fact(*given))
