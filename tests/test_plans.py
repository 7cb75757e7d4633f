"""The plans the jobs are meant to have: few shuffles, narrow scans, bounded broadcasts."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from strata.operators import history as hist
from strata.operators import reconcile
from strata.operators.clean import latest_wins
from strata.operators.fact import build_fact
from strata.operators.lookup import lookup_scd2
from strata.plans import retail
from strata.scratch import materialise
from strata.sources.bucketed import write_bucketed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, pattern):
    return len(re.findall(pattern, plan(df)))


@pytest.fixture
def no_small_tables(spark):
    """Joins as Spark plans them for tables too large to broadcast unasked."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def events(spark):
    rows = spark.range(500).selectExpr(
        "id % 20 AS k", "id AS at", "CAST(id % 3 AS string) AS state", "id * 2 AS note",
        "repeat('x', 10) AS unused",
    )
    return materialise(rows, "plan-events")


@pytest.mark.parametrize("untracked", ["first", "latest"])
def test_history_is_one_shuffle_and_one_sort(spark, events, untracked):
    df = hist.scd2_history(
        events, ["k"], "at", ["state"], ["note"], ["note"], "half_open", untracked
    )
    assert (count(df, r"Exchange "), count(df, r"\bSort \[")) == (1, 1)
    assert "unused" not in plan(df)
    assert "IsNotNull(k)" in plan(df) and "IsNotNull(at)" in plan(df)


def test_history_of_cleaned_batches_is_one_shuffle(spark, events):
    raw = events.select(
        *[F.lit("1").alias(c) for c in retail.COLUMNS["customers"]], F.lit("batch_1").alias("_batch_id")
    )
    states = retail.customer_versions(raw, {"batch_1": date(2024, 1, 1)})
    df = hist.scd2_history(
        states, ["customer_id"], "_effective", retail.TRACKED, retail.CARRIED
    )
    assert count(df, r"Exchange ") == 1


def test_comparison_is_one_join_and_one_shuffle_per_side(spark, events, no_small_tables):
    old = latest_wins(events, ["k"], ["at"]).filter("k < 15")
    new = latest_wins(events, ["k"], ["at"]).filter("k > 5")
    df = hist.scd2_compare(
        old, new, ["k"], ["state"], ["note"], date(2024, 1, 1), date(2024, 3, 1)
    )
    assert (count(df, r"FullOuter"), count(df, r"Exchange ")) == (1, 2)


def test_fold_leaves_closed_versions_in_place(spark, no_small_tables):
    history = materialise(
        spark.range(50).selectExpr(
            "id AS k", "'s' AS state", "date'2024-01-01' AS valid_from",
            "date'9999-12-31' AS valid_to", "id % 2 = 0 AS is_current",
        ),
        "plan-history",
    )
    snapshot = materialise(spark.range(50).selectExpr("id AS k", "'t' AS state"), "plan-snapshot")
    df = hist.scd2_fold(history, snapshot, ["k"], ["state"], [], date(2024, 3, 1))
    # One shuffle of the open versions and one of the snapshot, none of the closed versions.
    assert (count(df, r"FileScan"), count(df, r"Exchange ")) == (3, 2)


def test_fact_lines_travel_once(spark, no_small_tables):
    lines = materialise(
        spark.range(300).selectExpr(
            "id DIV 4 AS order_id", "CAST(id % 4 AS int) AS line_id", "id % 9 AS product_id",
            "1 AS quantity", "CAST(1 AS decimal(10,2)) AS unit_price",
            "CAST(0 AS decimal(5,2)) AS discount_pct", "CAST(1 AS decimal(12,2)) AS line_amount",
        ),
        "plan-lines",
    )
    orders = materialise(
        spark.range(75).selectExpr(
            "id AS order_id", "id % 5 AS customer_id", "date'2024-02-01' AS order_date",
            "'x' AS status",
        ),
        "plan-orders",
    )
    customers = spark.range(5).selectExpr(
        "id AS customer_sk", "id AS customer_id", "date'2024-01-01' AS valid_from",
        "date'9999-12-31' AS valid_to",
    )
    products = spark.range(9).selectExpr("id AS product_sk", "id AS product_id")
    df = build_fact(lines, orders, customers, products)
    text = plan(df)
    scans = [line for line in text.split("\n") if "FileScan" in line and "line_amount" in line]
    assert len(scans) == 1
    # Lines, headers, and the starts of the orders; none of the windows adds a shuffle.
    assert len(re.findall(r"Exchange hashpartitioning\(order_id", text)) == 3
    # The only window in one task counts slices of a sort, not rows.
    for single in re.findall(r"Exchange SinglePartition[^\n]*\n([^\n]*)", text):
        assert "HashAggregate(keys=[_slice" in single


def test_lookup_beyond_a_broadcast_shuffles_the_facts_once(spark, events, no_small_tables):
    dim = materialise(
        spark.range(20).selectExpr(
            "id AS k", "id AS sk", "0L AS __START_AT", "CAST(NULL AS bigint) AS __END_AT"
        ),
        "plan-dim",
    )
    df = lookup_scd2(
        events.select("k", "at"), dim, {"k": "k"}, "at", {"sk": "sk"}, "half_open", broadcast_bytes=0
    )
    assert (count(df, r"Exchange "), count(df, r"Join")) == (1, 0)


def test_content_check_reads_each_variant_once(spark, events):
    df = reconcile.content_check({"a": events, "b": events.filter("k < 9")}, ["at"], ["state", "note"])
    assert (count(df, r"FileScan"), count(df, r"Exchange ")) == (2, 2)
    assert "unused" not in plan(df)


def test_fact_of_bucketed_tables_moves_no_lines(spark, no_small_tables):
    """Lines and orders that lie in buckets by order: only order numbers are shuffled."""
    lines = spark.range(600).selectExpr(
        "id DIV 3 AS order_id", "CAST(id % 3 AS int) AS line_id", "id % 5 AS product_id", "1 AS quantity",
        "1.0BD AS unit_price", "0.0BD AS discount_pct", "1.0BD AS line_amount",
    )
    orders = spark.range(200).selectExpr(
        "id AS order_id", "id % 9 AS customer_id", "DATE'2024-01-05' AS order_date", "'open' AS status"
    )
    customers = spark.range(9).selectExpr(
        "id + 1 AS customer_sk", "id AS customer_id", "DATE'2024-01-01' AS valid_from",
        "DATE'9999-12-31' AS valid_to", "true AS is_current",
    )
    products = spark.range(5).selectExpr("id + 1 AS product_sk", "id AS product_id")
    write_bucketed(lines, "plan_lines", ["order_id"], 4)
    write_bucketed(orders, "plan_orders", ["order_id"], 4)
    bucketed = build_fact(spark.table("plan_lines"), spark.table("plan_orders"), customers, products)
    plain = build_fact(materialise(lines, "l"), materialise(orders, "o"), customers, products)
    moved = [line for line in plan(bucketed).splitlines() if "Exchange hashpartitioning(order_id" in line]
    assert len(moved) <= 1 < count(plain, r"Exchange hashpartitioning\(order_id")
    assert sorted(map(tuple, bucketed.collect())) == sorted(map(tuple, plain.collect()))
    for name in ("plan_lines", "plan_orders"):
        spark.sql(f"DROP TABLE {name}")
