"""Cleaning, keys, lookups, data tests and reconciliation."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from fixtures import OPEN, rows
from pyspark.sql import functions as F
from test_history import spark_slices

from strata.functions.batches import batch_number, batch_of_path, effective_date
from strata.functions.compare import row_fingerprint
from strata.functions.dates import date_key, is_weekend
from strata.functions.money import line_amount
from strata.operators import quality, reconcile
from strata.operators.clean import latest_wins, latest_wins_aggregated
from strata.operators.dims import date_dimension, surrogate_key
from strata.operators.fact import build_fact
from strata.operators.lookup import lookup, lookup_scd2
from strata.operators.ordered import group_starts
from strata.operators.skew import fits_broadcast, hot_hashes, measure, salted_join
from strata.plans import retail


def one(spark, expression, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(expression).first()[0]


# --- functions ---------------------------------------------------------------------------


def test_batch_numbers_are_numbers(spark):
    df = spark.createDataFrame([("batch_2",), ("batch_10",), ("other",)], "b string")
    assert [r[0] for r in df.select(batch_number("b")).collect()] == [2, 10, None]
    assert one(spark, batch_of_path(F.col("p")), p="/x/batch_12/orders.csv") == "batch_12"
    assert one(spark, batch_of_path(F.col("p")), p="/x/orders.csv") == ""


def test_unknown_batch_is_an_error(spark):
    df = spark.createDataFrame([("batch_1",), ("batch_9",)], "b string")
    dated = df.select(effective_date("b", {"batch_1": date(2024, 1, 1)}))
    with pytest.raises(Exception, match="batch_9"):
        dated.collect()


@pytest.mark.parametrize(
    "quantity,price,pct,amount",
    [(5, "9.99", "10.00", "44.96"), (3, "14.99", "5.00", "42.72"), (1, "29.99", "15.00", "25.49"),
     (-5, "9.99", "10.00", "-44.96"), (2, "0.00", "0.00", "0.00"), (1, "9.99", "100.00", "0.00")],
)
def test_line_amount(spark, quantity, price, pct, amount):
    df = spark.createDataFrame(
        [(quantity, Decimal(price), Decimal(pct))],
        "q int, p decimal(10,2), d decimal(5,2)",
    ).select(line_amount("q", "p", "d").alias("a"))
    assert df.dtypes == [("a", "decimal(12,2)")]
    assert df.first()[0] == Decimal(amount)


def test_line_amount_too_large_is_null(spark):
    df = spark.createDataFrame(
        [(2147483647, Decimal("99999999.99"), Decimal("0"))],
        "q int, p decimal(10,2), d decimal(5,2)",
    )
    assert df.select(line_amount("q", "p", "d")).first()[0] is None


def test_dates(spark):
    df = spark.createDataFrame([(date(2024, 3, 2),), (date(2024, 3, 4),), (None,)], "d date")
    assert [tuple(r) for r in df.select(date_key("d"), is_weekend("d")).collect()] == [
        (20240302, True), (20240304, False), (None, None),
    ]


def test_fingerprints_keep_nulls_and_separators_apart(spark):
    listed = [("a", None, "b"), ("a", "b", None), ("a|b", "c", ""), ("a", "b|c", ""), ("~", "", "")]
    listed += [(None, "", ""), ("1:a", "", ""), ("", "", ""), (None, None, None)]
    df = spark.createDataFrame(listed, "x string, y string, z string")
    prints = [bytes(r[0]) for r in df.select(row_fingerprint(["x", "y", "z"])).collect()]
    assert {len(p) for p in prints} == {16}
    assert len(set(prints)) == len(listed)


# --- cleaning ----------------------------------------------------------------------------

ORDERS = "order_id string, customer_id string, order_date string, status string, _batch_id string"


def test_keys_that_differ_in_blanks_are_one_key(spark):
    raw = spark.createDataFrame(
        [("1", "7", "2024-01-01", "A", "batch_1"), (" 1 ", "7", "2024-01-01", " B ", "batch_2")],
        ORDERS,
    )
    assert rows(retail.silver(raw, "orders")) == [(1, 7, date(2024, 1, 1), "b")]


def test_batch_10_beats_batch_2(spark):
    raw = spark.createDataFrame(
        [("1", "7", "2024-01-01", s, f"batch_{b}") for s, b in (("x", 2), ("y", 10), ("z", 9))],
        ORDERS,
    )
    assert rows(retail.silver(raw, "orders")) == [(1, 7, date(2024, 1, 1), "y")]


def test_unreadable_keys_are_dropped_and_other_values_become_null(spark):
    raw = spark.createDataFrame(
        [("abc", "7", "2024-01-01", "x", "batch_1"), (None, "7", "2024-01-01", "x", "batch_1"),
         ("2", "q", "2024-13-01", "x", "batch_1")],
        ORDERS,
    )
    assert rows(retail.silver(raw, "orders")) == [(2, None, None, "x")]


def test_ties_in_a_batch_are_settled_the_same_way_every_time(spark):
    listed = [("1", str(c), "2024-01-01", s, "batch_1") for c, s in ((3, "a"), (5, "b"), (5, "c"))]
    for _ in range(3):
        random.shuffle(listed)
        raw = spark.createDataFrame(listed, ORDERS)
        assert rows(retail.silver(raw, "orders")) == [(1, 5, date(2024, 1, 1), "c")]


def test_both_forms_of_latest_wins_agree(spark):
    listed = [(k % 7, k % 11, random.choice([None, "x", "y"]), k) for k in range(500)]
    df = spark.createDataFrame(listed, "a int, b int, v string, o int").repartition(4)
    by_rank = latest_wins(df, ["a", "b"], ["o"])
    by_aggregate = latest_wins_aggregated(df, ["a", "b"], ["o"])
    assert by_rank.columns == by_aggregate.columns == df.columns
    assert rows(by_rank) == rows(by_aggregate)
    assert by_rank.count() == 77


def test_only_the_best_row_per_key_leaves_a_map_task(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS o")
    plan = latest_wins(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    partial, final = plan.rindex("WindowGroupLimit"), plan.index("WindowGroupLimit")
    assert final < plan.index("Exchange") < partial


# --- keys and dates ----------------------------------------------------------------------


def test_surrogate_keys_are_dense_and_in_order(spark):
    listed = [(k, l) for k in range(40) for l in range(1 if k % 2 else 30)]
    random.shuffle(listed)
    df = spark.createDataFrame(listed, "k int, l int").repartition(6)
    with spark_slices(spark, 7):
        numbered = surrogate_key(df, ["k", "l"], "sk")
        assert numbered.dtypes[0] == ("sk", "bigint")
        found = sorted(tuple(r) for r in numbered.collect())
    assert found == [(n, *row) for n, row in enumerate(sorted(listed), 1)]


def test_group_starts(spark):
    sizes = [(k, random.randrange(1, 9)) for k in range(300)]
    df = spark.createDataFrame(random.sample(sizes, 300), "k int, n bigint").repartition(5)
    with spark_slices(spark, 7):
        found = rows(group_starts(df, "k", "n", "start"))
    assert found == [(k, sum(n for _, n in sizes[:k])) for k in range(300)]


@pytest.mark.parametrize("hot_rows", [10**6, 40, 1])
def test_fact_with_a_hot_order(spark, hot_rows):
    """One order with a third of all lines, lines without order, orders without lines."""
    chance = random.Random(6)
    keys = [(9, n) for n in range(100)]
    keys += [(k, n) for k in range(60) if k != 9 for n in range(chance.randrange(0, 6))]
    chance.shuffle(keys)
    cents = Decimal("1.00")
    lines = spark.createDataFrame(
        [(o, n, (o + n) % 5, 1, cents, cents, cents) for o, n in keys],
        "order_id int, line_id int, product_id int, quantity int, unit_price decimal(10,2), "
        "discount_pct decimal(5,2), line_amount decimal(12,2)",
    ).repartition(4)
    day = date(2024, 2, 1)
    orders = spark.createDataFrame(
        [(o, o % 3, day, "done") for o in range(0, 60) if o % 7],
        "order_id int, customer_id int, order_date date, status string",
    )
    customers = spark.createDataFrame(
        [(c + 10, c, date(2024, 1, 1), OPEN) for c in range(2)],
        "customer_sk bigint, customer_id int, valid_from date, valid_to date",
    )
    products = spark.createDataFrame([(p + 20, p) for p in range(4)], "product_sk bigint, product_id int")
    with spark_slices(spark, 5):
        fact = build_fact(lines, orders, customers, products, hot_rows=hot_rows)
        found = rows(fact.select("order_line_sk", "order_id", "line_id", "customer_sk", "product_sk"))
    expected = [
        (n, o, l, o % 3 + 10 if o % 3 < 2 else None, (o + l) % 5 + 20 if (o + l) % 5 < 4 else None)
        for n, (o, l) in enumerate(sorted(k for k in keys if k[0] % 7), 1)
    ]
    assert found == expected


def test_surrogate_keys_of_nothing(spark):
    assert surrogate_key(spark.range(0), ["id"], "sk").collect() == []


def test_surrogate_key_uses_no_single_task_for_rows(spark):
    df = surrogate_key(spark.range(100), ["id"], "sk")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "_size" in window and "Aggregate [_slice" in window


def test_date_dimension_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "d date")
    assert date_dimension(empty, "d").collect() == []
    assert date_dimension(empty.limit(0), "d").collect() == []


def test_date_dimension_types(spark):
    days = date_dimension(spark.createDataFrame([(date(2024, 2, 10),)], "d date"), "d")
    assert days.count() == 29
    assert [t for _, t in days.dtypes] == [
        "int", "date", "int", "int", "int", "string", "int", "string", "boolean",
    ]


# --- skew and lookups --------------------------------------------------------------------


def test_hot_hashes(spark):
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, 0, id) AS k")
    assert len(hot_hashes(df, ["k"], 500)) == 1
    assert hot_hashes(df, ["k"], 2000) == []
    big = spark.range(400_000).selectExpr("IF(id % 3 = 0, 0, id) AS k")
    assert len(hot_hashes(big, ["k"], 100_000)) == 1


def test_measures(spark):
    df = spark.createDataFrame([(1, "abc"), (1, None), (2, "x")], "k int, s string")
    assert measure(df, ["k"]) == (3 * 32 + 4, 2)
    assert measure(df.limit(0), ["k"]) == (0, 0)
    assert measure(df.select("k", F.array("s").alias("a")), ["k"])[0] is None
    assert fits_broadcast(df, ["k"], 100) and not fits_broadcast(df, ["k"], 99)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [5, 10**6])
def test_salted_join_is_a_join(spark, how, hot_rows):
    left = spark.createDataFrame(
        [(None if n % 11 == 0 else (0 if n % 3 == 0 else n), f"l{n}") for n in range(300)],
        "k int, v string",
    )
    right = spark.createDataFrame([(n, f"r{n}") for n in range(0, 300, 2)], "k bigint, w string")
    expected = left.join(right, "k", how)
    found = salted_join(left, right, ["k"], how, hot_rows, salts=4)
    assert found.columns == expected.columns
    assert rows(found) == rows(expected)


def test_salted_join_refuses_other_types(spark):
    with pytest.raises(ValueError):
        salted_join(spark.range(1), spark.range(1), ["id"], "full")


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_lookup_keeps_every_fact(spark, broadcast_bytes):
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 30), (3, 30)], "id int, p int")
    dim = spark.createDataFrame([(10, 7), (20, 8)], "pid int, sk int")
    found = lookup(fact, dim, {"p": "pid"}, {"psk": "sk"}, broadcast_bytes)
    assert rows(found) == [(1, 10, 7), (2, None, None), (3, 30, None), (3, 30, None)]


DIM = "cid int, sk bigint, valid_from date, valid_to date"


@pytest.mark.parametrize("broadcast_bytes,hot_rows", [(1 << 20, 10**6), (0, 10**6), (0, 1)])
def test_point_in_time_lookup_at_the_edges(spark, broadcast_bytes, hot_rows):
    dim = spark.createDataFrame(
        [(1, 1, date(2024, 1, 1), date(2024, 2, 29)), (1, 2, date(2024, 3, 1), OPEN),
         (2, 3, date(2024, 1, 1), date(2024, 1, 31)), (None, 9, date(2024, 1, 1), OPEN)],
        DIM,
    )
    expected = [
        (1, date(2023, 12, 31), None), (1, date(2024, 1, 1), 1), (1, date(2024, 2, 29), 1),
        (1, date(2024, 3, 1), 2), (1, date(2024, 3, 1), 2), (1, None, None),
        (2, date(2024, 1, 31), 3), (2, date(2024, 2, 1), None), (3, date(2024, 1, 5), None),
        (None, date(2024, 1, 5), None),
    ]
    fact = spark.createDataFrame([r[:2] for r in expected], "c int, day date")
    found = lookup_scd2(
        fact, dim, {"c": "cid"}, "day", {"sk": "sk"}, "closed", broadcast_bytes, hot_rows
    )
    order = lambda r: str(r)
    assert sorted((tuple(r) for r in found.collect()), key=order) == sorted(expected, key=order)


@pytest.mark.parametrize("hot_rows", [10**6, 60, 1])
def test_long_histories_against_a_join(spark, hot_rows):
    chance = random.Random(4)
    at = lambda: datetime(2024, 1, 1, chance.randrange(24), chance.randrange(60))
    dim = []
    for key in range(4):
        starts = sorted({at() for _ in range(150 if key == 0 else 10)})
        dim += [(key, n, s, e) for n, (s, e) in enumerate(zip(starts, [*starts[1:], None]))]
    dim = spark.createDataFrame(dim, "k int, sk int, __START_AT timestamp, __END_AT timestamp")
    listed = [(0 if n % 3 == 0 else chance.randrange(5), n, at()) for n in range(400)]
    fact = spark.createDataFrame(listed, "k int, n int, at timestamp").repartition(5)
    joined = fact.join(
        dim.withColumnRenamed("k", "k2"),
        F.expr("k = k2 AND at >= __START_AT AND (__END_AT IS NULL OR at < __END_AT)"),
        "left",
    ).select("k", "n", "at", "sk")
    with spark_slices(spark, 6):
        found = lookup_scd2(
            fact, dim, {"k": "k"}, "at", {"sk": "sk"}, "half_open", hot_rows=hot_rows
        )
        assert rows(found) == rows(joined)


def test_lookup_refuses_dates_against_other_types(spark):
    dim = spark.createDataFrame([(1, 1, date(2024, 1, 1), OPEN)], DIM)
    fact = spark.createDataFrame([(1, "2024-01-01")], "c int, day string")
    with pytest.raises(ValueError, match="day"):
        lookup_scd2(fact, dim, {"c": "cid"}, "day", {"sk": "sk"})


# --- data tests --------------------------------------------------------------------------


def test_expectations_drop_count_and_treat_unknown_as_not_met(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (None, 6), (3, None), (4, -1)], "id int, v int")
    expected = {"has_id": F.col("id").isNotNull(), "positive": F.col("v") > 0}
    kept, seen = quality.expect_or_drop(df, expected)
    kept.write.parquet(str(tmp_path / "kept"))
    assert seen.get == {"rows": 4, "has_id": 1, "positive": 2}
    assert rows(spark.read.parquet(str(tmp_path / "kept"))) == [(1, 5)]
    good, bad = quality.split_rejects(df, expected)
    assert rows(good) == [(1, 5)]
    assert sorted((r.failed_rules for r in bad.collect())) == [
        ["has_id"], ["positive"], ["positive"],
    ]
    counts = {r.rule: r.dropped for r in quality.expectation_counts(df, expected).collect()}
    assert counts == {"has_id": 1, "positive": 2}


def test_declared_tests(spark):
    child = spark.createDataFrame([(1, 10), (1, 20), (None, 99), (2, None), (3, 99)], "k int, f int")
    parent = spark.createDataFrame([(10,), (20,)], "id int")
    found = quality.report(
        quality.column_tests(child, "c", ["k", "f"], {"k": [1, 2]}),
        quality.unique(child, "c", ["k"]),
        quality.relationships(child, "c", "f", parent, "id"),
    )
    assert [tuple(r) for r in found.collect()] == [
        ("c", "not_null", "k", 1, "FAIL"),
        ("c", "not_null", "f", 1, "FAIL"),
        ("c", "accepted_values", "k", 1, "FAIL"),
        ("c", "unique", "k", 1, "FAIL"),
        ("c", "relationships", "f", 2, "FAIL"),
    ]


def test_relationships_count_per_value_before_a_large_join(spark):
    child = spark.range(1000).selectExpr("id % 3 AS f")
    parent = spark.range(2).selectExpr("id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = quality.relationships(child, "c", "f", parent, "id")
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("LeftAnti") < plan.index("Aggregate [f")
        assert df.first()["failures"] == 333
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tests_on_an_empty_table(spark):
    empty = spark.createDataFrame([], "k int")
    found = quality.report(
        quality.column_tests(empty, "e", ["k"], {"k": [1]}),
        quality.unique(empty, "e", ["k"]),
        quality.relationships(empty, "e", "k", empty, "k"),
    )
    assert {(r.failures, r.status) for r in found.collect()} == {(0, "PASS")}


# --- reconciliation ----------------------------------------------------------------------


def test_content_check(spark):
    cols = "k int, v string, w string"
    a = spark.createDataFrame([(1, "x", None), (2, "y", "z"), (3, "q", "q")], cols)
    b = spark.createDataFrame([(1, None, "x"), (2, "y", "z")], cols)
    found = reconcile.content_check({"a": a, "b": b}, ["k"], ["v", "w"])
    assert rows(found) == [(1, 2, 2, "FAIL"), (2, 1, 2, "PASS"), (3, 1, 1, "FAIL")]
    only = reconcile.content_check({"a": a, "b": b}, ["k"], ["v", "w"], only_mismatches=True)
    assert [r[0] for r in rows(only)] == [1, 3]


def test_counts_and_summary(spark):
    tables = {
        ("one", "t"): spark.range(3), ("two", "t"): spark.range(4), ("three", "t"): spark.range(0),
        ("one", "u"): spark.range(2),
    }
    checks = reconcile.count_check(tables, {"t": 3, "u": 2})
    assert rows(checks.select("variant", "table_name", "row_count", "status")) == [
        ("one", "t", 3, "PASS"), ("one", "u", 2, "PASS"), ("three", "t", 0, "FAIL"),
        ("two", "t", 4, "FAIL"),
    ]
    found = {r.table_name: r for r in reconcile.summary(checks).collect()}
    assert (found["t"].variants_passing, found["t"].total_variants) == (1, 3)
    assert found["t"].failing_variants == "three=0, two=4"
    assert (found["t"].overall_status, found["u"].overall_status) == ("SOME FAIL", "ALL PASS")
    assert found["u"].failing_variants == ""
