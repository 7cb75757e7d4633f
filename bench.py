"""Time the headline jobs; prints one JSON line.

Each job is run once to warm up and then BENCH_RUNS times (5); the figure is the median of
building the plan and writing every column of the full result. ``naive`` holds the same
results by the form a first draft would take.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks.inputs import DATES, RAW, table  # noqa: E402
from checks.queries import QUERIES, _compared, _counted, _silver, _versions  # noqa: E402
from strata.functions.batches import OPEN_END  # noqa: E402
from strata.plans import retail  # noqa: E402
from strata.scratch import drop_scratch  # noqa: E402
from strata.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))

HEADLINE = [
    "latest_wins_lines",
    "latest_wins_events_aggregated",
    "dim_product",
    "dim_date_orders",
    "dim_customer_compare",
    "dim_customer_history",
    "event_type_history",
    "event_history_latest_policy",
    "event_history_hot_users",
    "surrogate_keys_lines",
    "fact_closed",
    "fact_half_open",
    "lookup_long_history",
    "quarantine_rejects",
    "dq_relationships",
    "count_check",
    "content_check_product",
    "cdc_apply_stream",
    "ingest_stream",
]


# --- naive forms -------------------------------------------------------------------------


def naive_surrogate_keys(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    everything = Window.orderBy("l_orderkey", "l_linenumber")
    return lines.select(F.row_number().over(everything).alias("line_sk"), "*")


def naive_compare(spark, sf):
    """Each of the five groups by a join of its own."""
    states = _versions(spark, sf).drop("_batch_id", "_batch_no")
    old = states.filter(F.col("_effective") == DATES["batch_1"])
    new = states.filter(F.col("_effective") == DATES["batch_2"])
    both = old.alias("o").join(new.alias("n"), "customer_id")
    differs = F.lit(False)
    for c in retail.TRACKED:
        differs = differs | (F.col(f"o.{c}") != F.col(f"n.{c}"))
    last_day = F.date_sub(F.lit(DATES["batch_2"]), 1)
    groups = [
        (old.join(new, "customer_id", "left_anti"), None),
        (both.filter(differs).select("o.*"), last_day),
        (both.filter(differs).select("n.*"), None),
        (both.filter(~differs).select("o.*"), None),
        (new.join(old, "customer_id", "left_anti"), None),
    ]
    union = None
    for rows, end in groups:
        valid = rows.withColumnRenamed("_effective", "valid_from").withColumns(
            {
                "valid_to": F.lit(OPEN_END) if end is None else end,
                "is_current": F.lit(end is None),
            }
        )
        union = valid if union is None else union.unionByName(valid)
    numbered = Window.orderBy("customer_id", "valid_from")
    return union.withColumn("customer_sk", F.row_number().over(numbered))


def naive_fact(spark, sf):
    customers = _compared(spark, sf)
    customers = customers.withColumn(
        "customer_sk", F.row_number().over(Window.orderBy("customer_id", "valid_from"))
    ).select("customer_sk", F.col("customer_id").alias("c_id"), "valid_from", "valid_to")
    products = _silver(spark, sf, "products").select(
        F.row_number().over(Window.orderBy("product_id")).alias("product_sk"), "product_id"
    )
    rows = _silver(spark, sf, "order_lines").join(_silver(spark, sf, "orders"), "order_id")
    valid = F.col("order_date").between(F.col("valid_from"), F.col("valid_to"))
    rows = rows.join(customers, (F.col("customer_id") == F.col("c_id")) & valid, "left")
    rows = rows.join(products, "product_id", "left")
    return rows.select(
        F.row_number().over(Window.orderBy("order_id", "line_id")).alias("order_line_sk"),
        "order_id",
        "line_id",
        "customer_sk",
        "product_sk",
        F.date_format("order_date", "yyyyMMdd").cast("int").alias("order_date_key"),
        *["quantity", "unit_price", "discount_pct", "line_amount", "status"],
    )


def naive_date_dimension(spark, sf):
    first, last = (
        table(spark, sf, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    )
    span = f"explode(sequence(date'{first:%Y-%m-01}', last_day(date'{last:%Y-%m-%d}')))"
    days = spark.range(1).select(F.expr(span).alias("d"))
    return days.select(
        F.date_format("d", "yyyyMMdd").cast("int").alias("date_key"),
        F.col("d").alias("full_date"),
        F.year("d").alias("year"),
        F.quarter("d").alias("quarter"),
        F.month("d").alias("month"),
        F.date_format("d", "MMMM").alias("month_name"),
        F.dayofweek("d").alias("day_of_week"),
        F.date_format("d", "EEEE").alias("day_name"),
        F.dayofweek("d").isin(1, 7).alias("is_weekend"),
    )


def naive_counts(spark, sf):
    tables = {"customers": "customer", "products": "part", "orders": "orders"}
    expected = {name: table(spark, sf, source).count() for name, source in tables.items()}
    found = [
        (name, variant, expected[name], n, "PASS" if n == expected[name] else "FAIL")
        for (variant, name), df in _counted(spark, sf).items()
        if name in expected
        for n in [df.count()]
    ]
    columns = "table_name string, variant string, expected_rows bigint, row_count bigint, status string"
    return spark.createDataFrame(found, columns).orderBy("table_name", "variant")


def naive_latest(spark, sf):
    """The last event per user by joining the largest place back."""
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    last = events.groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("m"))
    last = last.select("user_id", "m.ts", "m.event_id")
    return events.join(last, ["user_id", "ts", "event_id"])


def naive_content(spark, sf):
    ours = _silver(spark, sf, "products").withColumn("variant", F.lit("ours"))
    raised = F.when(F.col("category") == "Brand#1", F.col("unit_price") + 1).otherwise(F.col("unit_price"))
    theirs = ours.filter("subcategory <> 'SMALL'").withColumns(
        {"unit_price": raised.cast("decimal(10,2)"), "variant": F.lit("theirs")}
    )
    columns = ["product_name", "category", "subcategory", F.col("unit_price").cast("string")]
    both = ours.unionByName(theirs)
    hashed = both.select("product_id", "variant", F.md5(F.concat_ws("|", *columns)).alias("h"))
    found = hashed.groupBy("product_id").agg(
        F.count_distinct("h").alias("distinct_hashes"), F.count_distinct("variant").alias("variant_count")
    )
    agreed = (F.col("distinct_hashes") == 1) & (F.col("variant_count") == 2)
    return found.withColumn("status", F.when(agreed, "PASS").otherwise("FAIL")).orderBy("product_id")


NAIVE = {
    "latest_wins_events_aggregated": naive_latest,
    "content_check_product": naive_content,
    "surrogate_keys_lines": naive_surrogate_keys,
    "dim_customer_compare": naive_compare,
    "fact_closed": naive_fact,
    "dim_date_orders": naive_date_dimension,
    "count_check": naive_counts,
}


def seconds(spark, fn) -> float:
    began = time.perf_counter()
    fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def median(spark, fn) -> float:
    seconds(spark, fn)
    measured = statistics.median(seconds(spark, fn) for _ in range(RUNS))
    spark.catalog.clearCache()
    return round(measured, 3)


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        int(CPUS),
        **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    times = {name: median(spark, QUERIES[name]) for name in names}
    naive = {name: median(spark, NAIVE[name]) for name in names if name in NAIVE}
    lines = table(spark, SF_DIR, "lineitem").count()
    drop_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "naive": naive,
                "lineitem_rows": lines,
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
