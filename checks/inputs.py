"""The retail star's inputs, derived from the driver's tables as text in batches.

Customers come in two batches: the first lacks one market segment, the second another, and in
the second some have moved and some only changed their name. Orders come whole, and urgent
ones again with a corrected status. Lines belong to the batch of their shipping year, and
some keys occur several times.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATES = {"batch_1": date(1995, 1, 1), "batch_2": date(1998, 1, 1)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(value: str | Column) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.concat(F.lit("  "), column.cast("string"), F.lit(" "))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    rows = table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    batches = F.array_compact(
        F.array(
            F.when(F.col("c_mktsegment") != "BUILDING", F.lit("batch_1")),
            F.when(F.col("c_mktsegment") != "AUTOMOBILE", F.lit("batch_2")),
        )
    )
    rows = rows.withColumn("_batch_id", F.explode(batches))
    second = F.col("_batch_id") == "batch_2"
    moved = second & (F.col("c_acctbal") < 2500)
    renamed = second & (F.col("c_acctbal") >= 2500) & (F.col("c_acctbal") < 4000)
    home = F.concat(F.lit("City "), F.col("c_nationkey").cast("string"))
    return rows.select(
        _text("c_custkey").alias("customer_id"),
        _text(F.when(renamed, F.concat("c_name", F.lit(" Jr"))).otherwise(F.col("c_name"))).alias(
            "customer_name"
        ),
        _text(F.concat(F.upper("c_name"), F.lit("@Example.COM"))).alias("email"),
        _text(F.concat(F.lit("Street "), F.col("c_nationkey").cast("string"))).alias("address"),
        _text(F.when(moved, F.lit("Elsewhere")).otherwise(home)).alias("city"),
        _text(F.lower("n_name")).alias("country"),
        _text(F.lower("c_mktsegment")).alias("segment"),
        "_batch_id",
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("product_id"),
        _text("p_name").alias("product_name"),
        _text("p_brand").alias("category"),
        _text("p_type").alias("subcategory"),
        _text(F.col("p_retailprice").cast("decimal(10,2)")).alias("unit_price"),
        F.lit("batch_1").alias("_batch_id"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = F.col("o_orderpriority") == "1-URGENT"
    batches = F.array_compact(
        F.array(F.lit("batch_1"), F.when(urgent, F.lit("batch_2")))
    )
    rows = table(spark, sf_dir, "orders").withColumn("_batch_id", F.explode(batches))
    corrected = F.col("_batch_id") == "batch_2"
    return rows.select(
        _text("o_orderkey").alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        _text(F.col("o_orderdate").cast("date")).alias("order_date"),
        _text(F.when(corrected, F.lit("COMPLETED")).otherwise(F.col("o_orderstatus"))).alias(
            "status"
        ),
        "_batch_id",
    )


def raw_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = (F.year("l_shipdate") - 1994).cast("string")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("line_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").cast("string").alias("unit_price"),
        (F.col("l_discount").cast("decimal(5,2)") * 100).cast("string").alias("discount_pct"),
        F.concat(F.lit("batch_"), shipped).alias("_batch_id"),
    )


RAW = {
    "customers": raw_customers,
    "products": raw_products,
    "orders": raw_orders,
    "order_lines": raw_order_lines,
}
