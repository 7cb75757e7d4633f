"""The transaction fact of a star: one row per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.dates import date_key
from strata.operators.lookup import lookup, lookup_scd2
from strata.operators.ordered import dense_numbers, group_starts
from strata.operators.skew import BROADCAST_BYTES, HOT_ROWS, HotKeys, hot_keys, salted_join
from strata.parallel import together

MEASURES = ["quantity", "unit_price", "discount_pct", "line_amount"]


def build_fact(
    lines: DataFrame,
    orders: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    encoding: str = "closed",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Lines with their order, the customer version of the order date, product and date key.

    A line without an order is left out; a customer or product that is not found is NULL.

    The customer is looked up per order, before the orders fan out into lines: far fewer rows
    search the history. Fact rows are numbered in the order of order and line by adding a line's
    place in its order to the rows of earlier orders, which are counted on order numbers alone;
    the lines themselves travel once, to their order. Orders beyond ``hot_rows`` lines are
    numbered by a sort over all tasks instead. Give stored tables: they are read for the counts
    before they are joined.
    """

    def priced() -> DataFrame:
        return lookup(
            lines.select("order_id", "line_id", "product_id", *MEASURES),
            dim_product,
            {"product_id": "product_id"},
            {"product_sk": "product_sk"},
            broadcast_bytes,
            hot_rows,
        ).drop("product_id")

    def headers() -> DataFrame:
        return lookup_scd2(
            orders.select(
                "order_id", "customer_id", "order_date", F.col("status").alias("order_status")
            ),
            dim_customer,
            {"customer_id": "customer_id"},
            "order_date",
            {"customer_sk": "customer_sk"},
            encoding,
            broadcast_bytes,
            hot_rows,
        ).select(
            "order_id", "customer_sk", date_key("order_date").alias("order_date_key"), "order_status"
        )

    found = together(
        {
            "lines": priced,
            "headers": headers,
            "starts": lambda: _first_numbers(lines, orders),
            "hot": lambda: hot_keys(lines, ["order_id"], hot_rows),
        }
    )
    rows = found["lines"]
    header = found["headers"].join(found["starts"], "order_id")
    hot = found["hot"]
    in_order = Window.partitionBy("order_id").orderBy("line_id")
    place = F.row_number().over(in_order)
    if not hot:
        return _numbered(rows.join(header, "order_id"), place)

    (few, many), (few_headers, many_headers) = hot.split(rows), hot.split(header)
    usual = _numbered(few.join(few_headers, "order_id"), place)
    spread = _per_hot_order(many, many_headers, hot, hot_rows)
    spread = dense_numbers(spread, ["order_id", "line_id"], "_number")
    firsts = spread.groupBy("order_id").agg(F.min("_number").alias("_first"))
    spread = _per_hot_order(spread, firsts, hot, hot_rows)
    return usual.unionByName(_numbered(spread, F.col("_number") - F.col("_first") + 1))


def _per_hot_order(rows: DataFrame, per_order: DataFrame, hot: HotKeys, hot_rows: int) -> DataFrame:
    """Lines of hot orders with what there is once per order, which is broadcast only if it is short."""
    if hot.few:
        return rows.join(F.broadcast(per_order), "order_id")
    return salted_join(rows, per_order, ["order_id"], "inner", hot_rows, hot=hot)


def _first_numbers(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Per order with lines: how many fact rows come before it."""
    sizes = lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("_lines"))
    return group_starts(orders.select("order_id").join(sizes, "order_id"), "order_id", "_lines", "_start")


def _numbered(rows: DataFrame, place: Column) -> DataFrame:
    return rows.select(
        (F.col("_start") + place).cast("bigint").alias("order_line_sk"),
        *["order_id", "line_id", "customer_sk", "product_sk", "order_date_key"],
        *MEASURES,
        "order_status",
    )
