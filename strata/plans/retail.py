"""The retail star: what its four inputs look like and how they are cleaned."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.batches import batch_number, effective_date
from strata.functions.money import amount_of, line_amount
from strata.functions.text import lowered, parsed, squeezed, titled, uppered
from strata.operators.clean import latest_wins, standardize, with_keys
from strata.operators.dims import date_dimension, surrogate_key
from strata.operators.fact import build_fact
from strata.operators.history import END_AT, IS_CURRENT, START_AT, VALID_FROM, VALID_TO

# Columns of the input files, business keys, tracked and carried attributes.
COLUMNS = {
    "customers": [
        "customer_id", "customer_name", "email", "address", "city", "country", "segment",
    ],
    "products": ["product_id", "product_name", "category", "subcategory", "unit_price"],
    "orders": ["order_id", "customer_id", "order_date", "status"],
    "order_lines": [
        "order_id", "line_id", "product_id", "quantity", "unit_price", "discount_pct",
    ],
}
KEYS = {
    "customers": ["customer_id"],
    "products": ["product_id"],
    "orders": ["order_id"],
    "order_lines": ["order_id", "line_id"],
}
TRACKED = ["email", "address", "city", "country", "segment"]
CARRIED = ["customer_name"]
GOLD = ["dim_customer", "dim_product", "dim_date", "fact_order_line"]


def rules(entity: str, id_type: str = "int") -> dict[str, Column]:
    """Cleaning rules of an entity; ``id_type`` is the type of its identifiers."""
    return {
        "customers": {
            "customer_id": parsed("customer_id", id_type),
            "customer_name": squeezed("customer_name"),
            "email": lowered("email"),
            "address": squeezed("address"),
            "city": squeezed("city"),
            "country": uppered("country"),
            "segment": titled("segment"),
        },
        "products": {
            "product_id": parsed("product_id", id_type),
            "product_name": squeezed("product_name"),
            "category": squeezed("category"),
            "subcategory": squeezed("subcategory"),
            "unit_price": parsed("unit_price", "decimal(10,2)"),
        },
        "orders": {
            "order_id": parsed("order_id", id_type),
            "customer_id": parsed("customer_id", id_type),
            "order_date": parsed("order_date", "date"),
            "status": lowered("status"),
        },
        "order_lines": {
            "order_id": parsed("order_id", id_type),
            "line_id": parsed("line_id", "int"),
            "product_id": parsed("product_id", id_type),
            "quantity": parsed("quantity", "int"),
            "unit_price": parsed("unit_price", "decimal(10,2)"),
            "discount_pct": parsed("discount_pct", "decimal(5,2)"),
        },
    }[entity]


def expectations(entity: str) -> dict[str, Column]:
    """Rules a cleaned row has to meet: its key can be read."""
    known = F.lit(True)
    for key in KEYS[entity]:
        known = known & F.col(key).isNotNull()
    # The names of the expectations.
    label = {
        "customers": "valid_customer_id",
        "products": "valid_product_id",
        "orders": "valid_order_id",
        "order_lines": "valid_order_line_id",
    }[entity]
    return {label: known}


# Columns that are read as numbers or dates besides the keys.
_MEASURES = {
    "customers": {},
    "products": {"unit_price": "decimal(10,2)"},
    "orders": {"customer_id": None, "order_date": "date"},
    "order_lines": {
        "product_id": None,
        "quantity": "int",
        "unit_price": "decimal(10,2)",
        "discount_pct": "decimal(5,2)",
    },
}


def readable(entity: str, id_type: str = "int") -> dict[str, Column]:
    """Rules on raw rows: what is there can be read as its type.

    A row that breaks one is kept with a NULL in that place; the rules are there to be counted.
    """
    rules = {}
    for name, kind in _MEASURES[entity].items():
        blank = F.col(name).isNull() | (squeezed(name) == "")
        rules[f"readable_{name}"] = blank | parsed(name, kind or id_type).isNotNull()
    if entity == "order_lines":
        parts = {n: parsed(n, k) for n, k in _MEASURES[entity].items() if k}
        known = F.lit(True)
        for part in parts.values():
            known = known & part.isNotNull()
        rules["amount_fits"] = ~known | amount_of(**parts).isNotNull()
    return rules


def typed(raw: DataFrame, entity: str, id_type: str = "int") -> DataFrame:
    """Every raw row cleaned, with its batch; nothing is dropped yet."""
    rows = standardize(raw, rules(entity, id_type), keep=["_batch_id"])
    if entity == "order_lines":
        amount = line_amount("quantity", "unit_price", "discount_pct")
        rows = rows.withColumn("line_amount", amount)
    return rows


def latest_order(rows: DataFrame, entity: str) -> list[Column | str]:
    """By batch; equal batches are settled by the other columns."""
    others = [c for c in rows.columns if c not in KEYS[entity] and c != "_batch_id"]
    return [batch_number("_batch_id"), *others]


def latest(rows: DataFrame, entity: str) -> DataFrame:
    """The row of the latest batch per key; see :func:`latest_order`."""
    return latest_wins(with_keys(rows, KEYS[entity]), KEYS[entity], latest_order(rows, entity))


def silver(raw: DataFrame, entity: str, id_type: str = "int") -> DataFrame:
    """Cleaned, one row per key, without lineage."""
    return latest(typed(raw, entity, id_type), entity).drop("_batch_id")


def customer_versions(
    raw: DataFrame, dates: Mapping[str, date], id_type: str = "int"
) -> DataFrame:
    """Every batch's states of every customer, cleaned and dated.

    ``_batch_no`` tells batches of one date apart, the later one counts. A customer may occur
    twice in a batch; the history settles that by the values.
    """
    return dated(with_keys(typed(raw, "customers", id_type), KEYS["customers"]), dates)


def dated(rows: DataFrame, dates: Mapping[str, date]) -> DataFrame:
    """Rows with the date and the number of their batch, by which history is ordered."""
    return rows.withColumns(
        {"_effective": effective_date("_batch_id", dict(dates)), "_batch_no": batch_number("_batch_id")}
    )


# What settles several states of a customer on one date: the batch, and then the values.
SETTLED_BY = ["_batch_no", *CARRIED, *TRACKED]


def batch_state(versions: DataFrame, batch: str) -> DataFrame:
    """One batch of :func:`customer_versions` with one row per customer."""
    return latest_wins(versions.filter(F.col("_batch_id") == batch), KEYS["customers"], SETTLED_BY)


def date_state(versions: DataFrame, effective: date) -> DataFrame:
    """All batches of a date, with the latest row of each customer."""
    rows = versions.filter(F.col("_effective") == F.lit(effective))
    return latest_wins(rows, KEYS["customers"], SETTLED_BY)


def dim_customer(history: DataFrame, encoding: str = "closed") -> DataFrame:
    """Customer history with its key in front, in the order of customer and start."""
    validity = [VALID_FROM, VALID_TO, IS_CURRENT] if encoding == "closed" else [START_AT, END_AT]
    rows = history.select(*COLUMNS["customers"], *validity)
    return surrogate_key(rows, ["customer_id", validity[0]], "customer_sk")


def dim_product(products: DataFrame) -> DataFrame:
    return surrogate_key(products.select(*COLUMNS["products"]), KEYS["products"], "product_sk")


def dim_date(orders: DataFrame) -> DataFrame:
    return date_dimension(orders, "order_date")


def fact_order_line(lines, orders, customers, products, encoding: str = "closed") -> DataFrame:
    return build_fact(lines, orders, customers, products, encoding)
