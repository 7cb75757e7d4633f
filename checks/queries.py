"""One DataFrame per job over the driver's tables; names and columns match ``oracle.py``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import DATES, RAW, table
from strata.functions.batches import batch_number
from strata.functions.text import parsed
from strata.operators import history as hist
from strata.operators import quality, reconcile
from strata.operators.clean import (
    latest_wins,
    latest_wins_aggregated,
    standardize,
    with_keys,
)
from strata.operators.dims import date_dimension, surrogate_key
from strata.operators.fact import build_fact
from strata.operators.hashtree import content_check_by_ranges
from strata.operators.lookup import lookup, lookup_scd2
from strata.operators.registry import stable_keys
from strata.operators.snapshots import read_snapshots, take_snapshot
from strata.operators.skew import salted_join
from strata.parallel import together
from strata.plans import layers, retail
from strata.scratch import materialise, scratch_path
from strata.sources import appends, evolving, tables
from strata.sources.bucketed import write_bucketed
from strata.sources.files import read_batches, write_batch
from strata.streaming import compacted
from strata.streaming.changes import apply_changes, read_history
from strata.streaming.ingest import append_available, load_once, stream_batches, stream_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ID = "bigint"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _silver(spark, sf, entity):
    return retail.silver(RAW[entity](spark, sf), entity, ID)


def _stored(spark, sf, entity):
    return materialise(_silver(spark, sf, entity), entity)


def _versions(spark, sf):
    return retail.customer_versions(RAW["customers"](spark, sf), DATES, ID)


def _compared(spark, sf):
    states = _versions(spark, sf)
    return hist.scd2_compare(
        retail.batch_state(states, "batch_1"),
        retail.batch_state(states, "batch_2"),
        ["customer_id"],
        retail.TRACKED,
        retail.CARRIED,
        DATES["batch_1"],
        DATES["batch_2"],
    )


def _customer_history(spark, sf, encoding):
    return hist.scd2_history(
        _versions(spark, sf),
        ["customer_id"],
        "_effective",
        retail.TRACKED,
        retail.CARRIED,
        encoding=encoding,
    )


# --- cleaning ----------------------------------------------------------------------------


@query
def standardize_customers(spark, sf):
    return retail.typed(RAW["customers"](spark, sf), "customers", ID)


@query
def standardize_parts(spark, sf):
    return retail.typed(RAW["products"](spark, sf), "products", ID).drop("_batch_id")


@query
def standardize_orders(spark, sf):
    return retail.typed(RAW["orders"](spark, sf), "orders", ID)


@query
def line_amounts(spark, sf):
    return retail.typed(RAW["order_lines"](spark, sf), "order_lines", ID)


@query
def unreadable_values(spark, sf):
    """Values that are no numbers become NULL and are counted, never an error."""
    identifier = F.concat(
        F.when(F.col("event_type") == "view", F.lit(" ")).otherwise(F.lit("no. ")),
        F.col("event_id").cast("string"),
    )
    rows = table(spark, sf, "events").select("event_type", identifier.alias("text"))
    return rows.select("event_type", "text", parsed("text", "bigint").alias("number"))


@query
def unreadable_measures(spark, sf):
    """Quantities and prices that are no numbers, and amounts beyond their type, counted."""
    raw = RAW["order_lines"](spark, sf)
    wrong = F.col("line_id") == "3"
    raw = raw.withColumns(
        {
            "quantity": F.when(wrong, F.lit("bad")).otherwise(F.col("quantity")),
            "unit_price": F.when(F.col("line_id") == "4", F.lit("99999999999.00"))
            .when(F.col("line_id") == "5", F.lit("99999999.00"))
            .otherwise(F.col("unit_price")),
        }
    )
    raw = raw.withColumn("quantity", F.when(F.col("line_id") == "5", F.lit("999999")).otherwise(F.col("quantity")))
    return quality.expectation_counts(raw, retail.readable("order_lines", ID))


@query
def select_batch(spark, sf):
    """One batch out of the cleaned rows of all batches."""
    rows = retail.typed(RAW["order_lines"](spark, sf), "order_lines", ID)
    picked = rows.filter(batch_number("_batch_id") == 3)
    return picked.select("order_id", "line_id", "product_id", "line_amount")


# --- latest wins -------------------------------------------------------------------------


@query
def latest_wins_lines(spark, sf):
    return _silver(spark, sf, "order_lines")


@query
def latest_wins_events(spark, sf):
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return latest_wins(events, ["user_id"], ["ts", "event_id"])


@query
def latest_wins_events_aggregated(spark, sf):
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return latest_wins_aggregated(events, ["user_id"], ["ts", "event_id"])


@query
def latest_wins_correction(spark, sf):
    return _silver(spark, sf, "orders")


# --- expectations ------------------------------------------------------------------------


def _events_with_gaps(spark, sf):
    """Events in which errors have lost their user and clicks below 1 their type."""
    lost_type = (F.col("event_type") == "click") & (F.col("value") < 1)
    return table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
        F.when(~lost_type, F.col("event_type")).alias("event_type"),
        "value",
    )


def _event_rules():
    return {
        "valid_user": F.col("user_id").isNotNull(),
        "known_type": F.col("event_type").isin("view", "click", "purchase", "signup", "error"),
        "small_value": F.col("value") < 100,
    }


@query
def reject_null_keys(spark, sf):
    rows = _events_with_gaps(spark, sf)
    kept, _ = quality.expect_or_drop(rows, {"valid_user": F.col("user_id").isNotNull()})
    return with_keys(kept, ["user_id", "event_type"])


@query
def expectation_counts(spark, sf):
    return quality.expectation_counts(_events_with_gaps(spark, sf), _event_rules())


@query
def quarantine_rejects(spark, sf):
    _, bad = quality.split_rejects(_events_with_gaps(spark, sf), _event_rules())
    return bad.select("event_id", "user_id", F.array_join("failed_rules", ",").alias("failed_rules"))


# --- dimensions and keys -----------------------------------------------------------------


@query
def dim_product(spark, sf):
    return retail.dim_product(_silver(spark, sf, "products"))


@query
def dim_date_orders(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("order_date"))
    return date_dimension(orders, "order_date")


@query
def scd1_customers(spark, sf):
    """Latest state of every customer over all batches, with a key."""
    rows = retail.typed(RAW["customers"](spark, sf), "customers", ID)
    order = [batch_number("_batch_id"), *retail.CARRIED, *retail.TRACKED]
    return hist.scd1(with_keys(rows, ["customer_id"]), ["customer_id"], order, "customer_sk")


@query
def surrogate_keys_lines(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return surrogate_key(lines, ["l_orderkey", "l_linenumber"], "line_sk")


@query
def surrogate_keys_text(spark, sf):
    """Keys in the order of a text column."""
    names = table(spark, sf, "part").select("p_name", "p_brand", "p_type").distinct()
    return surrogate_key(names, ["p_name", "p_brand", "p_type"], "name_sk")


@query
def surrogate_keys_stable(spark, sf):
    """Numbers of customer versions, built from the first batch and then from both."""
    registry = scratch_path(spark, "registry")
    history = _customer_history(spark, sf, "half_open")
    versions = materialise(history.select("customer_id", "__START_AT"), "versions")
    early = versions.filter(F.col("__START_AT") == F.lit(DATES["batch_1"]))
    by = ["customer_id", "__START_AT"]
    before = materialise(stable_keys(early, by, "first_sk", registry), "first-keys")
    renamed = stable_keys(versions, by, "first_sk", registry).withColumnRenamed("first_sk", "customer_sk")
    return renamed.join(before, by, "left").select(
        "customer_sk", "first_sk", "customer_id", F.col("__START_AT").alias("start")
    )


# --- history -----------------------------------------------------------------------------


@query
def dim_customer_compare(spark, sf):
    return retail.dim_customer(_compared(spark, sf))


@query
def dim_customer_history(spark, sf):
    return retail.dim_customer(_customer_history(spark, sf, "half_open"), "half_open")


@query
def dim_customer_fold(spark, sf):
    """Snapshots folded in one after the other, the last one twice."""
    states = _versions(spark, sf)
    fields = {f.name: f for f in states.schema.fields}
    attributes = [*retail.CARRIED, *retail.TRACKED]
    history = hist.empty_history(spark, [fields["customer_id"]], [fields[a] for a in attributes])
    for batch in ("batch_1", "batch_2", "batch_2"):
        snapshot = retail.batch_state(states, batch)
        history = hist.scd2_fold(
            history, snapshot, ["customer_id"], retail.TRACKED, retail.CARRIED, "_effective"
        )
    return retail.dim_customer(history)


@query
def history_ends_by_next(spark, sf):
    """Every batch state as a version that ends where the next one starts."""
    states = _versions(spark, sf).select("customer_id", "city", "segment", "_effective")
    return hist.end_by_next(states, ["customer_id"], "_effective", "closed")


@query
def history_normalised(spark, sf):
    return hist.to_closed(_customer_history(spark, sf, "half_open"))


@query
def history_half_open_again(spark, sf):
    return hist.to_half_open(_compared(spark, sf))


def _event_history(spark, sf, **options):
    events = table(spark, sf, "events")
    return hist.scd2_history(
        events,
        ["user_id"],
        "ts",
        ["event_type"],
        tiebreak=["event_id"],
        encoding="half_open",
        **options,
    )


@query
def event_type_history(spark, sf):
    return _event_history(spark, sf)


@query
def event_history_first_policy(spark, sf):
    events = table(spark, sf, "events")
    carried = hist.carried_except(events, ["user_id"], ["event_type"], leave_out=["ts", "props"])
    return _event_history(spark, sf, carried=carried, untracked="first")


@query
def event_history_latest_policy(spark, sf):
    return _event_history(spark, sf, carried=["value", "event_id"], untracked="latest")


@query
def event_history_hot_users(spark, sf):
    """The same history with the larger users cut into range slices."""
    per_user = table(spark, sf, "events").groupBy("user_id").count()
    middle = per_user.agg(F.percentile_approx("count", 0.5).alias("m")).first()["m"]
    return _event_history(
        spark, sf, carried=["value", "event_id"], untracked="latest", hot_rows=middle
    )


@query
def event_daily_state(spark, sf):
    """Many events per user and day: the last of a day counts, versions start on days."""
    events = table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    return hist.scd2_history(
        events, ["user_id"], "day", ["event_type"], tiebreak=["ts", "event_id"], encoding="closed"
    )


def _daily_kinds(spark, sf):
    """Closed history of a time of day: many states on one day, of which the last counts."""
    return hist.scd2_history(
        table(spark, sf, "events"), ["user_id"], "ts", ["event_type"], tiebreak=["event_id"]
    )


@query
def event_history_closed_from_times(spark, sf):
    return _daily_kinds(spark, sf)


def _same_day(spark, sf, **options):
    events = table(spark, sf, "events").select(
        "event_id", "user_id", F.col("ts").cast("date").alias("day")
    )
    kinds = {"kind": "event_type"}
    return lookup_scd2(
        events, _daily_kinds(spark, sf), {"user_id": "user_id"}, "day", kinds, "closed", **options
    )


@query
def lookup_same_day_changes(spark, sf):
    """Each event with its user's last state of the day."""
    return _same_day(spark, sf)


@query
def lookup_same_day_changes_without_broadcast(spark, sf):
    return _same_day(spark, sf, broadcast_bytes=0)


@query
def lookup_same_day_changes_hot_users(spark, sf):
    """The same with the rows of most users, and of one user and day, cut into slices."""
    return _same_day(spark, sf, broadcast_bytes=0, hot_rows=10)


# --- facts -------------------------------------------------------------------------------


def _history_in(spark, sf, encoding):
    if encoding == "closed":
        return _compared(spark, sf)
    return _customer_history(spark, sf, "half_open")


def _fact(spark, sf, encoding, **options):
    """Cleaned tables and dimensions stored side by side, then the fact out of them."""
    jobs = {e: partial(_stored, spark, sf, e) for e in ("order_lines", "orders")}
    jobs["dim_customer"] = lambda: retail.dim_customer(_history_in(spark, sf, encoding), encoding)
    jobs["dim_product"] = lambda: retail.dim_product(_silver(spark, sf, "products"))
    built = together(jobs)
    return build_fact(
        built["order_lines"],
        built["orders"],
        built["dim_customer"],
        built["dim_product"],
        encoding,
        **options,
    )


@query
def fact_closed(spark, sf):
    return _fact(spark, sf, "closed")


@query
def fact_half_open(spark, sf):
    return _fact(spark, sf, "half_open")


@query
def fact_without_broadcast(spark, sf):
    """The fact as built when no dimension fits in memory and many keys are hot."""
    return _fact(spark, sf, "closed", broadcast_bytes=0, hot_rows=6)


@query
def fact_bucketed(spark, sf):
    """The fact out of lines and orders that lie in buckets by order; they meet without a shuffle."""
    named = {e: f"{e}_{uuid.uuid4().hex}" for e in ("order_lines", "orders")}
    for entity, name in named.items():
        write_bucketed(_silver(spark, sf, entity), name, ["order_id"], 16)
    customers = materialise(retail.dim_customer(_history_in(spark, sf, "closed"), "closed"), "dim")
    products = materialise(retail.dim_product(_stored(spark, sf, "products")), "dim")
    lines, orders = (spark.table(name) for name in named.values())
    fact = materialise(retail.fact_order_line(lines, orders, customers, products), "fact")
    for name in named.values():
        spark.sql(f"DROP TABLE {name}")
    return fact


@query
def fact_unmatched(spark, sf):
    """Orders from before a customer's first version have no customer."""
    orders = _silver(spark, sf, "orders")
    dim = retail.dim_customer(_compared(spark, sf))
    rows = lookup_scd2(
        orders, dim, {"customer_id": "customer_id"}, "order_date", {"customer_sk": "customer_sk"}
    )
    return rows.groupBy(F.year("order_date").alias("order_year")).agg(
        F.count("*").alias("orders"), F.count_if(F.col("customer_sk").isNull()).alias("unmatched")
    )


def _banded(spark, sf, **options):
    events = table(spark, sf, "events")
    bands = hist.scd2_history(
        events.withColumn("band", F.floor(F.col("value") / 10).cast("int")),
        ["user_id"],
        "ts",
        ["band"],
        tiebreak=["event_id"],
        encoding="half_open",
    )
    return lookup_scd2(
        events.select("event_id", "user_id", "ts"),
        bands,
        {"user_id": "user_id"},
        "ts",
        {"band": "band"},
        "half_open",
        **options,
    )


@query
def lookup_long_history(spark, sf):
    """Each event with its user's band at the time, out of long histories."""
    return _banded(spark, sf, broadcast_bytes=0)


@query
def lookup_long_history_hot_users(spark, sf):
    per_user = table(spark, sf, "events").groupBy("user_id").count()
    middle = per_user.agg(F.percentile_approx("count", 0.5).alias("m")).first()["m"]
    return _banded(spark, sf, broadcast_bytes=0, hot_rows=int(middle * 1.4))


@query
def lookup_salted(spark, sf):
    """Suppliers of lines by a join that spreads the lines of the larger suppliers."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey"
    )
    named = salted_join(lines, suppliers, ["l_suppkey"], "left", hot_rows=400, salts=8)
    nations = table(spark, sf, "nation")
    named = lookup(named, nations, {"s_nationkey": "n_nationkey"}, {"nation": "n_name"})
    return named.select("l_orderkey", "l_linenumber", "s_name", "nation")


# --- declared tests ----------------------------------------------------------------------


@query
def dq_not_null(spark, sf):
    rows = _events_with_gaps(spark, sf)
    return quality.column_tests(rows, "events", ["event_id", "user_id", "event_type"])


@query
def dq_accepted(spark, sf):
    orders = table(spark, sf, "orders")
    accepted = {"o_orderstatus": ["O", "F"], "o_orderpriority": ["1-URGENT", "2-HIGH", "5-LOW"]}
    return quality.column_tests(orders, "orders", accepted=accepted)


@query
def dq_unique(spark, sf):
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return quality.report(
        quality.unique(lines, "lineitem", ["l_orderkey", "l_linenumber"]),
        quality.unique(orders, "orders", ["o_orderkey"]),
    )


@query
def dq_relationships(spark, sf):
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    urgent = orders.filter("o_orderpriority <> '1-URGENT'")
    return quality.report(
        quality.relationships(lines, "lineitem", "l_orderkey", orders, "o_orderkey"),
        quality.relationships(lines, "lineitem to non-urgent", "l_orderkey", urgent, "o_orderkey"),
    )


# --- reconciliation ----------------------------------------------------------------------


def _counted(spark, sf):
    found = {}
    for variant in ("all", "cleaned"):
        for entity in ("customers", "products", "orders"):
            rows = RAW[entity](spark, sf) if variant == "all" else _silver(spark, sf, entity)
            found[variant, entity] = rows
    found["cleaned", "nothing"] = table(spark, sf, "region").filter("r_regionkey < 0")
    return found


@query
def row_count_matrix(spark, sf):
    return reconcile.row_counts(_counted(spark, sf))


def _checked(spark, sf):
    expected = {
        "customers": table(spark, sf, "customer").count(),
        "products": table(spark, sf, "part").count(),
        "orders": table(spark, sf, "orders").count(),
    }
    return reconcile.count_check(_counted(spark, sf), expected)


@query
def count_check(spark, sf):
    return _checked(spark, sf)


@query
def reconcile_summary(spark, sf):
    return reconcile.summary(_checked(spark, sf))


@query
def content_check_product(spark, sf):
    """Two product tables, one with other prices and without one kind of product."""
    products = _silver(spark, sf, "products")
    raised = F.when(F.col("category") == "Brand#1", F.col("unit_price") + 1).otherwise(
        F.col("unit_price")
    )
    other = products.filter("subcategory <> 'SMALL'").withColumn(
        "unit_price", raised.cast("decimal(10,2)")
    )
    columns = ["product_name", "category", "subcategory", "unit_price"]
    variants = {"ours": products, "theirs": other}
    return reconcile.content_check(variants, ["product_id"], columns, ordered=True)


def _prices(spark, sf):
    parts = table(spark, sf, "part")
    raised = F.when(F.col("p_partkey") % 1000 == 0, F.col("p_size") + 1).otherwise(F.col("p_size"))
    return {
        "stored": parts,
        "raised": parts.withColumn("p_size", raised),
        "lost": parts.filter("p_partkey % 777 <> 0"),
    }


@query
def content_check_ranges(spark, sf):
    """Parts against copies in which some are different and some are lost, by ranges of hashes."""
    columns = ["p_name", "p_brand", "p_size"]
    return content_check_by_ranges(_prices(spark, sf), ["p_partkey"], columns)


@query
def content_check_ranges_mismatches(spark, sf):
    """Only those that differ, found in the ranges that differ."""
    columns = ["p_name", "p_brand", "p_size"]
    return content_check_by_ranges(
        _prices(spark, sf), ["p_partkey"], columns, only_mismatches=True, unique_keys=True
    )


@query
def content_check_ranges_fact(spark, sf):
    """Facts looked up in two encodings; no range differs."""
    columns = [
        "order_date_key", "quantity", "unit_price", "discount_pct", "line_amount", "order_status",
    ]
    variants = {e: materialise(_fact(spark, sf, e), "fact") for e in ("closed", "half_open")}
    return content_check_by_ranges(variants, ["order_id", "line_id"], columns)


@query
def content_check_customer(spark, sf):
    """History by comparison against history by change feed in the other encoding."""
    columns = [*retail.CARRIED, *retail.TRACKED, "valid_from", "valid_to"]
    variants = {
        "compared": _compared(spark, sf),
        "applied": hist.to_closed(_customer_history(spark, sf, "half_open")),
    }
    return reconcile.content_check(variants, ["customer_id", "valid_from"], columns)


@query
def content_check_date(spark, sf):
    """Calendars of orders and of shipments, of which one has a Friday wrong."""
    days = dim_date_orders(spark, sf)
    wrong = F.when(F.col("day_name") == "Friday", F.lit(True)).otherwise(F.col("is_weekend"))
    columns = [c for c in days.columns if c != "date_key"]
    variants = {"right": days, "wrong": days.withColumn("is_weekend", wrong)}
    return reconcile.content_check(variants, ["date_key"], columns, only_mismatches=True)


@query
def content_check_fact(spark, sf):
    columns = [
        "order_date_key", "quantity", "unit_price", "discount_pct", "line_amount", "order_status",
    ]
    variants = together({e: partial(_fact, spark, sf, e) for e in ("closed", "half_open")})
    return reconcile.content_check(variants, ["order_id", "line_id"], columns)


# --- ingest and streaming ----------------------------------------------------------------


def _export(spark, sf, root, entity, batches=("batch_1", "batch_2"), packed=False):
    raw = RAW[entity](spark, sf)
    for batch in batches:
        rows = raw.filter(F.col("_batch_id") == batch).drop("_batch_id")
        write_batch(rows, root, entity, batch, packed)


def _visible(bronze):
    """Bronze rows without the columns that differ from run to run, as numbers."""
    return standardize(bronze, retail.rules("orders", ID), keep=["_batch_id"])


@query
def ingest_batches(spark, sf):
    root = scratch_path(spark, "raw")
    _export(spark, sf, root, "orders")
    return _visible(read_batches(spark, root, "orders", retail.COLUMNS["orders"]))


@query
def ingest_stream(spark, sf):
    """Two runs; the second finds a new folder and reads only that."""
    root, out = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    state = scratch_path(spark, "checkpoint")
    for batch in ("batch_1", "batch_2"):
        _export(spark, sf, root, "orders", [batch])
        stream = stream_batches(spark, root, "orders", retail.COLUMNS["orders"])
        append_available(stream, out, state)
    return _visible(spark.read.parquet(out))


@query
def load_files_once(spark, sf):
    """A bulk load run twice; the second adds nothing."""
    root, out = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    state = scratch_path(spark, "checkpoint")
    _export(spark, sf, root, "orders")
    for _ in range(2):
        load_once(
            spark, root, "orders", retail.COLUMNS["orders"], out, state,
            select=lambda rows: rows.drop("_ingested_at"),
        )
    return _visible(spark.read.parquet(out))


def _evolving(spark, sf, root, batch, columns):
    """Orders of one year in three as text, under the given header."""
    year = 1992 + int(batch[-1])
    orders = table(spark, sf, "orders").filter(F.year("o_orderdate") % 3 == year % 3)
    values = {
        "order_id": "o_orderkey",
        "order_date": F.col("o_orderdate").cast("date"),
        "status": "o_orderstatus",
        "priority": "o_orderpriority",
        "customer_id": "o_custkey",
    }
    texts = [F.col(v) if isinstance(v, str) else v for v in (values[c] for c in columns)]
    write_batch(orders.select(*[v.cast("string").alias(c) for v, c in zip(texts, columns)]), root, "orders", batch)


_HEADERS = {
    "batch_1": ["order_id", "order_date", "status"],
    "batch_2": ["customer_id", "status", "order_id", "order_date"],
    "batch_3": ["order_id", "priority"],
}


def _load_evolving(spark, sf, force):
    root, out = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    for batches in (["batch_1"], ["batch_2", "batch_3"], []):
        for batch in batches:
            _evolving(spark, sf, root, batch, _HEADERS[batch])
        evolving.load_files(spark, root, "orders", _HEADERS["batch_1"], out, force=force)
    return tables.read_table(spark, out).select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("order_date").cast("date").alias("order_date"),
        F.col("customer_id").cast("bigint").alias("customer_id"), "status", "priority", "_batch_id",
    )


@query
def load_evolving_files(spark, sf):
    """Three batches under other headers, loaded once each: columns are added, values are kept."""
    return _load_evolving(spark, sf, force=False)


@query
def load_evolving_files_forced(spark, sf):
    """The same, every load from all files there are."""
    return _load_evolving(spark, sf, force=True)


@query
def append_compacted(spark, sf):
    """Orders in 56 micro-batches, merged into few files while a reader follows."""
    feed, path = scratch_path(spark, "feed"), scratch_path(spark, "table")
    state, copy = scratch_path(spark, "state"), scratch_path(spark, "copy")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    checkpoint = scratch_path(spark, "checkpoint")
    for half in (0, 1):
        rows = orders.filter(F.pmod(F.xxhash64("o_orderkey"), F.lit(2)) == half)
        rows.repartition(55).write.mode("append").parquet(feed)
        appends.sink(stream_table(spark, feed, orders.schema, maxFilesPerTrigger="2"), path, checkpoint)
        if half:
            appends.compact_appends(spark, path)
        appends.follow(spark, path, state, lambda new, upto: appends.append(new, copy, ("copy", upto)))
        if not half:
            appends.compact_appends(spark, path)
    return appends.read_appends(spark, copy).drop(appends.APPEND)


@query
def row_count_report(spark, sf):
    """Rows that loads report against rows stored, over more micro-batches than are remembered."""
    root, out = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    orders = RAW["orders"](spark, sf).drop("_batch_id")
    write_batch(orders.repartition(110), root, "orders", "batch_1")
    columns = retail.COLUMNS["orders"]
    stream = stream_batches(spark, root, "orders", columns, maxFilesPerTrigger="1")
    reported = append_available(stream, out, scratch_path(spark, "checkpoint"))
    stored = spark.read.parquet(out).agg(F.count("*").alias("stored"))
    return stored.select(F.lit(reported).cast("bigint").alias("reported"), "stored")


@query
def latest_wins_long_batch_numbers(spark, sf):
    """Batches named by date and time: the later one wins."""
    orders = table(spark, sf, "orders")
    stamps = {"batch_20240101120000": "first", "batch_20240301120000": "a later one"}
    named = F.explode(F.array(*[F.struct(F.lit(b).alias("b"), F.lit(s).alias("s")) for b, s in stamps.items()]))
    rows = orders.select("o_orderkey", named.alias("_n")).select("o_orderkey", "_n.*")
    latest = latest_wins(rows, ["o_orderkey"], [batch_number("b"), "s"])
    return latest.select("o_orderkey", F.col("b").alias("batch"))


@query
def lineage_columns(spark, sf):
    """Where each loaded row came from, as far as it is the same in every run."""
    root = scratch_path(spark, "raw")
    _export(spark, sf, root, "orders")
    rows = read_batches(spark, root, "orders", retail.COLUMNS["orders"])
    return rows.select(
        F.trim("order_id").cast("bigint").alias("order_id"),
        "_batch_id",
        F.col("_source_file").contains("/orders.csv").alias("from_file"),
        F.col("_ingested_at").isNotNull().alias("timed"),
    )


def _taken(spark, name):
    """The rows of a catalog table, which is dropped."""
    rows = materialise(spark.table(name), "catalog")
    spark.sql(f"DROP TABLE {name}")
    return rows


@query
def catalog_reload(spark, sf):
    """A catalog table created once, filled, and reloaded out of itself."""
    name = f"reload_{uuid.uuid4().hex}"
    tables.create_if_absent(spark, name, {"p_partkey": "bigint", "p_name": "string"})
    tables.reload_table(table(spark, sf, "part"), name)
    tables.create_if_absent(spark, name, {"other": "int"})
    tables.reload_table(spark.table(name), name)
    return _taken(spark, name)


@query
def catalog_replace(spark, sf):
    """A catalog table replaced by rows of other columns."""
    name = f"replace_{uuid.uuid4().hex}"
    tables.replace_catalog_table(table(spark, sf, "region"), name)
    tables.replace_catalog_table(table(spark, sf, "part").select("p_partkey", "p_brand"), name)
    return _taken(spark, name)


@query
def catalog_truncate(spark, sf):
    """A catalog table emptied and filled anew; its columns stay."""
    name = f"truncate_{uuid.uuid4().hex}"
    tables.create_if_absent(spark, name, {"n_nationkey": "bigint", "n_name": "string"})
    nations = table(spark, sf, "nation")
    tables.reload_table(nations, name)
    tables.empty_table(spark, name)
    left = spark.table(name).count()
    tables.reload_table(nations.filter("n_nationkey < 10"), name)
    return _taken(spark, name).withColumn("left_after_truncate", F.lit(left))


@query
def refresh_read_between(spark, sf):
    """A table refreshed out of itself, and what a reader of before has after that."""
    path = scratch_path(spark, "table")
    parts = table(spark, sf, "part").select("p_partkey", "p_size")
    tables.refresh_table(parts, path)
    before = tables.read_table(spark, path)
    tables.refresh_table(before.filter("p_size <= 25"), path)
    after = tables.read_table(spark, path)
    both = before.withColumn("version", F.lit(1)).unionByName(after.withColumn("version", F.lit(2)))
    return both.groupBy("version").agg(
        F.count("*").alias("parts"), F.sum("p_partkey").cast("bigint").alias("keys")
    )


def _apply_events(spark, sf, rounds=1):
    """All events as change rows in files that are out of order, applied file by file."""
    feed, target = scratch_path(spark, "feed"), scratch_path(spark, "history")
    events = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    shuffled = F.pmod(F.xxhash64("event_id"), F.lit(4))
    events.repartition(4, shuffled).write.parquet(feed)
    for again in range(rounds):
        apply_changes(
            stream_table(spark, feed, events.schema, maxFilesPerTrigger="2"),
            target,
            scratch_path(spark, f"checkpoint-{again}"),
            ["user_id"],
            "ts",
            ["event_type"],
            ["value", "event_id"],
            tiebreak=["event_id"],
            buckets=8,
        )
    return read_history(spark, target)


@query
def cdc_apply_stream(spark, sf):
    return _apply_events(spark, sf)


@query
def cdc_apply_stream_replayed(spark, sf):
    """Every change row delivered a second time."""
    return _apply_events(spark, sf, rounds=2)


@query
def cdc_apply_compacted(spark, sf):
    """All events in 20 micro-batches out of order, compacted half-way, late rows after that."""
    feed, target = scratch_path(spark, "feed"), scratch_path(spark, "history")
    state = scratch_path(spark, "checkpoint")
    events = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    made = compacted.Feed(
        ["user_id"], "ts", ["event_type"], ["value", "event_id"], ["event_id"], buckets=8
    )
    for half in (0, 1):
        rows = events.filter(F.pmod(F.xxhash64("event_id", F.lit(3)), F.lit(2)) == half)
        shuffled = F.pmod(F.xxhash64("event_id"), F.lit(10))
        rows.repartitionByRange(10, shuffled).write.mode("append").parquet(feed)
        stream = stream_table(spark, feed, events.schema, maxFilesPerTrigger="1")
        compacted.absorb(stream, target, state, made)
        if not half:
            compacted.compact(spark, target, made)
    return compacted.read_history(spark, target)


# --- whole runs --------------------------------------------------------------------------


def _export_star(spark, sf):
    root = scratch_path(spark, "raw")
    for entity in retail.COLUMNS:
        batches = DATES if entity in ("customers", "orders") else ["batch_1"]
        if entity == "order_lines":
            batches = [f"batch_{n}" for n in range(1, 9)]
        _export(spark, sf, root, entity, batches)
    return root


@query
def star_by_batch_run(spark, sf):
    """All files ingested, cleaned and built into the fact by one batch run."""
    out = scratch_path(spark, "star")
    layers.run_batch(spark, _export_star(spark, sf), out, DATES, method="compare", id_type=ID)
    return tables.read_table(spark, f"{out}/gold/fact_order_line")


@query
def star_by_incremental_run(spark, sf):
    out = scratch_path(spark, "star")
    layers.run_incremental(
        spark, _export_star(spark, sf), out, DATES, encoding="closed", id_type=ID, buckets=8
    )
    return tables.read_table(spark, f"{out}/gold/fact_order_line")


@query
def dim_customer_by_stream(spark, sf):
    """The customer history of an incremental run, kept by the stream."""
    out = scratch_path(spark, "star")
    layers.run_incremental(
        spark, _export_star(spark, sf), out, DATES, encoding="closed", id_type=ID, buckets=8
    )
    return tables.read_table(spark, f"{out}/gold/dim_customer").drop("customer_name")


@query
def star_by_arrivals(spark, sf):
    """The fact after three arrivals: silver and history take in what is new each time."""
    root, out = scratch_path(spark, "raw"), scratch_path(spark, "star")
    arrivals = [
        {"customers": ["batch_1"], "products": ["batch_1"], "orders": ["batch_1"], "order_lines": ["batch_1"]},
        {"customers": ["batch_2"], "order_lines": [f"batch_{n}" for n in range(2, 6)]},
        {"orders": ["batch_2"], "order_lines": [f"batch_{n}" for n in range(6, 9)]},
    ]
    for arrival in arrivals:
        for entity, batches in arrival.items():
            _export(spark, sf, root, entity, batches, packed=True)
        layers.run_incremental(spark, root, out, DATES, encoding="closed", id_type=ID, buckets=8)
    return tables.read_table(spark, f"{out}/gold/fact_order_line")


@query
def dim_customer_same_date(spark, sf):
    """Two batches with one date: every way to keep the history has the later batch."""
    day = DATES["batch_1"]
    states = materialise(
        retail.customer_versions(RAW["customers"](spark, sf), dict.fromkeys(DATES, day), ID), "states"
    )
    keys, tracked, carried = ["customer_id"], retail.TRACKED, retail.CARRIED
    feed, target = scratch_path(spark, "feed"), scratch_path(spark, "history")
    states.repartition(3).write.parquet(feed)
    made = compacted.Feed(keys, "_effective", tracked, carried, retail.SETTLED_BY, untracked="first", buckets=4)
    stream = stream_table(spark, feed, states.schema, maxFilesPerTrigger="1")
    compacted.absorb(stream, target, scratch_path(spark, "checkpoint"), made)
    snapshots = scratch_path(spark, "snapshots")
    take_snapshot(retail.date_state(states, day), snapshots, keys, tracked, carried, "_effective")
    old, new = (retail.batch_state(states, b) for b in DATES)
    found = {
        "history": hist.scd2_history(states, keys, "_effective", tracked, carried, retail.SETTLED_BY),
        "stream": hist.to_closed(compacted.read_history(spark, target)),
        "snapshots": read_snapshots(spark, snapshots),
        "compare": hist.scd2_compare(old, new, keys, tracked, carried, day, day),
    }
    columns = [*retail.COLUMNS["customers"], "valid_from", "valid_to", "is_current"]
    named = [df.select(F.lit(n).alias("method"), *columns) for n, df in found.items()]
    return reduce(DataFrame.unionByName, named)


@query
def star_by_snapshot_run(spark, sf):
    out = scratch_path(spark, "star")
    layers.run_snapshots(spark, _export_star(spark, sf), out, DATES, id_type=ID)
    return tables.read_table(spark, f"{out}/gold/dim_customer")


@query
def star_layer_tests(spark, sf):
    """Every declared test over all layers of a batch run; early orders fail one of them."""
    out = scratch_path(spark, "star")
    layers.run_batch(spark, _export_star(spark, sf), out, DATES, method="compare", id_type=ID)
    batches = [f"batch_{n}" for n in range(1, 9)]
    return layers.layer_tests(spark, out, batches)
