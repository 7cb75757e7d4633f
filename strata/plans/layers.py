"""Layered runs of the retail star, each with another way to keep the customer history.

Every function takes the folder of raw batches, the folder to write to and the business date
of each batch, and gives the rows written per table. Tables are the only hand-off between
layers, so each layer starts from stored rows.
"""

from __future__ import annotations

import json
import re
import uuid
from collections import Counter
from collections.abc import Mapping
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from strata.functions.batches import BATCH_PATTERN
from strata.operators.history import scd2_compare, scd2_history, to_closed
from strata.operators.quality import (
    column_tests,
    expect_or_drop,
    expectation_counts,
    relationships,
    report,
    split_rejects,
    unique,
)
from strata.operators.snapshots import read_snapshots, take_snapshot
from strata.parallel import together
from strata.plans import retail
from strata.scratch import materialise, passing
from strata.session import thrifty_session
from strata.sources.files import batch_glob, read_batches
from strata.sources.store import matching, read_text
from strata.sources.tables import append_table, read_table, refresh_table
from strata.sources.upsert import upsert
from strata.streaming.compacted import Feed, absorb, read_history
from strata.streaming.ingest import append_available, stream_batches, stream_table

ENTITIES = list(retail.COLUMNS)


class _Folder:
    """Paths below the output folder, and reads of what is stored there."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return read_table(self.spark, self.path(layer, name))


def _bronze(out: _Folder, raw_root: str) -> dict[str, int]:
    def ingest(entity: str) -> int:
        rows = read_batches(out.spark, raw_root, entity, retail.COLUMNS[entity])
        return refresh_table(rows, out.path("bronze", entity))

    return together({f"bronze.{e}": partial(ingest, e) for e in ENTITIES})


def _all_dated(out: _Folder, raw_root: str, dates: Mapping[str, date]) -> None:
    """An error, before anything is written, if a batch of customers has no date.

    Batches are the folders that hold files of customers; no file is opened.
    """
    files = matching(out.spark, batch_glob(raw_root, "customers"))
    found = {re.search(BATCH_PATTERN, f.path).group(1) for f in files}
    if unknown := sorted(found - set(dates)):
        raise ValueError(f"no effective date for batch {', '.join(unknown)}")


def _silver(out: _Folder, id_type: str) -> dict[str, int]:
    """Cleaned tables; rows that miss an expectation are counted and set aside with the reason.

    Values that cannot be read become NULL; how many is reported where there are any.
    """

    def clean(entity: str) -> dict[str, int]:
        bronze = out.read("bronze", entity)
        readable = retail.readable(entity, id_type)
        typed = retail.typed(bronze, entity, id_type)
        expected = retail.expectations(entity)
        kept, _ = expect_or_drop(typed, expected)
        silver = retail.latest(kept, entity).drop("_batch_id")
        written = refresh_table(silver, out.path("silver", entity))
        # Written each time, so that rejects of an earlier run do not stay, and counted there:
        # what a task observes may be observed again when its executor is lost.
        rejects = split_rejects(typed, expected)[1]
        dropped = refresh_table(rejects, out.path("rejects", entity))
        counts = {f"silver.{entity}": written, f"rejects.{entity}": dropped}
        if readable:
            broken = expectation_counts(bronze, readable).filter("dropped > 0").collect()
            counts |= {f"unreadable.{entity}.{r['rule']}": r["dropped"] for r in broken}
        return counts

    rows: dict[str, int] = {}
    for counts in together({e: partial(clean, e) for e in ENTITIES}).values():
        rows |= counts
    return rows


def _silver_by_arrival(out: _Folder, id_type: str, buckets: int) -> dict[str, int]:
    """Cleaned tables, brought up to date from the bronze rows that are new since the last run.

    Only key buckets with new rows are written. Rejects and unreadable values are those of the
    new rows; rejects are added to the earlier ones, once for each micro-batch.
    """

    def clean(entity: str) -> dict[str, int]:
        state = out.path("_checkpoints/silver", entity)
        silver, rejects = out.path("silver", entity), out.path("rejects", entity)
        readable, expected = retail.readable(entity, id_type), retail.expectations(entity)
        broken: Counter[str] = Counter()

        def take(batch: DataFrame, number: int) -> None:
            with passing(out.spark):
                rows = materialise(batch, "arrived")
                typed = retail.typed(rows, entity, id_type)
                kept, _ = expect_or_drop(typed, expected)
                upsert(kept, silver, retail.KEYS[entity], retail.latest_order(kept, entity), buckets)
                stream = json.loads(read_text(out.spark, f"{state}/metadata"))["id"]
                append_table(split_rejects(typed, expected)[1], rejects, (stream, number))
                for r in expectation_counts(rows, readable).collect() if readable else []:
                    broken[f"unreadable.{entity}.{r['rule']}"] += r["dropped"]

        path = out.path("bronze", entity)
        rows = stream_table(out.spark, path, read_table(out.spark, path).schema)
        query = rows.writeStream.foreachBatch(take).option("checkpointLocation", state)
        query.trigger(availableNow=True).start().awaitTermination()
        counts = {
            f"silver.{entity}": out.read("silver", entity).count(),
            f"rejects.{entity}": out.read("rejects", entity).count(),
        }
        return counts | {rule: n for rule, n in broken.items() if n}

    rows: dict[str, int] = {}
    for counts in together({e: partial(clean, e) for e in ENTITIES}).values():
        rows |= counts
    return rows


def _gold(out: _Folder, history: DataFrame, encoding: str) -> dict[str, int]:
    dims = {
        "dim_customer": lambda: retail.dim_customer(history, encoding),
        "dim_product": lambda: retail.dim_product(out.read("silver", "products")),
        "dim_date": lambda: retail.dim_date(out.read("silver", "orders")),
    }

    def store(name: str) -> int:
        with passing(out.spark):
            return refresh_table(dims[name](), out.path("gold", name))

    rows = together({f"gold.{name}": partial(store, name) for name in dims})
    with passing(out.spark):
        fact = retail.fact_order_line(
            out.read("silver", "order_lines"),
            out.read("silver", "orders"),
            out.read("gold", "dim_customer"),
            out.read("gold", "dim_product"),
            encoding,
        )
        rows["gold.fact_order_line"] = refresh_table(fact, out.path("gold", "fact_order_line"))
    return rows


def _in_order(dated: tuple[str, date]) -> tuple[date, int]:
    batch, effective = dated
    return effective, int(batch.rpartition("_")[2])


def run_batch(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    dates: Mapping[str, date],
    method: str = "history",
    encoding: str = "closed",
    id_type: str = "int",
    untracked: str = "first",
) -> dict[str, int]:
    """All layers recomputed; history from all batches, or from two of them by comparison.

    ``untracked`` is what a version shows in columns that open none, see ``scd2_history``; a
    comparison keeps the first. Of several batches of one date the one with the largest number
    counts, in every run.
    """
    out = _Folder(spark, out_root)
    _all_dated(out, raw_root, dates)
    rows = _bronze(out, raw_root)
    rows |= _silver(out, id_type)
    versions = retail.customer_versions(out.read("bronze", "customers"), dates, id_type)
    tracked, carried = retail.TRACKED, retail.CARRIED
    if method == "history":
        history = scd2_history(
            versions, ["customer_id"], "_effective", tracked, carried,
            retail.SETTLED_BY, encoding, untracked,
        )
    elif method == "compare":
        if len(dates) != 2 or encoding != "closed" or untracked != "first":
            raise ValueError("a comparison takes two batches, gives closed validity, keeps the first")
        (old_batch, old_from), (new_batch, new_from) = sorted(dates.items(), key=_in_order)
        old = retail.batch_state(versions, old_batch)
        new = retail.batch_state(versions, new_batch)
        history = scd2_compare(old, new, ["customer_id"], tracked, carried, old_from, new_from)
    else:
        raise ValueError(f"unknown method {method}")
    return rows | _gold(out, history, encoding)


def run_incremental(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    dates: Mapping[str, date],
    encoding: str = "half_open",
    id_type: str = "int",
    buckets: int = 64,
    untracked: str = "first",
) -> dict[str, int]:
    """New files are appended to bronze and taken into silver and the history; gold is recomputed.

    Call it again when files have arrived. Files are read once: silver and the history take
    their rows from the bronze tables, each row once, and write what these touch. Intermediate
    tables and shuffle files are deleted as soon as the table they serve is written.
    """
    spark = thrifty_session(spark)
    out = _Folder(spark, out_root)
    _all_dated(out, raw_root, dates)

    def ingest(entity: str) -> int:
        stream = stream_batches(spark, raw_root, entity, retail.COLUMNS[entity])
        state = out.path("_checkpoints/bronze", entity)
        return append_available(stream, out.path("bronze", entity), state)

    rows = together({f"bronze.{e}": partial(ingest, e) for e in ENTITIES})
    rows |= _silver_by_arrival(out, id_type, buckets)
    bronze_customers = out.path("bronze", "customers")
    schema = read_table(spark, bronze_customers).schema
    changes = retail.typed(stream_table(spark, bronze_customers, schema), "customers", id_type)
    feed = Feed(
        ["customer_id"], "_effective", retail.TRACKED, retail.CARRIED, retail.SETTLED_BY,
        untracked=untracked, buckets=buckets,
    )
    target = out.path("history", "customers")
    absorb(retail.dated(changes, dates), target, out.path("_checkpoints/history", "customers"), feed)
    history = read_history(spark, target)
    if encoding == "closed":
        history = to_closed(history)
    return rows | _gold(out, history, encoding)


def run_snapshots(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    dates: Mapping[str, date],
    id_type: str = "int",
) -> dict[str, int]:
    """One customer snapshot per date, folded into the history in the order of the dates.

    Of several batches of one date the rows of the later one count. Only open versions are
    written again; the history starts anew with every run.
    """
    out = _Folder(spark, out_root)
    _all_dated(out, raw_root, dates)
    rows = _bronze(out, raw_root)
    rows |= _silver(out, id_type)
    versions = retail.customer_versions(out.read("bronze", "customers"), dates, id_type)
    versions = materialise(versions, "customer-versions")
    path = f"{out.path('history', 'customers')}/{uuid.uuid4().hex}"
    # A key that a snapshot does not have is unchanged, so each is folded by itself.
    for effective in sorted(set(dates.values())):
        state = retail.date_state(versions, effective)
        take_snapshot(
            state, path, ["customer_id"], retail.TRACKED, retail.CARRIED, "_effective"
        )
    return rows | _gold(out, read_snapshots(spark, path), "closed")


def layer_tests(spark: SparkSession, out_root: str, batches: list[str]) -> DataFrame:
    """The declared tests of all layers as one report."""
    out = _Folder(spark, out_root)
    tests = [
        column_tests(
            out.read("bronze", e),
            f"bronze_{e}",
            [*retail.KEYS[e], "_batch_id"],
            {"_batch_id": batches},
        )
        for e in ENTITIES
    ]
    for e in ENTITIES:
        rows = out.read("silver", e)
        tests.append(column_tests(rows, f"silver_{e}", retail.KEYS[e]))
        tests.append(unique(rows, f"silver_{e}", retail.KEYS[e]))
    keys = {
        "dim_customer": ["customer_sk", "customer_id"],
        "dim_product": ["product_sk", "product_id"],
        "dim_date": ["date_key"],
        "fact_order_line": ["order_line_sk", "customer_sk", "product_sk", "order_date_key"],
    }
    gold = {name: out.read("gold", name) for name in retail.GOLD}
    for name, columns in keys.items():
        tests.append(column_tests(gold[name], name, columns))
        tests.append(unique(gold[name], name, columns[:1]))
    tests.append(unique(gold["dim_product"], "dim_product", ["product_id"]))
    fact = gold["fact_order_line"]
    parents = {
        "customer_sk": ("dim_customer", "customer_sk"),
        "product_sk": ("dim_product", "product_sk"),
        "order_date_key": ("dim_date", "date_key"),
    }
    for column, (name, parent_column) in parents.items():
        tests.append(relationships(fact, "fact_order_line", column, gold[name], parent_column))
    return report(*tests)
