"""Ingest and change apply, in batch and as streams, and stored tables."""

import random

import pytest
from fixtures import BATCHES, rows, write_raw
from pyspark.sql import functions as F
from test_history import FEED, brute_force, random_feed, spark_slices

from strata.plans import retail
from strata.scratch import drop_scratch, materialise, scratch_path, scratch_root
from strata.sources.files import LINEAGE, read_batches, write_batch
from strata.sources.tables import (
    create_if_absent,
    empty_table,
    reload_table,
    read_table,
    replace_catalog_table,
    refresh_table,
)
from strata.streaming.changes import apply_changes, read_history
from strata.streaming.ingest import append_available, load_once, stream_batches, stream_table

ORDERS = retail.COLUMNS["orders"]


# --- files -------------------------------------------------------------------------------


def test_batches_come_as_text_with_lineage(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    df = read_batches(spark, raw, "orders", ORDERS)
    assert df.columns == [*ORDERS, *LINEAGE]
    assert {t for _, t in df.drop("_ingested_at").dtypes} == {"string"}
    found = df.collect()
    assert len(found) == 9
    assert sorted({r._batch_id for r in found}) == ["batch_1", "batch_2"]
    assert all(r._source_file.endswith(f"{r._batch_id}/orders.csv") for r in found)
    assert len({r._ingested_at for r in found}) == 1
    assert read_batches(spark, raw, "orders", ORDERS, batch="batch_2").count() == 2


def test_an_entity_may_be_missing_from_a_batch(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    assert read_batches(spark, raw, "products", retail.COLUMNS["products"]).count() == 5


def test_a_file_with_other_columns_stops_the_read(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    swapped = ["customer_id", "order_id", "order_date", "status"]
    with pytest.raises(Exception, match="(?i)header"):
        read_batches(spark, raw, "orders", swapped).collect()


def test_written_batches_read_back(spark, tmp_path):
    df = spark.createDataFrame([("1", "a, \"b\"", None, "x")], "a string, b string, c string, d string")
    write_batch(df, str(tmp_path), "things", "batch_3")
    back = read_batches(spark, str(tmp_path), "things", df.columns).drop(*LINEAGE[:2])
    assert rows(back) == [("1", "a, \"b\"", None, "x", "batch_3")]


def test_stream_reads_each_file_once(spark, tmp_path):
    raw, out, state = tmp_path / "raw", str(tmp_path / "bronze"), str(tmp_path / "state")

    def run():
        stream = stream_batches(spark, str(raw), "orders", ORDERS)
        return append_available(stream, out, state)

    write_raw(raw, {"batch_1": BATCHES["batch_1"]})
    assert (run(), run()) == (7, 0)
    write_raw(raw, {"batch_2": BATCHES["batch_2"]})
    assert run() == 2
    stored = spark.read.parquet(out)
    assert stored.columns == [*ORDERS, *LINEAGE]
    batch = read_batches(spark, str(raw), "orders", ORDERS)
    keep = [*ORDERS, "_source_file", "_batch_id"]
    assert rows(stored.select(*keep)) == rows(batch.select(*keep))


def test_load_once_with_projection(spark, tmp_path):
    raw, out, state = write_raw(tmp_path / "raw"), str(tmp_path / "t"), str(tmp_path / "s")
    pick = lambda df: df.select(F.col("order_id").cast("int").alias("id"), "_batch_id")
    args = (spark, raw, "orders", ORDERS, out, state, pick)
    assert (load_once(*args), load_once(*args)) == (9, 0)
    assert spark.read.parquet(out).dtypes == [("id", "int"), ("_batch_id", "string")]
    assert spark.read.parquet(out).count() == 9


# --- change feeds ------------------------------------------------------------------------


def feed_files(spark, path, listed, files):
    for part in range(files):
        chunk = listed[part::files]
        spark.createDataFrame(chunk, FEED).coalesce(1).write.mode("append").parquet(path)
    return spark.createDataFrame([], FEED).schema


def apply(spark, feed, schema, target, state, **options):
    apply_changes(
        stream_table(spark, feed, schema, maxFilesPerTrigger="1"),
        target,
        state,
        ["id"],
        "at",
        ["state"],
        ["note"],
        ["n"],
        buckets=3,
        **options,
    )
    found = read_history(spark, target).select("id", "note", "state", "__START_AT", "__END_AT")
    return sorted((tuple(r) for r in found.collect()), key=lambda r: (r[0], r[3]))


@pytest.mark.parametrize("untracked", ["first", "latest"])
def test_stream_equals_batch_in_any_order_of_arrival(spark, tmp_path, untracked):
    listed = random_feed(7)
    expected = brute_force(listed, untracked)
    for n in range(2):
        random.shuffle(listed)
        feed, target = str(tmp_path / f"f{n}"), str(tmp_path / f"t{n}")
        schema = feed_files(spark, feed, listed, 3)
        state = str(tmp_path / f"s{n}")
        assert apply(spark, feed, schema, target, state, untracked=untracked) == expected


def test_rows_delivered_twice_change_nothing(spark, tmp_path):
    listed = random_feed(8, size=200)
    feed, target = str(tmp_path / "feed"), str(tmp_path / "target")
    schema = feed_files(spark, feed, listed, 2)
    once = apply(spark, feed, schema, target, str(tmp_path / "s1"))
    assert apply(spark, feed, schema, target, str(tmp_path / "s2")) == once
    assert once == brute_force(listed, "latest")


def test_later_runs_take_up_late_rows(spark, tmp_path):
    listed = random_feed(9, size=200)
    feed, target, state = (str(tmp_path / x) for x in ("feed", "target", "state"))
    schema = feed_files(spark, feed, listed[::2], 1)
    assert apply(spark, feed, schema, target, state) == brute_force(listed[::2], "latest")
    feed_files(spark, feed, listed[1::2], 1)
    assert apply(spark, feed, schema, target, state) == brute_force(listed, "latest")


def test_hot_key_in_a_stream(spark, tmp_path):
    listed = random_feed(10, size=300)
    feed, target = str(tmp_path / "feed"), str(tmp_path / "target")
    schema = feed_files(spark, feed, listed, 1)
    with spark_slices(spark, 8):
        found = apply(
            spark, feed, schema, target, str(tmp_path / "s"), hot_rows=60, rows_per_file=40
        )
    assert found == brute_force(listed, "latest")
    # The bucket of the hot key is written by several tasks.
    folders = (tmp_path / "target" / "log").glob("_bucket=*")
    assert max(len(list(folder.glob("*.parquet"))) for folder in folders) > 1


# --- stored tables -----------------------------------------------------------------------


def test_refresh_counts_while_writing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert refresh_table(spark.range(5), path) == 5
    assert refresh_table(spark.range(2), path) == 2
    assert read_table(spark, path).count() == 2
    assert refresh_table(spark.range(0), path) == 0
    assert read_table(spark, path).columns == ["id"]


def test_catalog_tables(spark):
    spark.sql("DROP TABLE IF EXISTS stored_orders")
    columns = {"order_id": "string", "n": "bigint"}
    assert create_if_absent(spark, "stored_orders", columns).count() == 0
    df = spark.createDataFrame([(7, "a"), (8, "b")], "n int, order_id string")
    assert reload_table(df, "stored_orders") == 2
    assert reload_table(df.limit(1), "stored_orders") == 1
    assert rows(spark.table("stored_orders")) == [("a", 7)]
    assert create_if_absent(spark, "stored_orders", columns).count() == 1
    empty_table(spark, "stored_orders")
    assert spark.table("stored_orders").count() == 0
    assert replace_catalog_table(df, "stored_orders") == 2
    assert spark.table("stored_orders").columns == ["n", "order_id"]
    spark.sql("DROP TABLE stored_orders")


def test_intermediate_tables_live_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == shared
    assert scratch_path(spark, "x").startswith(shared)
    df = materialise(spark.range(3), "three")
    assert df.count() == 3
    assert all(f.startswith(f"file://{shared}") for f in df.inputFiles())
    drop_scratch(spark)
    with pytest.raises(Exception):
        spark.read.schema("id long").parquet(df.inputFiles()[0]).count()
