"""Loads of files whose headers differ."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from strata.sources import evolving, published
from strata.sources.evolving import load_files
from strata.sources.tables import read_table

COLUMNS = ["order_id", "status"]


def put(root, batch, name, text, packed=False):
    folder = root / batch / "orders.csv"
    folder.mkdir(parents=True, exist_ok=True)
    if packed:
        (folder / f"{name}.gz").write_bytes(gzip.compress(text.encode()))
    else:
        (folder / name).write_text(text)


def rows(spark, path, *columns):
    found = read_table(spark, path).select(*columns).collect()
    return sorted((tuple(r) for r in found), key=str)


def test_columns_are_added_and_values_kept(spark, tmp_path):
    root, path = tmp_path / "raw", str(tmp_path / "t")
    put(root, "batch_1", "a.csv", "order_id,status\n1,open\n2,\n")
    assert load_files(spark, str(root), "orders", COLUMNS, path) == 2
    put(root, "batch_2", "b.csv", 'Status, order_id ,"the, channel"\nshut,3,"web, app"\n')
    put(root, "batch_2", "c.csv", "order_id\n4\n", packed=True)
    put(root, "batch_3", "d.csv", "priority,ORDER_ID\nhigh,5\n")
    put(root, "batch_3", "empty.csv", "")
    put(root, "batch_3", "only_header.csv", "order_id,status,later\n")
    put(root, "batch_3", "_hidden.csv", "order_id,secret\n9,9\n")
    assert load_files(spark, str(root), "orders", COLUMNS, path) == 3
    table = read_table(spark, path)
    lineage = ["_source_file", "_ingested_at", "_batch_id"]
    assert table.columns == [*COLUMNS, *lineage, "priority", "the, channel", "later"] or set(table.columns) == {
        *COLUMNS, *lineage, "priority", "the, channel", "later"
    }
    assert rows(spark, path, "order_id", "status", "`the, channel`", "priority", "_batch_id") == sorted(
        [
            ("1", "open", None, None, "batch_1"),
            ("2", None, None, None, "batch_1"),
            ("3", "shut", "web, app", None, "batch_2"),
            ("4", None, None, None, "batch_2"),
            ("5", None, None, "high", "batch_3"),
        ],
        key=str,
    )
    assert load_files(spark, str(root), "orders", COLUMNS, path) == 0
    assert table.filter(F.col("_source_file").contains("_hidden")).count() == 0


def test_forced_loads_and_overwritten_files(spark, tmp_path):
    root, path = tmp_path / "raw", str(tmp_path / "t")
    put(root, "batch_1", "a.csv", "order_id,status,extra\n1,open,x\n")
    assert load_files(spark, str(root), "orders", COLUMNS, path) == 1
    put(root, "batch_1", "a.csv", "order_id,status\n1,open\n7,shut\n")
    assert load_files(spark, str(root), "orders", COLUMNS, path) == 2
    assert len(rows(spark, path, "order_id")) == 3
    assert load_files(spark, str(root), "orders", COLUMNS, path, force=True) == 2
    assert rows(spark, path, "order_id", "status", "extra") == [("1", "open", None), ("7", "shut", None)]
    os.remove(root / "batch_1" / "orders.csv" / "a.csv")
    assert load_files(spark, str(root), "orders", COLUMNS, path, force=True) == 0
    assert rows(spark, path, "extra") == []


def test_without_merging_other_columns_stop_the_load(spark, tmp_path):
    root, path = tmp_path / "raw", str(tmp_path / "t")
    put(root, "batch_1", "a.csv", "order_id,status\n1,open\n")
    put(root, "batch_2", "b.csv", "order_id,status,extra\n2,open,x\n")
    with pytest.raises(ValueError, match="extra"):
        load_files(spark, str(root), "orders", COLUMNS, path, merge_schema=False)
    assert published.latest(spark, path) is published.NONE
    for bad in ("order_id,,x\n", "a,A\n"):
        put(root, "batch_3", "c.csv", bad)
        with pytest.raises(ValueError, match="empty or repeated"):
            load_files(spark, str(root), "orders", COLUMNS, path)
    put(root, "batch_3", "c.csv", "x" * (evolving.HEADER_BYTES + 5))
    with pytest.raises(ValueError, match="longer"):
        load_files(spark, str(root), "orders", COLUMNS, path)
    assert load_files(spark, str(tmp_path / "none"), "orders", COLUMNS, path) == 0


def test_select_while_loading(spark, tmp_path):
    root, path = tmp_path / "raw", str(tmp_path / "t")

    def pick(df):
        others = [c for c in df.columns if c not in ("order_id", "status", "_ingested_at", "_source_file")]
        return df.select(F.col("order_id").cast("int").alias("id"), *others)

    put(root, "batch_1", "a.csv", "order_id,status\n1,open\n")
    load_files(spark, str(root), "orders", COLUMNS, path, select=pick)
    put(root, "batch_2", "b.csv", "extra,order_id\nx,2\n")
    load_files(spark, str(root), "orders", COLUMNS, path, select=pick)
    assert rows(spark, path, "id", "_batch_id", "extra") == [(1, "batch_1", None), (2, "batch_2", "x")]
    # A load that fails leaves the table and takes its files up again.
    put(root, "batch_3", "c.csv", "order_id\n3\n")
    with pytest.raises(Exception, match="stop"):
        load_files(
            spark, str(root), "orders", COLUMNS, path,
            select=lambda df: pick(df).withColumn("extra", F.raise_error(F.lit("stop")).cast("string")),
        )
    assert len(rows(spark, path, "id")) == 2
    assert load_files(spark, str(root), "orders", COLUMNS, path, select=pick) == 1
    with pytest.raises(ValueError, match="was"):
        load_files(
            spark, str(root), "orders", COLUMNS, path, force=True,
            select=lambda df: df.select(F.col("order_id").alias("id")),
        )
