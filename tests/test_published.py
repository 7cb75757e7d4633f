"""Tables that readers never see half done."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from strata.sources import published, store
from strata.sources.tables import read_table, refresh_table

ROWS = 400


def state(spark, number):
    """A table whose rows all carry the number of the refresh, in several files."""
    return spark.range(0, ROWS, 1, 4).select("id", F.lit(number).alias("n"))


def folders(path):
    return {f for f in os.listdir(f"{path}/_data")}


def test_a_reader_sees_whole_tables_only(spark, tmp_path):
    path, seen, wrong, ended = str(tmp_path / "t"), set(), [], threading.Event()
    refresh_table(state(spark, 0), path)

    def read():
        while not ended.is_set():
            try:
                found = read_table(spark, path).groupBy("n").count().collect()
            except Exception as error:  # a missing table
                wrong.append(str(error))
                return
            if len(found) != 1 or found[0]["count"] != ROWS:
                wrong.append(found)
            seen.update(r.n for r in found)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for number in range(1, 21):
            refresh_table(state(spark, number), path)
    finally:
        ended.set()
        reader.join()
    assert wrong == [] and len(seen) > 1
    assert read_table(spark, path).first().n == 20


def test_folders_are_written_once_and_stay_where_they_are(spark, tmp_path):
    path = str(tmp_path / "t")
    refresh_table(state(spark, 1), path)
    first = {f: os.stat(f"{path}/_data/{f}").st_ino for f in folders(path)}
    refresh_table(state(spark, 2), path)
    assert {f: os.stat(f"{path}/_data/{f}").st_ino for f in first} == first
    held = read_table(spark, path)
    refresh_table(state(spark, 3), path)
    assert {r.n for r in held.collect()} == {2}  # what it was when it was read


def test_a_failed_writer_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    refresh_table(state(spark, 1), path)
    bad = state(spark, 2).withColumn("n", F.when(F.col("id") == 399, F.raise_error(F.lit("stop"))).otherwise(2))
    with pytest.raises(Exception, match="stop"):
        refresh_table(bad, path)
    # One that died while it wrote the pointer.
    store.write_new(spark, f"{path}/_versions/000000000001.json", '{"folders": {"rows": [')
    assert {r.n for r in read_table(spark, path).collect()} == {1}
    assert refresh_table(state(spark, 4), path, hold_seconds=0) == ROWS
    assert published.latest(spark, path).number == 2
    assert {r.n for r in read_table(spark, path).collect()} == {4}


def test_replaced_rows_are_deleted_when_nobody_can_read_them(spark, tmp_path):
    path = str(tmp_path / "t")
    for number in range(5):
        refresh_table(state(spark, number), path)
    assert len(folders(path)) == 5  # held for a day
    refresh_table(state(spark, 5), path, keep=2, hold_seconds=0)
    assert len(folders(path)) == 2
    assert published.expire(spark, path, keep=1, hold_seconds=0) == 1
    assert {r.n for r in read_table(spark, path).collect()} == {5}


def test_two_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    refresh_table(state(spark, 1), path)
    known = published.latest(spark, path)
    refresh_table(state(spark, 2), path)
    with pytest.raises(ValueError, match="another writer"):
        published.publish(spark, path, {"rows": []}, known.notes, known)
    assert {r.n for r in read_table(spark, path).collect()} == {2}


def test_tables_out_of_themselves_partitioned_and_plain(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(6).select((F.col("id") % 2).alias("part"), "id", F.lit("x").alias("name"))
    assert refresh_table(rows, path, ["part"]) == 6
    assert read_table(spark, path).columns == ["part", "id", "name"]
    assert refresh_table(read_table(spark, path).filter("part = 1"), path) == 3
    assert sorted(r.id for r in read_table(spark, path).collect()) == [1, 3, 5]
    assert refresh_table(read_table(spark, path).limit(0), path) == 0
    assert read_table(spark, path).count() == 0
    plain = str(tmp_path / "plain")
    spark.range(3).write.parquet(plain)
    assert read_table(spark, plain).count() == 3
    assert published.latest(spark, plain) is published.NONE
