"""What a run leaves on disk besides its tables."""

import glob
import os
import time

import pytest
from fixtures import BATCHES, DATES, FACT, rows, write_raw
from pyspark.sql import functions as F

from strata import scratch
from strata.parallel import together
from strata.plans import layers
from strata.scratch import materialise, passing
from strata.session import thrifty_session
from strata.sources import files
from strata.sources.files import read_batches, write_batch
from strata.sources.tables import read_table
from strata.sources.upsert import read_upserted, upsert


@pytest.fixture
def own_scratch(spark, tmp_path, monkeypatch):
    """A scratch folder of the test's own; what lies in it, by label."""
    monkeypatch.setattr(scratch, "scratch_root", lambda _: str(tmp_path / "scratch"))
    return lambda: sorted(os.listdir(p) for p in glob.glob(str(tmp_path / "scratch/*")))


def shuffle_files(spark):
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in local.getAllFiles().mkString("\n").split("\n") if "/shuffle" in f}


def test_arrivals_leave_no_intermediate_tables(spark, tmp_path, own_scratch):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    for batch in BATCHES:
        write_raw(raw, {batch: BATCHES[batch]})
        layers.run_incremental(spark, str(raw), out, DATES, encoding="closed", buckets=4)
        assert own_scratch() == [[]]
    assert rows(read_table(spark, f"{out}/gold/fact_order_line")) == FACT


def test_a_thrifty_session_drops_the_shuffle_files_of_a_job(spark, tmp_path):
    codec = "spark.sql.parquet.compression.codec"
    spark.conf.set(codec, "snappy")
    try:
        session = thrifty_session(spark)
        assert (spark.conf.get(codec), session.conf.get(codec)) == ("snappy", "zstd")
    finally:
        spark.conf.set(codec, "zstd")
    spark.conf.set(codec, "gzip")
    try:
        assert thrifty_session(spark).conf.get(codec) == "gzip"
    finally:
        spark.conf.set(codec, "zstd")
    before = shuffle_files(spark)
    counted = session.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    counted.write.parquet(str(tmp_path / "counted"))
    until = time.time() + 20  # they are deleted beside the job
    while not (gone := shuffle_files(spark) <= before) and time.time() < until:
        time.sleep(0.1)
    assert gone
    # Reading again what was dropped computes it again.
    assert counted.collect() and sorted(counted.collect()) == sorted(counted.collect())


def test_tables_pass_with_their_own_block_only(spark, own_scratch):
    def labels():
        return sorted(name.rpartition("-")[0] for found in own_scratch() for name in found)

    kept = materialise(spark.range(3), "before")
    with pytest.raises(ZeroDivisionError):
        with passing(spark):
            materialise(spark.range(3), "outer")
            with passing(spark):
                together({"a": lambda: materialise(spark.range(3), "inner")})
                assert labels() == ["before", "inner", "outer"]
            assert labels() == ["before", "outer"]
            1 / 0
    assert labels() == ["before"]
    assert kept.count() == 3


def test_an_upsert_leaves_its_table_only(spark, tmp_path, own_scratch):
    path = str(tmp_path / "table")
    for first in (0, 5):
        new = spark.range(first, first + 10).select("id", F.lit(first).alias("v"))
        upsert(new, path, ["id"], ["v"], buckets=2)
        assert own_scratch() == [[]]
    assert rows(read_upserted(spark, path)) == [(i, 5 if i > 4 else 0) for i in range(15)]


def test_packed_batches_are_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "PACKED_ROWS", 4)
    values = [(f" {i} ", "" if i % 3 else 'a "b",c', None if i % 2 else "x") for i in range(10)]
    df = spark.createDataFrame(values, "id string, note string, other string").coalesce(1)
    found = []
    for name, packed in (("plain", False), ("packed", True)):
        write_batch(df, str(tmp_path / name), "things", "batch_2", packed)
        back = read_batches(spark, str(tmp_path / name), "things", ["id", "note", "other"])
        found.append(rows(back.select("id", "note", "other", "_batch_id")))
    assert found[0] == found[1] and len(found[0]) == 10
    # No file has more rows than a task should read at once.
    assert len(glob.glob(str(tmp_path / "packed/batch_2/things.csv/*.csv.gz"))) == 3
