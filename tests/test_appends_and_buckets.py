"""Append tables under compaction, and joins of bucketed tables."""

import os

import pytest
from pyspark.sql import functions as F

from strata.sources.appends import append, compact_appends, follow, read_appends, sink
from strata.sources.bucketed import write_bucketed
from strata.streaming.ingest import stream_table


def data_files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_a_reader_neither_repeats_nor_misses_rows(spark, tmp_path):
    feed, path, state = str(tmp_path / "feed"), str(tmp_path / "t"), str(tmp_path / "state")
    taken = []

    def take(rows, upto):
        taken.append(sorted(r.id for r in rows.collect()))

    for start in (0, 24):
        spark.range(start, start + 24, 1, 24).write.mode("append").parquet(feed)
        stream = stream_table(spark, feed, spark.range(1).schema, maxFilesPerTrigger="2")
        sink(stream, path, str(tmp_path / "checkpoint"))
        if start:
            assert compact_appends(spark, path, hold_seconds=0) == 1  # before the reader has come so far
        follow(spark, path, state, take)
        if not start:
            assert compact_appends(spark, path, full_rows=8, hold_seconds=0) == 3
    follow(spark, path, state, take)
    assert sorted(x for rows in taken for x in rows) == list(range(48))
    assert [len(rows) for rows in taken] == [24, 24]
    assert sorted(r.id for r in read_appends(spark, path).collect()) == list(range(48))
    assert read_appends(spark, path, after=12).count() == 24
    # All that is left besides the last version kept for readers is one folder.
    compact_appends(spark, path, hold_seconds=0)
    append(spark.range(100, 101), path)
    follow(spark, path, state, take)
    assert taken[-1] == [100]


def test_micro_batches_and_positions_after_failures(spark, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "state")
    assert append(spark.range(3), path, ("s", 0)) == 3
    assert append(spark.range(3), path, ("s", 0)) == 0
    assert append(spark.range(0), path) == 0
    with pytest.raises(ValueError, match="made with"):
        append(spark.range(3).toDF("x"), path)

    def fails(rows, upto):
        raise RuntimeError("stop")

    with pytest.raises(RuntimeError):
        follow(spark, path, state, fails)
    seen, copy = [], str(tmp_path / "copy")
    for _ in range(2):
        follow(spark, path, state, lambda rows, upto: seen.append(append(rows, copy, ("copy", upto))))
    assert seen == [3] and read_appends(spark, copy).count() == 3
    with pytest.raises(ValueError, match="no table"):
        read_appends(spark, str(tmp_path / "none"))
    assert follow(spark, str(tmp_path / "none"), state + "2", fails) == 0


def test_bucketed_tables_are_joined_where_they_lie(spark):
    orders = spark.range(2000).select(F.col("id").alias("order_id"), (F.col("id") % 7).alias("customer_id"))
    lines = spark.range(6000).select((F.col("id") % 2100).alias("order_id"), F.col("id").alias("line_id"))
    assert write_bucketed(orders, "bucketed_orders", ["order_id"], 8) == 2000
    assert write_bucketed(lines, "bucketed_lines", ["order_id"], 8, ["line_id"]) == 6000
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed_lines").join(spark.table("bucketed_orders"), "order_id")
        counted = joined.groupBy("order_id").count()
        assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
        expected = lines.join(orders, "order_id").groupBy("order_id").count()
        assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, expected.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    bad = lines.withColumn("line_id", F.when(F.col("line_id") > 5000, F.raise_error(F.lit("stop"))).otherwise(1))
    with pytest.raises(Exception, match="stop"):
        write_bucketed(bad, "bucketed_lines", ["order_id"], 8)
    assert spark.table("bucketed_lines").count() == 6000
    assert write_bucketed(spark.table("bucketed_lines").filter("line_id < 10"), "bucketed_lines", ["order_id"], 4) == 10
    for name in ("bucketed_lines", "bucketed_orders"):
        spark.sql(f"DROP TABLE {name}")
