"""Change apply by touched keys, with compaction, against plain Python and the batch form."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_history import FEED, brute_force, random_feed

from strata.operators.history import scd2_history, version_borders
from strata.sources import published
from strata.streaming.compacted import Feed, absorb, changed_rows, compact, read_history
from strata.streaming.ingest import stream_table

COLUMNS = ["id", "note", "state", "__START_AT", "__END_AT"]


def feed_of(**options):
    return Feed(["id"], "at", ["state"], ["note"], ["n"], buckets=3, **options)


def arrive(spark, path, listed):
    spark.createDataFrame(listed, FEED).coalesce(1).write.mode("append").parquet(path)


def take(spark, path, target, state, feed, **options):
    schema = spark.createDataFrame([], FEED).schema
    absorb(stream_table(spark, path, schema, maxFilesPerTrigger="1"), target, state, feed, **options)


def found(spark, target, columns=COLUMNS):
    rows = [tuple(r) for r in read_history(spark, target).select(*columns).collect()]
    return sorted(rows, key=lambda r: (r[0], r[3]))


@pytest.mark.parametrize("untracked", ["first", "latest"])
def test_compacted_equals_brute_force(spark, tmp_path, untracked):
    """Rows in random order: most come late, into stretches that were reduced."""
    listed, feed = random_feed(11, size=180), feed_of(untracked=untracked)
    path, target, state = (str(tmp_path / x) for x in ("feed", "target", "state"))
    cuts = [0, 40, 120, len(listed)]
    for a, b in zip(cuts, cuts[1:]):
        half = (a + b) // 2
        arrive(spark, path, listed[a:half])
        arrive(spark, path, listed[half:b])
        take(spark, path, target, state, feed)
        assert found(spark, target) == brute_force(listed[:b], untracked)
        compact(spark, target, feed, keep_from="2024-01-01 00:30:00" if a == 40 else None)
        assert found(spark, target) == brute_force(listed[:b], untracked)
    version = published.latest(spark, target)
    assert [len(version.folders[k]) for k in ("log", "reduced", "history")] == [1, 1, 1]
    assert len(version.folders["archive"]) > 3


def test_days_with_compaction(spark, tmp_path):
    rng = random.Random(5)
    listed = [
        (rng.randrange(4), rng.choice("xy"), rng.randrange(9), datetime(2024, 1, 1) + timedelta(hours=rng.randrange(400)), n)
        for n in range(160)
    ]
    feed = feed_of(encoding="closed", untracked="first")
    path, target, state = (str(tmp_path / x) for x in ("feed", "target", "state"))
    columns = ["id", "note", "state", "valid_from", "valid_to", "is_current"]
    for a in range(0, 160, 80):
        arrive(spark, path, listed[a : a + 80])
        take(spark, path, target, state, feed)
        compact(spark, target, feed)
        batch = scd2_history(
            spark.createDataFrame(listed[: a + 80], FEED), ["id"], "at", ["state"], ["note"], ["n"], "closed", "first"
        )
        expected = sorted((tuple(r) for r in batch.select(*columns).collect()), key=lambda r: (r[0], r[3]))
        assert found(spark, target, columns) == expected


def test_work_follows_the_change(spark, tmp_path):
    """One row of one key: only its bucket is read, and only its versions are written."""
    listed, feed = random_feed(12, keys=60, size=300), feed_of()
    path, target, state = (str(tmp_path / x) for x in ("feed", "target", "state"))
    arrive(spark, path, listed)
    take(spark, path, target, state, feed)
    compact(spark, target, feed)
    reduced = published.latest(spark, target).folders["reduced"][0]
    assert spark.read.parquet(f"{target}/{reduced}").count() < 300
    late = (7, "z", 1, datetime(2024, 1, 1, 0, 20), 1000)
    arrive(spark, path, [late])
    take(spark, path, target, state, feed)
    assert found(spark, target) == brute_force([*listed, late], "latest")

    version = published.latest(spark, target)
    assert len(version.folders["history"]) == 2
    written = spark.read.parquet(f"{target}/{version.folders['history'][1]}")
    assert {r.id for r in written.collect()} == {7}
    arrived = spark.read.parquet(f"{target}/{version.folders['log'][-1]}")
    bucket = arrived.first()["_bucket"]
    rows = changed_rows(spark, target, feed, version.folders, version.notes, arrived, [bucket])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan
    reads = [line for line in plan.splitlines() if "FileScan" in line and "PartitionFilters" in line]
    assert reads and all("_bucket" in line.split("PartitionFilters:")[1] for line in reads[:1])
    assert {r.id for r in rows.collect()} == {7}


def test_settings_failures_and_repeats(spark, tmp_path):
    listed, feed = random_feed(13, size=90), feed_of()
    path, target, state = (str(tmp_path / x) for x in ("feed", "target", "state"))
    arrive(spark, path, listed)
    take(spark, path, target, state, feed)
    before = found(spark, target)
    with pytest.raises(ValueError, match="was made with"):
        compact(spark, target, feed._replace(buckets=4))
    with pytest.raises(Exception, match="was made with"):
        take(spark, path, target, str(tmp_path / "other"), feed._replace(untracked="first"))
    take(spark, path, target, str(tmp_path / "again"), feed)  # all rows a second time
    assert found(spark, target) == before
    # A folder that a failed micro-batch left is not read.
    spark.range(3).write.parquet(f"{target}/_data/folder=log-left")
    assert found(spark, target) == before
    take(spark, path, target, str(tmp_path / "third"), feed, compact_after=2)
    assert len(published.latest(spark, target).folders["history"]) == 1
    assert found(spark, target) == before
    compact(spark, target, feed, hold_seconds=0)
    compact(spark, target, feed, hold_seconds=0)
    assert not os.path.exists(f"{target}/_data/folder=log-left")
    with pytest.raises(ValueError, match="nothing"):
        read_history(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("hot_rows", [10**6, 20])
def test_borders_have_the_history_of_all_rows(spark, hot_rows):
    listed = random_feed(14)
    listed = [r for r in listed if r[0] is not None]
    rows = spark.createDataFrame(listed, FEED).repartition(4)
    borders = version_borders(rows, ["id"], "at", ["state"], ["note"], ["n"], "half_open", hot_rows)
    args = (["id"], "at", ["state"], ["note"], ["n"], "half_open", "latest")
    history = scd2_history(borders, *args).select(*COLUMNS).collect()
    assert sorted(map(tuple, history), key=lambda r: (r[0], r[3])) == brute_force(listed, "latest")
    assert borders.count() < rows.dropDuplicates(["id", "at"]).count()
    assert borders.filter(F.col("at").isNull()).count() == 0
