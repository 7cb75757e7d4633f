"""Tables by key that rewrite what new rows touch, histories that take in snapshots, whole runs."""

import os
import random
from datetime import date

import pytest
from fixtures import BATCHES, DATES, rows, write_raw
from pyspark.sql import functions as F

from strata.operators.history import scd2_history
from strata.operators.snapshots import read_snapshots, take_snapshot
from strata.plans import layers, retail
from strata.sources import published
from strata.sources.tables import append_table, read_table
from strata.sources.upsert import bucket_files, read_changed, read_upserted, upsert


def test_upsert_keeps_the_last_row_and_the_files_of_other_buckets(spark, tmp_path):
    path, rng, best = str(tmp_path / "t"), random.Random(2), {}
    for arrival in range(4):
        listed = [(rng.randrange(40), rng.randrange(6), rng.choice("xyz")) for _ in range(60 if arrival < 3 else 2)]
        listed += listed[:3] + [(None, 9, "no key")]
        before = bucket_files(spark, path)
        old = dict(best)
        for k, n, v in listed:
            if k is not None:
                best[k] = max(best.get(k, (n, v)), (n, v))
        df = spark.createDataFrame(listed, "k int, n int, v string").repartition(3)
        upsert(df, path, ["k"], ["n", "v"], buckets=8)
        assert rows(read_upserted(spark, path)) == sorted((k, *r) for k, r in best.items())
        assert rows(read_table(spark, path)) == rows(read_upserted(spark, path))
        assert rows(read_changed(spark, path)) == sorted((k, *r) for k, r in best.items() if old.get(k) != r)
        touched = {b for b, files in bucket_files(spark, path).items() if files != before.get(b)}
        keys = spark.createDataFrame([(k,) for k, _, _ in listed if k is not None], "k int")
        expected = keys.select(F.pmod(F.xxhash64("k"), F.lit(8)).alias("b")).distinct().collect()
        assert touched == {r.b for r in expected}
    assert upsert(df.limit(0), path, ["k"], ["n", "v"], buckets=8) == 0
    with pytest.raises(ValueError, match="was made with"):
        upsert(df, path, ["k"], ["n", "v"], buckets=9)


def test_append_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert append_table(spark.range(3), path, ("s", 0)) == 3
    assert append_table(spark.range(3), path, ("s", 0)) == 0
    assert append_table(spark.range(2), path, ("s", 1)) == 2
    assert append_table(spark.range(2), path, ("other", 0)) == 2
    assert read_table(spark, path).count() == 7
    with pytest.raises(ValueError, match="was made with"):
        append_table(spark.range(2).toDF("x"), path)


def test_snapshots_leave_closed_versions_alone(spark, tmp_path):
    path = str(tmp_path / "h")
    days = [date(2024, m, 1) for m in (1, 2, 3)]
    states = [[(1, "a"), (2, "b")], [(1, "c"), (2, "b")], [(1, "c"), (2, "d"), (3, "e")]]
    for day, state in zip(days, states):
        before = published.latest(spark, path).folders.get("closed", [])
        take_snapshot(spark.createDataFrame(state, "id int, city string"), path, ["id"], ["city"], [], day)
        assert published.latest(spark, path).folders["closed"][: len(before)] == before
    listed = [(k, v, d) for d, state in zip(days, states) for k, v in state]
    feed = spark.createDataFrame(listed, "id int, city string, day date")
    expected = scd2_history(feed, ["id"], "day", ["city"])
    assert rows(read_snapshots(spark, path).select(*expected.columns)) == rows(expected)
    open_folder = published.latest(spark, path).folders["open"][0]
    assert sum(f.endswith(".parquet") for f in os.listdir(f"{path}/{open_folder}")) >= 1
    with pytest.raises(ValueError, match="no history"):
        read_snapshots(spark, str(tmp_path / "none"))


def same_date_batches():
    """A third batch on the date of the second: alphabet and number disagree."""
    third = dict(BATCHES["batch_2"])
    third["customers"] = third["customers"].replace("@", "@a.", 2)
    return {**BATCHES, "batch_3": {"customers": third["customers"]}}


@pytest.mark.parametrize("untracked", ["first", "latest"])
def test_all_runs_agree_where_two_batches_have_one_date(spark, tmp_path, untracked):
    raw = write_raw(tmp_path / "raw", same_date_batches())
    dates = {**DATES, "batch_3": DATES["batch_2"]}
    found = {}
    layers.run_batch(spark, raw, str(tmp_path / "history"), dates, untracked=untracked)
    layers.run_incremental(
        spark, raw, str(tmp_path / "incremental"), dates, encoding="closed", buckets=4, untracked=untracked
    )
    if untracked == "first":
        layers.run_snapshots(spark, raw, str(tmp_path / "snapshots"), dates)
    for run in os.listdir(tmp_path):
        if run != "raw":
            found[run] = rows(read_table(spark, f"{tmp_path}/{run}/gold/dim_customer"))
    assert len({str(v) for v in found.values()}) == 1 and len(found) == 2 + (untracked == "first")
    silver = read_table(spark, f"{tmp_path}/history/silver/customers").select("customer_id", "email")
    current = read_table(spark, f"{tmp_path}/history/gold/dim_customer").filter("is_current")
    assert rows(current.select("customer_id", "email")) == rows(silver)
    assert any("@a." in r.email for r in silver.collect())


def test_three_arrivals_make_the_star_of_one_batch_run(spark, tmp_path):
    batches = same_date_batches()
    batches["batch_3"]["orders"] = "order_id,customer_id,order_date,status\n1001,1,2024-03-20,returned\n"
    dates = {**DATES, "batch_3": date(2024, 5, 1)}
    raw, out = tmp_path / "raw", str(tmp_path / "incremental")
    seen = []
    for name, batch in batches.items():
        write_raw(raw, {name: batch})
        layers.run_incremental(spark, str(raw), out, dates, encoding="closed", buckets=16)
        seen.append({e: bucket_files(spark, f"{out}/silver/{e}") for e in layers.ENTITIES})
    layers.run_batch(spark, str(raw), str(tmp_path / "batch"), dates)
    for name in retail.GOLD:
        assert rows(read_table(spark, f"{out}/gold/{name}")) == rows(read_table(spark, f"{tmp_path}/batch/gold/{name}"))
    # One order came last: one bucket of orders is new, and no bucket of lines.
    orders = [b for b, files in seen[2]["orders"].items() if files != seen[1]["orders"].get(b)]
    assert len(orders) == 1 and seen[2]["order_lines"] == seen[1]["order_lines"]
    assert [r.order_id for r in read_changed(spark, f"{out}/silver/orders").collect()] == [1001]


def test_compare_of_one_date_takes_the_later_batch(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    one = {b: date(2024, 1, 1) for b in DATES}
    layers.run_batch(spark, raw, str(tmp_path / "compare"), one, method="compare")
    layers.run_batch(spark, raw, str(tmp_path / "history"), one)
    compared, history = (
        rows(read_table(spark, f"{tmp_path}/{run}/gold/dim_customer")) for run in ("compare", "history")
    )
    assert compared == history
