"""Keys that stay from build to build, and content checks by ranges of key hashes."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators import hashtree
from strata.operators.hashtree import content_check_by_ranges
from strata.operators.reconcile import content_check
from strata.operators.registry import read_registry, stable_keys
from strata.sources import published


def build(spark, path, listed, **options):
    df = spark.createDataFrame(listed, "k string, start int, v string").repartition(3)
    rows = stable_keys(df, ["k", "start"], "sk", path, **options)
    assert rows.columns == ["sk", "k", "start", "v"]
    return {(r.k, r.start, r.v): r.sk for r in rows.collect()}


def test_numbers_stay(spark, tmp_path):
    path = str(tmp_path / "keys")
    first = build(spark, path, [("b", 1, "x"), ("d", 1, "x"), (None, 1, "x")])
    assert first == {(None, 1, "x"): 1, ("b", 1, "x"): 2, ("d", 1, "x"): 3}
    second = build(spark, path, [("a", 1, "y"), ("b", 1, "y"), ("b", 2, "y"), ("b", 2, "z"), (None, 1, "y")])
    assert second == {
        ("a", 1, "y"): 4, ("b", 1, "y"): 2, ("b", 2, "y"): 5, ("b", 2, "z"): 5, (None, 1, "y"): 1
    }
    number = published.latest(spark, path).number
    assert build(spark, path, [("d", 1, "back")]) == {("d", 1, "back"): 3}
    assert build(spark, path, []) == {}
    assert published.latest(spark, path).number == number  # nothing new, nothing written
    assert sorted(r.sk for r in read_registry(spark, path).collect()) == [1, 2, 3, 4, 5]


def test_registries_are_merged_and_checked(spark, tmp_path):
    path = str(tmp_path / "keys")
    with pytest.raises(ValueError, match="no registry"):
        read_registry(spark, path)
    assert build(spark, path, []) == {}
    for n in range(4):
        assert build(spark, path, [(f"k{n}", 0, "x")], folders=2) == {(f"k{n}", 0, "x"): n + 1}
    assert len(published.latest(spark, path).folders["rows"]) <= 2
    assert read_registry(spark, path).count() == 4
    with pytest.raises(ValueError, match="made for"):
        stable_keys(spark.range(3), ["id"], "sk", path)


def tables(spark, seed, size=300):
    rng = random.Random(seed)
    base = [(i, rng.choice(["a", "b", None]), rng.randrange(5)) for i in range(size)]
    base += [(None, None, 1), (7, "other", 2), (8, base[8][1], base[8][2])]
    changed = list(base)
    changed[3], changed[50] = (3, "new", 9), (50, base[50][1], None)
    del changed[70]
    doubled = [*base, base[20]]
    swapped = [(k, None if v is None else v, n) for k, v, n in reversed(base)]
    make = lambda rows: spark.createDataFrame(rows, "k int, v string, n int").repartition(3)
    return {"base": make(base), "changed": make(changed), "doubled": make(doubled), "swapped": make(swapped)}


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("limit, levels", [(100_000, (4, 9)), (3, (4, 9))])
def test_ranges_give_the_rows_of_the_plain_check(spark, monkeypatch, limit, levels):
    monkeypatch.setattr(hashtree, "LISTED", limit)
    variants = tables(spark, limit)
    for names in (["base", "swapped"], ["base", "changed", "doubled", "swapped"], ["changed"]):
        chosen = {n: variants[n] for n in names}
        for only in (False, True):
            expected = listed(content_check(chosen, ["k"], ["v", "n"], only))
            found = content_check_by_ranges(chosen, ["k"], ["v", "n"], only, levels=levels)
            assert found.columns == ["k", "distinct_hashes", "variant_count", "status"]
            assert listed(found) == expected


def test_equal_tables_shuffle_checksums_only(spark, tmp_path):
    rows = spark.range(5000).select("id", F.xxhash64("id").alias("v"))
    for n in range(70):  # no limit of variants
        if n < 2:
            rows.repartition(2 + n).write.parquet(str(tmp_path / f"t{n}"))
    stored = {str(n): spark.read.parquet(str(tmp_path / f"t{n % 2}")) for n in range(70)}
    found = content_check_by_ranges(stored, ["id"], ["v"], only_mismatches=True, unique_keys=True)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 0
    stored["odd"] = stored["0"].withColumn("v", F.when(F.col("id") == 77, 0).otherwise(F.col("v")))
    few = {n: stored[n] for n in ("0", "1", "odd")}
    found = content_check_by_ranges(few, ["id"], ["v"], only_mismatches=True, unique_keys=True)
    assert listed(found) == [(77, 2, 3, "FAIL")]
    # The rows that go through the shuffle are those of the one range that differs.
    opened = hashtree._differing([df for df in few.values()], ["id"], ["id", "v"], 12)
    assert len(opened) == 1
    assert hashtree._within(stored["0"], ["id"], 12, opened, "left_semi").count() < 20


def test_ranges_of_empty_tables(spark):
    none = spark.createDataFrame([], "k int, v string, n int")
    assert content_check_by_ranges({"a": none, "b": none}, ["k"], ["v"]).count() == 0
    some = spark.createDataFrame([(1, "x", 1)], none.schema)
    assert listed(content_check_by_ranges({"a": none, "b": some}, ["k"], ["v"])) == [(1, 1, 1, "FAIL")]
