"""History jobs: traps, policies, and agreement of all ways to build the same history."""

import random
from datetime import date, datetime

import pytest
from fixtures import OPEN, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import history as hist
from strata.operators.ordered import neighbour, range_slices

D1, D2, D3 = date(2024, 1, 1), date(2024, 3, 1), date(2024, 6, 1)
SCHEMA = "id int, name string, city string, day date"


def states(spark, *listed):
    return spark.createDataFrame(list(listed), SCHEMA)


def built(spark, df, **options):
    options = {"tracked": ["city"], "carried": ["name"], **options}
    return rows(hist.scd2_history(df, ["id"], "day", **options))


def compared(spark, old, new):
    old = spark.createDataFrame(old, "id int, name string, city string")
    new = spark.createDataFrame(new, "id int, name string, city string")
    return rows(hist.scd2_compare(old, new, ["id"], ["city"], ["name"], D1, D2))


def folded(spark, snapshots):
    history = hist.empty_history(
        spark,
        [T.StructField("id", T.IntegerType())],
        [T.StructField("name", T.StringType()), T.StructField("city", T.StringType())],
    )
    for day, listed in snapshots:
        snapshot = spark.createDataFrame(listed, "id int, name string, city string")
        history = hist.scd2_fold(history, snapshot, ["id"], ["city"], ["name"], day)
    return rows(history)


def test_null_on_both_sides_is_no_change_and_no_row_is_lost(spark):
    expected = [(1, "a", None, D1, OPEN, True)]
    assert compared(spark, [(1, "a", None)], [(1, "a", None)]) == expected
    assert built(spark, states(spark, (1, "a", None, D1), (1, "a", None, D2))) == expected
    assert folded(spark, [(D1, [(1, "a", None)]), (D2, [(1, "a", None)])]) == expected


@pytest.mark.parametrize("before,after", [(None, "x"), ("x", None)])
def test_change_from_or_to_null_is_a_change(spark, before, after):
    expected = [
        (1, "a", before, D1, date(2024, 2, 29), False),
        (1, "a", after, D2, OPEN, True),
    ]
    key = lambda r: r[3]
    assert sorted(compared(spark, [(1, "a", before)], [(1, "a", after)]), key=key) == expected
    found = built(spark, states(spark, (1, "a", before, D1), (1, "a", after, D2)))
    assert sorted(found, key=key) == expected
    found = folded(spark, [(D1, [(1, "a", before)]), (D2, [(1, "a", after)])])
    assert sorted(found, key=key) == expected


def test_untracked_change_opens_no_version(spark):
    df = states(spark, (1, "old", "x", D1), (1, "new", "x", D2))
    assert built(spark, df, untracked="first") == [(1, "old", "x", D1, OPEN, True)]
    assert built(spark, df, untracked="latest") == [(1, "new", "x", D1, OPEN, True)]
    assert compared(spark, [(1, "old", "x")], [(1, "new", "x")]) == [
        (1, "old", "x", D1, OPEN, True)
    ]


def test_latest_policy_takes_the_last_row_of_each_version(spark):
    df = states(
        spark, (1, "a", "x", D1), (1, "b", "x", D2), (1, "c", "y", D3), (2, "d", "x", D2)
    )
    assert built(spark, df, untracked="latest") == [
        (1, "b", "x", D1, date(2024, 5, 31), False),
        (1, "c", "y", D3, OPEN, True),
        (2, "d", "x", D2, OPEN, True),
    ]


def test_a_value_that_comes_back_is_a_third_version(spark):
    listed = [(1, "a", "x", D1), (1, "a", "y", D2), (1, "a", "x", D3)]
    found = built(spark, states(spark, *listed), encoding="half_open")
    assert found == [(1, "a", "x", D1, D2), (1, "a", "x", D3, None), (1, "a", "y", D2, D3)]
    assert len(folded(spark, [(d, [(i, n, c)]) for i, n, c, d in listed])) == 3


def test_unchanged_batch_in_between_adds_nothing(spark):
    listed = [(1, "a", "x", D1), (1, "a", "x", D2), (1, "a", "y", D3)]
    assert len(built(spark, states(spark, *listed))) == 2


def test_same_key_twice_at_one_point_counts_once_and_is_stable(spark):
    listed = [(1, "a", "x", D1), (1, "a", "z", D1), (1, "a", "y", D1), (1, "a", "y", D2)]
    for _ in range(3):
        random.shuffle(listed)
        assert built(spark, states(spark, *listed)) == [
            (1, "a", "y", D2, OPEN, True),
            (1, "a", "z", D1, date(2024, 2, 29), False),
        ]


def test_rows_without_key_or_sequence_are_left_out(spark):
    df = states(spark, (None, "a", "x", D1), (1, "a", "x", None), (2, "b", "y", D1))
    assert built(spark, df) == [(2, "b", "y", D1, OPEN, True)]


def test_key_only_in_one_snapshot(spark):
    assert compared(spark, [(1, "a", "x")], [(2, "b", "y")]) == [
        (1, "a", "x", D1, OPEN, True),
        (2, "b", "y", D2, OPEN, True),
    ]


def test_applying_snapshots_again_changes_nothing(spark):
    first, second = (D1, [(1, "a", "x"), (2, "b", "y")]), (D2, [(1, "a", "z"), (3, "c", "w")])
    once = folded(spark, [first, second])
    assert folded(spark, [first, second, second]) == once
    assert folded(spark, [first, second, first]) == once
    assert folded(spark, [first, first, second, first, second]) == once


def test_encodings_convert_into_each_other(spark):
    df = states(spark, (1, "a", "x", D1), (1, "a", "y", D2), (2, "b", "z", D2))
    half = hist.scd2_history(df, ["id"], "day", ["city"], ["name"], encoding="half_open")
    closed = hist.scd2_history(df, ["id"], "day", ["city"], ["name"], encoding="closed")
    assert rows(hist.to_closed(half)) == rows(closed)
    assert rows(hist.to_half_open(closed)) == rows(half)
    starts = closed.select("id", "name", "city", F.col("valid_from").alias("start"))
    assert rows(hist.end_by_next(starts, ["id"], "start", "closed")) == rows(closed)


@pytest.mark.parametrize("hot_rows", [10**6, 50, 1])
def test_starts_of_a_hot_key(spark, hot_rows):
    listed = [(0 if n % 3 == 0 else n % 7 + 1, n) for n in range(300)]
    df = spark.createDataFrame(listed, "k int, at int").repartition(5)
    with spark_slices(spark, 6):
        found = hist.end_by_next(df, ["k"], "at", "half_open", hot_rows)
        found = sorted((tuple(r) for r in found.collect()), key=lambda r: r[:2])
    listed.sort()
    after = [b[1] if a[0] == b[0] else None for a, b in zip(listed, [*listed[1:], (None, None)])]
    assert found == [(*row, end) for row, end in zip(listed, after)]


def test_unknown_names_are_refused(spark):
    df = states(spark, (1, "a", "x", D1))
    with pytest.raises(ValueError, match="policy"):
        hist.scd2_history(df, ["id"], "day", ["city"], untracked="last")
    with pytest.raises(ValueError, match="encoding"):
        hist.scd2_history(df, ["id"], "day", ["city"], encoding="open")


# --- random feeds ------------------------------------------------------------------------


def random_feed(seed, keys=6, size=400):
    """Change rows of which one key holds a third, with repeats, NULLs and ties."""
    chance = random.Random(seed)
    listed = []
    for n in range(size):
        key = 0 if n % 3 == 0 else chance.randrange(1, keys)
        at = datetime(2024, 1, 1, 0, chance.randrange(60), chance.randrange(60))
        listed.append((key, chance.choice(["x", "y", None]), chance.randrange(5), at, n))
    listed += chance.sample(listed, size // 4)
    chance.shuffle(listed)
    return listed


FEED = "id int, state string, note int, at timestamp, n int"


def brute_force(listed, untracked):
    """The same history in plain Python, one key after another."""
    out = []
    for key in {r[0] for r in listed}:
        last_at = {}
        for r in sorted((r for r in listed if r[0] == key), key=lambda r: (r[3], r[4])):
            last_at[r[3]] = r
        versions = []
        for at in sorted(last_at):
            r = last_at[at]
            if versions and versions[-1]["state"] == r[1]:
                if untracked == "latest":
                    versions[-1]["note"] = r[2]
            else:
                versions.append({"state": r[1], "note": r[2], "start": at})
        for v, after in zip(versions, [*versions[1:], None]):
            out.append((key, v["note"], v["state"], v["start"], after and after["start"]))
    return sorted(out, key=lambda r: (r[0], r[3]))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("untracked", ["first", "latest"])
@pytest.mark.parametrize("hot_rows", [10**6, 100, 1])
def test_history_against_brute_force(spark, seed, untracked, hot_rows):
    listed = random_feed(seed)
    feed = spark.createDataFrame(listed, FEED).repartition(5)
    found = hist.scd2_history(
        feed, ["id"], "at", ["state"], ["note"], ["n"], "half_open", untracked, hot_rows
    )
    found = sorted((tuple(r) for r in found.collect()), key=lambda r: (r[0], r[3]))
    assert found == brute_force(listed, untracked)


def test_versions_of_a_key_leave_no_gap_and_one_is_open(spark):
    feed = spark.createDataFrame(random_feed(3), FEED)
    history = hist.scd2_history(feed, ["id"], "at", ["state"], tiebreak=["n"], encoding="half_open")
    by_key = {}
    for r in sorted(history.collect(), key=lambda r: (r["id"], r["__START_AT"])):
        by_key.setdefault(r["id"], []).append(r)
    for versions in by_key.values():
        assert [v["__END_AT"] for v in versions] == [v["__START_AT"] for v in versions[1:]] + [None]
        assert all(a["state"] != b["state"] for a, b in zip(versions, versions[1:]))


@pytest.mark.parametrize("back", [True, False])
def test_neighbours_across_slices(spark, back):
    listed = [(k, i, None if i % 5 == 0 else i) for k in range(3) for i in range(200)]
    df = spark.createDataFrame(listed, "k int, i int, v int").repartition(7)
    plain = neighbour(df, ["k"], ["i"], F.col("v"), "other", back)
    with spark_slices(spark, 6):
        sliced_rows = range_slices(df, ["k", "i"])
        assert sliced_rows.select("_slice").distinct().count() > 3
        sliced = neighbour(sliced_rows, ["k"], ["i"], F.col("v"), "other", back)
        assert rows(sliced.select("k", "i", "v", "other")) == rows(plain)


class spark_slices:
    """Several sort tasks even for few rows."""

    def __init__(self, spark, slices):
        self.conf, self.slices = spark.conf, slices

    def __enter__(self):
        self.before = self.conf.get("spark.sql.shuffle.partitions")
        self.conf.set("spark.sql.shuffle.partitions", str(self.slices))
        self.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")

    def __exit__(self, *_):
        self.conf.set("spark.sql.shuffle.partitions", self.before)
        self.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("untracked", ["first", "latest"])
def test_hot_key_over_many_slices(spark, untracked):
    listed = random_feed(5, size=900)
    feed = spark.createDataFrame(listed, FEED).repartition(5)
    with spark_slices(spark, 9):
        found = hist.scd2_history(
            feed, ["id"], "at", ["state"], ["note"], ["n"], "half_open", untracked, hot_rows=50
        )
        found = sorted((tuple(r) for r in found.collect()), key=lambda r: (r[0], r[3]))
    assert found == brute_force(listed, untracked)


def test_days_of_a_half_open_history_merge_into_versions(spark):
    """X, then on one day Y and X again: one version, as if it had been made by days."""
    moments = [(1, "x", datetime(2024, 1, 1)), (1, "y", datetime(2024, 1, 5, 8)), (1, "x", datetime(2024, 1, 5, 9))]
    moments += [(1, "z", datetime(2024, 1, 7)), (2, "x", datetime(2024, 1, 2)), (2, None, datetime(2024, 1, 3))]
    feed = spark.createDataFrame(moments, "id int, city string, at timestamp")
    half_open = hist.scd2_history(feed, ["id"], "at", ["city"], encoding="half_open")
    closed = hist.scd2_history(feed, ["id"], "at", ["city"])
    columns = ["id", "city", "valid_from", "valid_to", "is_current"]
    merged = hist.to_closed(half_open, ["id"], ["city"])
    assert rows(merged.select(columns)) == rows(closed.select(columns))
    assert hist.to_closed(half_open).count() == closed.count() + 1
