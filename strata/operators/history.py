"""Slowly changing dimensions: one row per version of a key.

Two encodings of a version's validity:

closed     valid_from, valid_to (last day, 9999-12-31 while open), is_current
half-open  __START_AT, __END_AT (start of the next version, NULL while open)

``tracked`` columns open a new version when they change; ``carried`` columns travel along.
All comparisons take NULL as a value, so a change from or to NULL is a change and a NULL on
both sides is none.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.batches import OPEN_END
from strata.functions.compare import same
from strata.functions.dates import day_before
from strata.operators.clean import latest_wins, with_keys
from strata.operators.ordered import dense_numbers, neighbour, range_slices
from strata.operators.skew import HOT_ROWS, hot_keys
from strata.scratch import materialise

# The column names of the two encodings.
VALID_FROM, VALID_TO, IS_CURRENT = "valid_from", "valid_to", "is_current"
START_AT, END_AT = "__START_AT", "__END_AT"


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


# --- encodings ---------------------------------------------------------------------------


def encode(df: DataFrame, start: str, end: str, encoding: str) -> DataFrame:
    """Columns ``start`` and ``end`` (start of the next version or NULL) in an encoding.

    The closed encoding knows days only: of several versions that start on one day the last
    one stays.
    """
    others = [c for c in df.columns if c not in (start, end)]
    if encoding == "half_open":
        return df.select(*others, F.col(start).alias(START_AT), F.col(end).alias(END_AT))
    if encoding == "closed":
        first, following = F.col(start).cast("date"), F.col(end).cast("date")
        df = df.filter(following.isNull() | (first < following))
        return df.select(
            *others,
            F.col(start).cast("date").alias(VALID_FROM),
            F.coalesce(day_before(F.col(end).cast("date")), F.lit(OPEN_END)).alias(VALID_TO),
            F.col(end).isNull().alias(IS_CURRENT),
        )
    raise ValueError(f"unknown encoding {encoding}")


def to_closed(
    df: DataFrame, keys: Sequence[str] = (), tracked: Sequence[str] = ()
) -> DataFrame:
    """Half-open history in the closed encoding.

    Of several versions that start on one day the last one stays, and may then be like the one
    before: with ``keys`` and ``tracked`` such neighbours become one version, as in a history
    that was made in the closed encoding. Histories of whole days need neither.
    """
    closed = encode(df, START_AT, END_AT, "closed")
    if not keys:
        return closed
    state = F.struct(*_columns(tracked), F.lit(True).alias("_present"))
    marked = neighbour(closed, keys, [VALID_FROM], state, "_before", back=True)
    starts = marked.filter(~state.eqNullSafe(F.col("_before"))).drop("_before")
    ended = neighbour(starts, keys, [VALID_FROM], F.col(VALID_FROM), "_end", back=False)
    others = [c for c in closed.columns if c not in (VALID_TO, IS_CURRENT)]
    return ended.select(
        *others,
        F.coalesce(day_before(F.col("_end")), F.lit(OPEN_END)).alias(VALID_TO),
        F.col("_end").isNull().alias(IS_CURRENT),
    )


def to_half_open(df: DataFrame) -> DataFrame:
    """Closed history in the half-open encoding."""
    others = [c for c in df.columns if c not in (VALID_FROM, VALID_TO, IS_CURRENT)]
    next_start = F.when(~F.col(IS_CURRENT), F.date_add(VALID_TO, 1))
    return df.select(*others, F.col(VALID_FROM).alias(START_AT), next_start.alias(END_AT))


def end_by_next(
    df: DataFrame, keys: Sequence[str], start: str, encoding: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """History out of version starts alone: a version ends where the next one begins."""

    def ended(rows: DataFrame) -> DataFrame:
        found = neighbour(rows, keys, [start], F.col(start), "_end", back=False)
        return found.select(*df.columns, "_end")

    hot = hot_keys(df, keys, hot_rows)
    if not hot:
        return encode(ended(df), start, "_end", encoding)
    usual, rows = hot.split(df)
    rows = rows.withColumn("_spread", F.xxhash64(*df.columns))
    large = range_slices(rows, [*keys, start, "_spread"])
    both = ended(usual).unionByName(ended(large))
    return encode(both, start, "_end", encoding)


def carried_except(
    df: DataFrame, keys: Sequence[str], tracked: Sequence[str], leave_out: Sequence[str] = ()
) -> list[str]:
    """All columns of ``df`` that are neither keys nor tracked nor in ``leave_out``."""
    return [c for c in df.columns if c not in {*keys, *tracked, *leave_out}]


# --- type 1 ------------------------------------------------------------------------------


def scd1(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], key_name: str):
    """Latest row per key, with a dense surrogate key in key order."""
    return dense_numbers(latest_wins(df, keys, order), keys, key_name)


# --- type 2 from an ordered change feed --------------------------------------------------


def _versions(
    df: DataFrame,
    keys: Sequence[str],
    sequence: str,
    order: Sequence[str],
    tracked: Sequence[str],
    carried: Sequence[str],
    untracked: str,
) -> DataFrame:
    """One row per version with its start and the start of the next one as ``_end``.

    Works on whole keys and on slices alike; see :func:`neighbour`.
    """
    sliced = "_slice" in df.columns
    if not sliced:
        # Several rows of one key at one point of the sequence: the last one counts.
        df = neighbour(df, keys, order, F.col(sequence), "_next", back=False)
        df = df.filter(~F.col("_next").eqNullSafe(F.col(sequence))).drop("_next")
    # From here on the sequence alone orders the rows of a key.
    order = [sequence]
    state = F.struct(*_columns(tracked), F.lit(True).alias("_present"))
    df = neighbour(df, keys, order, state, "_before", back=True)
    df = df.withColumn("_starts", ~state.eqNullSafe(F.col("_before"))).drop("_before")
    if untracked == "latest" and carried:
        df = neighbour(df, keys, order, F.col("_starts"), "_next_starts", back=False)
        df = df.withColumn("_ends", F.coalesce("_next_starts", F.lit(True)))
        df = df.filter(F.col("_starts") | F.col("_ends")).drop("_next_starts")
        if sliced:
            df = materialise(df, "version-borders")
        # What is left per version is its first row and, if another one, its last.
        df = neighbour(df, keys, order, F.struct(*_columns(carried)), "_last", back=False)
        own_or_last = {
            c: F.when(F.col("_ends"), F.col(c)).otherwise(F.col("_last")[c]) for c in carried
        }
        df = df.withColumns(own_or_last).drop("_last", "_ends")
        df = df.filter("_starts")
    else:
        df = df.filter("_starts")
        if sliced:
            df = materialise(df, "version-starts")
    df = neighbour(df, keys, order, F.col(sequence), "_end", back=False)
    return df.select(*keys, *carried, *tracked, sequence, "_end")


def scd2_history(
    df: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tracked: Sequence[str],
    carried: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    encoding: str = "closed",
    untracked: str = "first",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Versions of every key out of any number of change rows in any arrival order.

    ``carried`` may come from :func:`carried_except`.

    ``untracked`` says what a version shows in its carried columns: those of its ``first`` row
    or of its ``latest`` one. Rows without key or sequence are left out. ``tiebreak`` settles
    which of several rows at one point of the sequence counts; by default all columns do.
    In the closed encoding a point is a day: the last state of each day counts.

    Keys take one shuffle and one sort for all windows together. The rows of a key beyond
    ``hot_rows`` are cut into range slices instead, each handled by a task of its own. Looking
    for such keys reads the key columns of ``df`` once more, so give it stored rows.
    """
    if untracked not in ("first", "latest"):
        raise ValueError(f"unknown policy {untracked}")
    keys, tracked, carried = list(keys), list(tracked), list(carried)
    if not tiebreak:
        tiebreak = [*carried, *tracked]
    wanted = list(dict.fromkeys([*keys, *carried, *tracked, sequence, *tiebreak]))
    rows = with_keys(df.select(*wanted), [*keys, sequence])
    if encoding == "closed" and dict(df.dtypes)[sequence] != "date":
        rows = rows.withColumn("_moment", F.col(sequence))
        rows = rows.withColumn(sequence, F.col(sequence).cast("date"))
        tiebreak = ["_moment", *tiebreak]
    order = [sequence, *[c for c in tiebreak if c != sequence]]
    args = (keys, sequence, order, tracked, carried, untracked)

    hot = hot_keys(rows, keys, hot_rows)
    if not hot:
        return encode(_versions(rows, *args), sequence, "_end", encoding)
    usual, large = hot.split(rows)
    ordinary = _versions(usual, *args)
    single = latest_wins(large, [*keys, sequence], tiebreak)
    large = _versions(range_slices(single, [*keys, *order]), *args)
    return encode(ordinary.unionByName(large), sequence, "_end", encoding)


def version_borders(
    df: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tracked: Sequence[str],
    carried: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    encoding: str = "closed",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The rows of ``df`` that :func:`scd2_history` needs: the first and the last of each version.

    Their history is that of all rows, also together with any rows that come after them.
    """
    keys, order = list(keys), [*tiebreak] or [*carried, *tracked]
    moment = F.col(sequence).cast("date") if encoding == "closed" else F.col(sequence)
    rows = with_keys(df, [*keys, sequence]).withColumn("_point", moment)
    order = [sequence, *[c for c in order if c != sequence]]
    state = F.struct(*_columns(tracked), F.lit(True).alias("_present"))

    def borders(single: DataFrame) -> DataFrame:
        single = neighbour(single, keys, ["_point"], state, "_before", back=True)
        single = neighbour(single, keys, ["_point"], state, "_after", back=False)
        inner = state.eqNullSafe(F.col("_before")) & state.eqNullSafe(F.col("_after"))
        return single.filter(~inner).select(*df.columns)

    hot = hot_keys(rows, keys, hot_rows)
    single = latest_wins(rows, [*keys, "_point"], order)
    if not hot:
        return borders(single)
    usual, large = hot.split(single)
    return borders(usual).unionByName(borders(range_slices(large, [*keys, "_point"])))


# --- type 2 from snapshots ---------------------------------------------------------------


def scd2_compare(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    carried: Sequence[str],
    old_from: date,
    new_from: date,
) -> DataFrame:
    """Closed history out of two snapshots, each with one row per key.

    A key only in the old snapshot, or in both without a tracked change, keeps its old row; a
    changed key gets the old row closed and the new one opened; a new key gets its new row.
    Snapshots of one date are two states of one day, of which the new one counts. One full outer
    join; every joined row turns into one or two versions on the spot.
    """
    if new_from < old_from:
        raise ValueError("the new snapshot has the earlier date")
    snapshot = old.select(*keys, *carried, *tracked).withColumn(VALID_FROM, F.lit(old_from))
    opened = snapshot.withColumns({VALID_TO: F.lit(OPEN_END), IS_CURRENT: F.lit(True)})
    later = new.select(*keys, *carried, *tracked).withColumn(VALID_FROM, F.lit(new_from))
    return _apply_snapshot(opened, later, keys, tracked, carried, same_day=old_from == new_from)


def scd2_fold(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    carried: Sequence[str],
    effective: str | date,
) -> DataFrame:
    """The next state of a closed history after one more snapshot, one row per key in it.

    ``effective`` is the snapshot's date or the column that holds each row's. A row that is
    not later than the open version of its key changes nothing, so a snapshot may be applied
    again. Closed versions pass by without a shuffle; write the result to a new path.
    """
    start = F.col(effective) if isinstance(effective, str) else F.lit(effective)
    later = with_keys(snapshot, keys).select(
        *keys, *carried, *tracked, start.cast("date").alias(VALID_FROM)
    )
    opened = history.filter(F.col(IS_CURRENT))
    after = _apply_snapshot(opened, later, keys, tracked, carried)
    return history.filter(~F.col(IS_CURRENT)).select(*after.columns).unionByName(after)


def empty_history(spark, key_fields, attribute_fields) -> DataFrame:
    """A closed history without rows, to fold the first snapshot into."""
    from pyspark.sql import types as T

    schema = T.StructType([*key_fields, *attribute_fields])
    for name, kind in ((VALID_FROM, T.DateType()), (VALID_TO, T.DateType())):
        schema = schema.add(name, kind)
    return spark.createDataFrame([], schema.add(IS_CURRENT, T.BooleanType()))


def _apply_snapshot(opened, later, keys, tracked, carried, same_day: bool = False) -> DataFrame:
    keys, attributes = list(keys), [*carried, *tracked]
    left = opened.select(*keys, F.struct(*attributes, VALID_FROM).alias("_open"))
    right = later.select(*keys, F.struct(*attributes, VALID_FROM).alias("_new"))
    opened_row, new_row = F.col("_open"), F.col("_new")

    def version(row: Column, end: Column, current: bool) -> Column:
        return F.struct(
            *[row[c].alias(c) for c in attributes],
            row[VALID_FROM].alias(VALID_FROM),
            end.alias(VALID_TO),
            F.lit(current).alias(IS_CURRENT),
        )

    unchanged = same([opened_row[c] for c in tracked], [new_row[c] for c in tracked])
    stays = new_row.isNull() if same_day else (
        new_row.isNull() | unchanged | (new_row[VALID_FROM] <= opened_row[VALID_FROM])
    )
    replaces = F.lit(same_day) & new_row.isNotNull()
    open_end = F.lit(OPEN_END)
    versions = (
        F.when(opened_row.isNull() | replaces, F.array(version(new_row, open_end, True)))
        .when(stays, F.array(version(opened_row, open_end, True)))
        .otherwise(
            F.array(
                version(opened_row, day_before(new_row[VALID_FROM]), False),
                version(new_row, open_end, True),
            )
        )
    )
    return (
        left.join(right, keys, "full")
        .select(*keys, F.explode(versions).alias("_version"))
        .select(*keys, "_version.*")
    )
