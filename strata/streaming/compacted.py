"""History from a stream of change rows, with work that follows the change.

``apply_changes`` of the module beside this one derives whole buckets anew; here a micro-batch
derives the keys it touches and nothing else. A target is a published table (see
``sources/published.py``) of these kinds of folders, all in parts by a hash of the key:

log      change rows as they came, one folder a micro-batch
reduced  what is left of older change rows: the first and last row of each version
archive  the older change rows in full, read only for keys that get a late row
history  versions; a folder holds all versions of the keys that one micro-batch touched, so of
         several folders with a key the newest has its versions

Compaction moves the log to the archive, except for its late tail: rows before the cut are
reduced to the borders of versions, rows after it stay as they are. Rows that come in order meet
the reduced rows of their keys. A row from before the cut may lie between rows that were left
out, so its key is derived from the archive as well, and comes out as if nothing had been reduced.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.operators.clean import with_keys
from strata.operators.history import scd2_history, version_borders
from strata.operators.skew import HOT_ROWS, key_hash
from strata.sources import published

BUCKET, GENERATION = "_bucket", "_generation"


class Feed(NamedTuple):
    """What a target is made with; see ``scd2_history`` for the columns and policies."""

    keys: list[str]
    sequence: str
    tracked: list[str]
    carried: list[str] = []
    tiebreak: list[str] = []
    encoding: str = "half_open"
    untracked: str = "latest"
    buckets: int = 64

    def columns(self) -> list[str]:
        names = [*self.keys, *self.carried, *self.tracked, self.sequence, *self.tiebreak]
        return list(dict.fromkeys(names))

    def point(self) -> Column:
        """What orders a row: in the closed encoding its day."""
        column = F.col(self.sequence)
        return column.cast("date") if self.encoding == "closed" else column

    def bucket(self) -> Column:
        return F.pmod(key_hash(self.keys), F.lit(self.buckets)).cast("int")

    def history(self, rows: DataFrame, hot_rows: int) -> DataFrame:
        return scd2_history(
            rows, self.keys, self.sequence, self.tracked, self.carried, self.tiebreak,
            self.encoding, self.untracked, hot_rows,
        )


def absorb(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    feed: Feed,
    compact_after: int = 50,
    hot_rows: int = HOT_ROWS,
) -> None:
    """Take in all available change rows, then stop; one writer per target.

    A target that was made with another ``feed`` is refused. When the history has
    ``compact_after`` folders the target is compacted. A micro-batch counts when its version is
    published; one that failed before leaves nothing, one that is delivered twice adds rows that
    are there already and changes no history.
    """
    spark = stream.sparkSession

    def take(batch: DataFrame, _: int) -> None:
        version = _checked(spark, target, feed)
        folder = published.new_folder(target, "log")
        rows = with_keys(batch.select(*feed.columns()), [*feed.keys, feed.sequence])
        schema = _store(rows, feed, f"{target}/{folder}")
        # At most one row per bucket comes to the driver.
        arrived = published.rows_of(spark, target, [folder], schema)
        buckets = [r[0] for r in arrived.select(BUCKET).distinct().collect()]
        if not buckets:
            return
        folders = {k: list(v) for k, v in version.folders.items()}
        folders["log"] = [*folders.get("log", []), folder]
        notes = {**version.notes, "feed": json.dumps(feed), "log_schema": schema.jsonValue()}
        rows = changed_rows(spark, target, feed, folders, notes, arrived, buckets)
        _add_history(spark, target, feed, version, folders, notes, rows, hot_rows)
        if len(folders["history"]) >= compact_after:
            compact(spark, target, feed, hot_rows=hot_rows)

    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _checked(spark: SparkSession, target: str, feed: Feed) -> published.Version:
    version = published.latest(spark, target)
    known = version.notes.get("feed", json.dumps(feed))
    if known != json.dumps(feed):
        raise ValueError(f"the target was made with {known}, not with {json.dumps(feed)}")
    return version


def _store(rows: DataFrame, feed: Feed, path: str) -> T.StructType:
    """Rows in parts by bucket; small pieces are merged and large ones split as they are written."""
    placed = rows.withColumn(BUCKET, feed.bucket())
    placed.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(path)
    return placed.schema


def changed_rows(
    spark: SparkSession,
    target: str,
    feed: Feed,
    folders: dict[str, list[str]],
    notes: dict,
    arrived: DataFrame,
    buckets: Sequence[int],
) -> DataFrame:
    """All that the history of the keys in ``arrived`` follows from, and no other rows."""
    schema = T.StructType.fromJson(notes["log_schema"])
    touched = arrived.select(*feed.keys).distinct()

    def of_keys(kinds: Sequence[str], keys: DataFrame) -> DataFrame:
        listed = [folder for kind in kinds for folder in folders.get(kind, [])]
        rows = published.rows_of(spark, target, listed, schema)
        return rows.filter(F.col(BUCKET).isin(*buckets)).join(keys, feed.keys, "left_semi")

    rows = of_keys(["log", "reduced"], touched)
    if (cut := _cut(feed, schema, notes)) is not None:
        late = of_keys(["log"], touched).filter(feed.point() < cut).select(*feed.keys).distinct()
        if not late.isEmpty():
            rows = rows.unionByName(of_keys(["archive"], late))
    return rows.drop(BUCKET)


def _cut(feed: Feed, schema: T.StructType, notes: dict) -> Column | None:
    """The point up to which change rows were reduced; None before the first compaction."""
    if notes.get("cut") is None:
        return None
    kind = "date" if feed.encoding == "closed" else schema[feed.sequence].dataType.simpleString()
    if kind == "timestamp":
        return F.timestamp_micros(F.lit(int(notes["cut"])))
    return F.lit(notes["cut"]).cast(kind)


def _cut_text(point: Column, schema: T.StructType, feed: Feed) -> Column:
    timed = schema[feed.sequence].dataType == T.TimestampType() and feed.encoding != "closed"
    return (F.unix_micros(point) if timed else point).cast("string")


def _add_history(spark, target, feed, version, folders, notes, rows, hot_rows) -> None:
    folder = published.new_folder(target, "history")
    versions = feed.history(rows, hot_rows).withColumn(GENERATION, F.lit(version.number + 1))
    schema = _store(versions, feed, f"{target}/{folder}")
    folders["history"] = [*folders.get("history", []), folder]
    notes["history_schema"] = schema.jsonValue()
    published.publish(spark, target, folders, notes, version)


def _history(spark: SparkSession, target: str, feed: Feed, version: published.Version) -> DataFrame:
    schema = T.StructType.fromJson(version.notes["history_schema"])
    listed = version.folders["history"]
    rows = published.rows_of(spark, target, listed, schema)
    if len(listed) > 1:
        newest = F.max(GENERATION).over(Window.partitionBy(BUCKET, *feed.keys))
        rows = rows.withColumn("_newest", newest).filter(F.col(GENERATION) == F.col("_newest"))
    return rows.drop("_newest")


def read_history(spark: SparkSession, target: str) -> DataFrame:
    """The history as the last micro-batch left it."""
    version = published.latest(spark, target)
    if version is published.NONE:
        raise ValueError(f"nothing has been absorbed into {target}")
    feed = Feed(*json.loads(version.notes["feed"]))
    return _history(spark, target, feed, version).drop(BUCKET, GENERATION)


def compact(
    spark: SparkSession,
    target: str,
    feed: Feed,
    keep_from: str | None = None,
    hot_rows: int = HOT_ROWS,
    hold_seconds: float = published.HOLD_SECONDS,
) -> None:
    """One history folder, and change rows before a cut reduced to the borders of versions.

    The cut is the latest point there is, or ``keep_from`` (as text): give the point from which
    rows may still come late, and keys with such rows will not need the archive. The history
    stays the same, and so does all that is derived from it later.
    """
    version = _checked(spark, target, feed)
    if version is published.NONE:
        return
    notes, folders = dict(version.notes), version.folders
    schema = T.StructType.fromJson(notes["log_schema"])

    def of(*kinds: str) -> DataFrame:
        listed = [folder for kind in kinds for folder in folders.get(kind, [])]
        return published.rows_of(spark, target, listed, schema)

    rows = of("log", "reduced")
    if (old := _cut(feed, schema, notes)) is not None:
        late = of("log").filter(feed.point() < old).select(*feed.keys).distinct()
        rows = rows.unionByName(of("archive").join(late, feed.keys, "left_semi"))
    latest = F.max(feed.point()) if keep_from is None else F.max(F.lit(keep_from).cast(
        dict(of().select(feed.point().alias("p")).dtypes)["p"]
    ))
    found = of("log", "reduced").agg(_cut_text(latest, schema, feed).alias("cut")).first()["cut"]
    before = old
    notes["cut"] = found
    cut = _cut(feed, schema, notes)
    if before is not None:
        # A cut never goes back: what was reduced stays reduced.
        further = spark.range(1).select(_cut_text(F.greatest(before, cut), schema, feed))
        notes["cut"] = further.first()[0]
        cut = _cut(feed, schema, notes)

    tail, reduced, history = (published.new_folder(target, k) for k in ("log", "reduced", "history"))
    _store(of("log").filter(feed.point() >= cut).drop(BUCKET), feed, f"{target}/{tail}")
    borders = version_borders(
        rows.filter(feed.point() < cut).drop(BUCKET), feed.keys, feed.sequence, feed.tracked,
        feed.carried, feed.tiebreak, feed.encoding, hot_rows,
    )
    _store(borders, feed, f"{target}/{reduced}")
    versions = _history(spark, target, feed, version).drop(BUCKET)
    _store(versions, feed, f"{target}/{history}")
    done = {
        "log": [tail],
        "reduced": [reduced],
        "archive": [*folders.get("archive", []), *folders.get("log", [])],
        "history": [history],
    }
    published.publish(spark, target, done, notes, version)
    published.expire(spark, target, hold_seconds=hold_seconds)
