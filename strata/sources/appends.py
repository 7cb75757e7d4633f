"""Tables that are only added to, with compaction that readers do not notice.

Every row carries the number of the append that brought it. A reader's position is the last
number it has taken; it asks for rows with larger ones. Compaction writes the rows of many small
folders into one and leaves their numbers, so it neither repeats a row for a reader nor hides one.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import published, store

APPEND = "_append"
# Rows of a folder that is not merged with others any more.
FULL_ROWS = 5_000_000


def append(df: DataFrame, path: str, once: tuple[str, int] | None = None) -> int:
    """Add rows to the table at ``path``; how many. The columns of a table stay.

    ``once`` names a stream and its micro-batch: what has been added before is not added again.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    version = published.latest(spark, path)
    notes: dict[str, Any] = {"last": 0, "taken": {}, "parts": [], **version.notes}
    numbered = df.withColumn(APPEND, F.lit(notes["last"] + 1).cast("long"))
    schema = published.stored_schema(numbered.schema).jsonValue()
    if notes.setdefault("schema", schema) != schema:
        raise ValueError(f"the table was made with {notes['schema']}")
    if once is not None and notes["taken"].get(once[0], -1) >= once[1]:
        return 0
    folder = published.new_folder(path)
    numbered.write.parquet(f"{path}/{folder}")
    rows = published.rows_of(spark, path, [folder], numbered.schema).count()
    if once is not None:
        notes["taken"] = {**notes["taken"], once[0]: once[1]}
    if rows:
        notes["last"] += 1
        part = {"folder": folder, "first": notes["last"], "last": notes["last"], "rows": rows}
        notes["parts"] = [*notes["parts"], part]
    _publish(spark, path, notes, version)
    return rows


def _publish(spark, path, notes, version) -> None:
    folders = {"rows": [part["folder"] for part in notes["parts"]]}
    published.publish(spark, path, folders, notes, version)


def sink(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append all that a stream has available, each micro-batch once; then stop."""
    spark = stream.sparkSession

    def take(batch: DataFrame, number: int) -> None:
        name = json.loads(store.read_text(spark, f"{checkpoint}/metadata"))["id"]
        append(batch, path, (name, number))

    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _rows(spark, path, version, after: int, upto: int | None = None) -> DataFrame:
    schema = T.StructType.fromJson(version.notes["schema"])
    listed = [p["folder"] for p in version.notes["parts"] if p["last"] > after]
    rows = published.rows_of(spark, path, listed, schema).filter(F.col(APPEND) > after)
    return rows if upto is None else rows.filter(F.col(APPEND) <= upto)


def read_appends(spark: SparkSession, path: str, after: int = 0) -> DataFrame:
    """The rows added by appends later than ``after``, with their number."""
    version = published.latest(spark, path)
    if version is published.NONE:
        raise ValueError(f"there is no table at {path}")
    return _rows(spark, path, version, after)


def follow(
    spark: SparkSession, path: str, state: str, take: Callable[[DataFrame, int], None]
) -> int:
    """Hand the rows that are new since the last call to ``take``; the new position.

    ``take`` gets the rows and the number of the last append among them; with that number as
    ``once`` its own appends are made once, even if it is called again because it failed. The
    position below ``state`` moves on when it has returned.
    """
    version, known = published.latest(spark, path), published.latest(spark, state)
    position = known.notes.get("position", 0)
    last = version.notes.get("last", 0)
    if last > position:
        take(_rows(spark, path, version, position).drop(APPEND), last)
        published.publish(spark, state, {}, {"position": last}, known)
        published.expire(spark, state)
    return last


def compact_appends(
    spark: SparkSession,
    path: str,
    full_rows: int = FULL_ROWS,
    hold_seconds: float = published.HOLD_SECONDS,
) -> int:
    """Merge neighbouring folders of less than ``full_rows`` rows; folders that are left.

    Each merged folder holds up to about ``full_rows`` rows, in as few files as adaptive
    execution makes of them.
    """
    path = path.rstrip("/")
    version = published.latest(spark, path)
    groups: list[list[dict]] = []
    for part in version.notes.get("parts", []):
        size = sum(p["rows"] for p in groups[-1]) if groups else full_rows
        if size + part["rows"] <= full_rows and groups:
            groups[-1].append(part)
        else:
            groups.append([part])
    parts = []
    for group in groups:
        if len(group) == 1:
            parts += group
            continue
        folder = published.new_folder(path)
        schema = T.StructType.fromJson(version.notes["schema"])
        rows = published.rows_of(spark, path, [p["folder"] for p in group], schema)
        rows.hint("rebalance").write.parquet(f"{path}/{folder}")
        parts.append(
            {
                "folder": folder,
                "first": group[0]["first"],
                "last": group[-1]["last"],
                "rows": sum(p["rows"] for p in group),
            }
        )
    if len(parts) < len(version.notes.get("parts", [])):
        notes = {**version.notes, "parts": parts}
        _publish(spark, path, notes, version)
    published.expire(spark, path, hold_seconds=hold_seconds)
    return len(parts)
