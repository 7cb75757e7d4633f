"""Tables that change as a whole: versions of folders, and a pointer that is written last.

Below the path of a table:

_versions/000000000042.json   what version 42 consists of: lists of folders, and notes
_data/...                     the folders, each written once and never changed or moved

A writer fills new folders and then writes the file of the next version. Readers take the
latest version whose file is whole, so they see a table before or after a change and never in
between or not at all, and a job that fails leaves no trace but folders nobody refers to. No data
is renamed or copied, which makes no difference between a file system and an object store.

A table has one writer at a time: of two that publish the same number the second fails.
Superseded folders are kept for readers that still use them; ``expire`` deletes those that were
superseded long enough ago.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sources import store

KEPT = 2
HOLD_SECONDS = 24 * 3600.0
_VERSIONS, _DATA, _END = "_versions", "_data", ".json"


class Version(NamedTuple):
    """``folders`` by kind, as names below the table; ``notes`` are the writer's own."""

    number: int
    folders: dict[str, list[str]]
    notes: dict[str, Any]


NONE = Version(-1, {}, {})


def _file(path: str, number: int) -> str:
    return f"{path}/{_VERSIONS}/{number:012d}{_END}"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    found = [e.name for e in store.listed(spark, f"{path}/{_VERSIONS}")]
    return sorted(int(n.removesuffix(_END)) for n in found if n.endswith(_END))


def _read(spark: SparkSession, path: str, number: int) -> Version | None:
    """A version; None where its writer has not come to the end."""
    try:
        content = json.loads(store.read_text(spark, _file(path, number)))
    except ValueError:
        return None
    return Version(number, content["folders"], content["notes"])


def latest(spark: SparkSession, path: str) -> Version:
    """The version that readers get now; ``NONE`` for a path without any."""
    path = path.rstrip("/")
    for number in reversed(_numbers(spark, path)):
        if (version := _read(spark, path, number)) is not None:
            return version
    return NONE


def new_folder(path: str, kind: str = "rows") -> str:
    """The name of a folder to fill, below the table."""
    return f"{_DATA}/folder={kind}-{uuid.uuid4().hex}"


def publish(
    spark: SparkSession,
    path: str,
    folders: Mapping[str, Iterable[str]],
    notes: Mapping[str, Any],
    after: Version,
) -> Version:
    """Make ``folders`` the table; an error if it has changed since ``after`` was read."""
    path = path.rstrip("/")
    current = latest(spark, path)
    if current.number != after.number:
        raise ValueError(f"{path} was changed by another writer: {after.number}, now {current.number}")
    content = {"folders": {k: list(v) for k, v in folders.items()}, "notes": dict(notes)}
    # A number that a writer left unfinished stays taken.
    number = max([*_numbers(spark, path), -1]) + 1
    store.write_new(spark, _file(path, number), json.dumps(content))
    return Version(number, content["folders"], content["notes"])


def expire(
    spark: SparkSession, path: str, keep: int = KEPT, hold_seconds: float = HOLD_SECONDS
) -> int:
    """Delete what no reader can still use; the number of folders deleted.

    The latest ``keep`` versions stay, and all versions that were superseded less than
    ``hold_seconds`` ago. Folders that no version refers to go when they are as old, those of a
    writer that failed among them; a writer must not take longer than that.
    """
    path = path.rstrip("/")
    before = time.time() * 1000 - hold_seconds * 1000
    files = sorted(store.listed(spark, f"{path}/{_VERSIONS}"), key=lambda e: e.name)
    files = [e for e in files if e.name.endswith(_END)]
    used: set[str] = set()
    for at, entry in enumerate(files):
        following = files[at + 1 : at + 2]
        if at < len(files) - max(keep, 1) and following and following[0].changed <= before:
            store.delete(spark, entry.path)
            continue
        version = _read(spark, path, int(entry.name.removesuffix(_END)))
        if version is not None:
            used |= {folder for listed in version.folders.values() for folder in listed}
    old = [e for e in store.listed(spark, f"{path}/{_DATA}") if e.changed <= before]
    dropped = [e for e in old if f"{_DATA}/{e.name}" not in used]
    for entry in dropped:
        store.delete(spark, entry.path)
    return len(dropped)


def stored_schema(schema: T.DataType) -> Any:
    """A schema as files have it: anything may be NULL. So it is compared and kept in notes."""
    if isinstance(schema, T.StructType):
        fields = [(f.name, stored_schema(f.dataType), f.metadata) for f in schema]
        return T.StructType([T.StructField(n, kind, True, data) for n, kind, data in fields])
    if isinstance(schema, T.ArrayType):
        return T.ArrayType(stored_schema(schema.elementType), True)
    if isinstance(schema, T.MapType):
        return T.MapType(stored_schema(schema.keyType), stored_schema(schema.valueType), True)
    return schema


def rows_of(
    spark: SparkSession, path: str, folders: Iterable[str], schema: T.StructType
) -> DataFrame:
    """The rows of some folders of a table, as one DataFrame; columns a folder lacks are NULL."""
    root = path.rstrip("/")
    paths = [f"{root}/{folder}" for folder in folders]
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{root}/{_DATA}").parquet(*paths)
    return rows.select(*[f"`{f.name}`" for f in schema])
