"""Bulk loads of delimited files whose columns change from file to file.

The header of every new file is read, files with the same header are read together under their
own columns, and the rows meet by column name. Columns that the table does not have yet are added
to it; earlier rows have NULL there. A table is a published one (see ``sources/published.py``):
the rows of a load, the list of files it took and the columns become visible at once, so each
file is in the table exactly once, whatever fails.
"""

from __future__ import annotations

import csv
import io
from collections import defaultdict
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import published, store
from strata.sources.files import batch_glob, text_schema, with_lineage

# Bytes of a file within which its header has to end.
HEADER_BYTES = 1 << 16
# Files whose header is read at a time.
_READERS = 16
_FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("changed", T.LongType()),
    ]
)


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The column names in the first record of a file, without blanks around them; () if empty.

    An error for a file with an empty or repeated name (case does not count) and for one whose
    header does not end within ``HEADER_BYTES``.
    """
    head = store.first_bytes(spark, path, HEADER_BYTES)
    text = head.decode("utf-8-sig", errors="ignore")
    names = tuple(name.strip() for name in next(csv.reader(io.StringIO(text)), []))
    if len(head) == HEADER_BYTES and not any(end in text for end in "\r\n"):
        raise ValueError(f"the header of {path} is longer than {HEADER_BYTES} bytes")
    lowered = [name.lower() for name in names]
    if "" in lowered or len(set(lowered)) < len(lowered):
        raise ValueError(f"the header of {path} has an empty or repeated name: {names}")
    return names


def headers_of(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header; empty files are left out."""
    with ThreadPoolExecutor(_READERS) as pool:
        found = list(pool.map(lambda path: header_of(spark, path), paths))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for names, path in zip(found, paths):
        if names:
            groups[names].append(path)
    return dict(groups)


def merged_columns(known: Sequence[str], headers: Sequence[Sequence[str]]) -> list[str]:
    """``known`` and then what headers add, in the order of the headers; case does not count."""
    merged = {name.lower(): name for name in known}
    for names in headers:
        for name in names:
            merged.setdefault(name.lower(), name)
    return list(merged.values())


def read_by_header(
    spark: SparkSession, groups: dict[tuple[str, ...], list[str]], columns: Sequence[str]
) -> DataFrame:
    """Rows of all files as text under ``columns``, with lineage; NULL where a file has no such column."""
    parts = []
    for names, paths in sorted(groups.items()):
        own = {name.lower(): name for name in names}
        rows = with_lineage(spark.read.schema(text_schema(names)).option("header", True).csv(paths))
        values = [
            F.col(f"`{own[c.lower()]}`") if c.lower() in own else F.lit(None).cast("string")
            for c in columns
        ]
        lineage = rows.columns[len(names) :]
        parts.append(rows.select(*[v.alias(c) for v, c in zip(values, columns)], *lineage))
    return reduce(DataFrame.unionByName, parts)


def load_files(
    spark: SparkSession,
    root: str,
    entity: str,
    columns: Sequence[str],
    path: str,
    force: bool = False,
    merge_schema: bool = True,
    select: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> int:
    """Load the files of an entity that ``path`` does not have yet; the number of rows loaded.

    ``columns`` are those of a new table. With ``merge_schema`` names in other headers become
    columns of the table; without it they stop the load before anything is written. Columns that
    a file lacks are NULL. ``force`` loads all files anew and drops the rows loaded before, but
    no column. ``select`` projects while loading. A file counts as loaded by its path, size and
    time of change: one that was overwritten is loaded as a new one.
    """
    path = path.rstrip("/")
    version = published.latest(spark, path)
    listed = store.matching(spark, batch_glob(root, entity))
    files = spark.createDataFrame([(f.path, f.size, f.changed) for f in listed], _FILES)
    if not force:
        loaded = published.rows_of(spark, path, version.folders.get("files", []), _FILES)
        files = files.join(loaded, ["path", "size", "changed"], "left_anti")
    new = sorted(row["path"] for row in files.collect())
    if not new and not force:
        return 0
    groups = headers_of(spark, new)
    # What earlier loads found stays known, with select's columns apart from it.
    known = version.notes.get("columns", list(columns))
    merged = merged_columns(known, list(groups))
    if not merge_schema and len(merged) > len(known):
        raise ValueError(f"columns that the table does not have: {merged[len(known):]}")

    kept = {kind: [] if force else version.folders.get(kind, []) for kind in ("rows", "files")}
    schema = T.StructType.fromJson(version.notes["schema"]) if "schema" in version.notes else None
    count = 0
    if groups:
        rows = select(read_by_header(spark, groups, merged))
        folder = published.new_folder(path)
        rows.write.parquet(f"{path}/{folder}")
        kept["rows"] = [*kept["rows"], folder]
        count = published.rows_of(spark, path, [folder], rows.schema).count()
        schema = _with_new_fields(schema, published.stored_schema(rows.schema))
    taken = published.new_folder(path, "files")
    ledger = spark.createDataFrame([(f.path, f.size, f.changed) for f in listed if f.path in set(new)], _FILES)
    ledger.coalesce(1).write.parquet(f"{path}/{taken}")
    kept["files"] = [*kept["files"], taken]
    if schema is None:
        return 0
    notes = {"columns": merged, "schema": schema.jsonValue(), "loaded": count}
    published.publish(spark, path, kept, notes, version)
    published.expire(spark, path)
    return count


def _with_new_fields(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """All fields of the table, new ones last; an error if one has changed its type."""
    if old is None:
        return new
    types = {f.name.lower(): f.dataType for f in old}
    for field in new:
        if types.setdefault(field.name.lower(), field.dataType) != field.dataType:
            raise ValueError(f"{field.name} was {types[field.name.lower()]}, now {field.dataType}")
    known = {f.name.lower() for f in old}
    return T.StructType([*old.fields, *[f for f in new if f.name.lower() not in known]])
