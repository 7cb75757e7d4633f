"""Small files beside tables, through the file system that Spark itself uses for a path."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import SparkSession


class Entry(NamedTuple):
    """A file or folder: full path, last part of it, whether a folder, bytes, milliseconds."""

    path: str
    name: str
    folder: bool
    size: int
    changed: int


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _entry(status) -> Entry:
    path = status.getPath()
    return Entry(
        path.toString(), path.getName(), status.isDirectory(), status.getLen(), status.getModificationTime()
    )


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place)


def listed(spark: SparkSession, path: str) -> list[Entry]:
    """What lies right in a folder; nothing if there is none."""
    place, files = _place(spark, path)
    return [_entry(s) for s in files.listStatus(place)] if files.exists(place) else []


def matching(spark: SparkSession, glob: str) -> list[Entry]:
    """All data files that a glob names or that lie anywhere below what it names."""
    place, files = _place(spark, glob)
    return [f for found in files.globStatus(place) or [] for f in _below(spark, _entry(found))]


def _below(spark: SparkSession, entry: Entry) -> Iterator[Entry]:
    if entry.name.startswith(("_", ".")):
        return
    if not entry.folder:
        yield entry
        return
    for inner in listed(spark, entry.path):
        yield from _below(spark, inner)


def read_text(spark: SparkSession, path: str) -> str:
    place, files = _place(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_bytes(spark: SparkSession, path: str, count: int) -> bytes:
    """The beginning of a file, unpacked if its name says that it is packed."""
    place, files = _place(spark, path)
    jvm, stream = spark._jvm, files.open(place)
    try:
        codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
        codec = codecs.getCodec(place)
        plain = codec.createInputStream(stream) if codec is not None else stream
        head = jvm.org.apache.commons.io.input.BoundedInputStream(plain, count)
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(head))
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A file that must not exist yet."""
    place, files = _place(spark, path)
    stream = files.create(place, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)
