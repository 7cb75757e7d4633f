"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.skew import fits_broadcast
from strata.ship import ship_package

# Fixed value: the white space that separates words.
SPACE = r"[\x20\x09-\x0D]+"
# A group with more than one in so many of all rows is spread over several tasks. It also
# bounds the list of such groups, which is sent to every executor.
HOT_PARTS = 2000


def prepared(spark: SparkSession) -> None:
    """Ready a session for Python functions over long texts.

    The package goes to the executors, and batches of rows for Python stay small: texts may be
    long, and a batch is held several times over. Settings other than Spark's own stay.
    """
    ship_package(spark)
    for name, (usual, small) in _BATCHES.items():
        if spark.conf.get(name) == usual:
            spark.conf.set(name, small)


# Spark's own settings and those used instead.
_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8388608b"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, in a session that is ready for the operators over it."""
    prepared(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; others cannot clash with them."""
    return df.select(*[df[theirs].alias(ours) for ours, theirs in columns.items()])


def left_out(key: str | Column, parts: int) -> Column:
    """Whether a row is held out of all learning: crc32 of the key as text leaves 1.

    A NULL key is not held out.
    """
    column = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(column.cast("string")) % parts == 1, F.lit(False))


def words_of(text: Column) -> Column:
    """The words of a text; an empty array for NULL and for texts of white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def attach(
    rows: DataFrame,
    groups: DataFrame,
    key: str,
    size: str,
    spread: Sequence[str],
    total: int,
) -> DataFrame:
    """Left join of ``rows`` to ``groups`` (one row per ``key``), large groups salted.

    Groups with more than ``total / HOT_PARTS`` rows, of which there are fewer than HOT_PARTS,
    are sent to every executor as a list; their rows get a salt out of ``spread`` and the
    group's row is repeated per salt. Rows with a NULL key match nothing.
    """
    limit = max(1, total // HOT_PARTS)
    salts = F.ceil(F.col(size) / limit).cast("int")
    hot = groups.filter(F.col(size) > limit).select(key, salts.alias("_salts"))
    salt = F.pmod(F.xxhash64(*spread), F.coalesce("_salts", F.lit(1))).cast("int")
    salted = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_salts")
    many = F.when(F.col(size) > limit, salts).otherwise(1)
    repeated = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), many - 1)))
    return salted.join(repeated, [key, "_salt"], "left").drop("_salt")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _matching(docs: DataFrame, rows: DataFrame, names: dict[str, Column], how: str) -> DataFrame:
    mine = {n: fresh(docs, f"_matching_{n}") for n in names}
    other = {n: fresh(docs, f"_other_{n}") for n in names}
    left = docs.withColumns({mine[n]: c for n, c in names.items()})
    right = rows.select(*[F.col(n).alias(other[n]) for n in names])
    same = F.lit(True)
    for n in names:
        same = same & F.col(mine[n]).eqNullSafe(F.col(other[n]))
    # A short list goes to the documents; otherwise both are dealt out by it.
    if fits_broadcast(right, ()):
        right = F.broadcast(right)
    return left.join(right, same, how).select(*[docs[c] for c in docs.columns])


def without(docs: DataFrame, rows: DataFrame, names: dict[str, Column]) -> DataFrame:
    """``docs`` less those whose ``names`` (NULL-safe) are in ``rows``, columns as before.

    ``rows`` are measured first, so give stored ones.
    """
    return _matching(docs, rows, names, "left_anti")


def within(docs: DataFrame, rows: DataFrame, names: dict[str, Column]) -> DataFrame:
    """Those of ``docs`` whose ``names`` (NULL-safe) are in ``rows``, columns as before."""
    return _matching(docs, rows, names, "left_semi")
