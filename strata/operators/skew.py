"""Hot keys: finding them, and joining without giving one task all of their rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.scratch import materialise

# A key with more rows than this is not left to one task.
HOT_ROWS = 5_000_000
# Largest table sent whole to every executor.
BROADCAST_BYTES = 64 << 20
# More hot keys than this are not written into a plan but stored and joined.
LISTED_KEYS = 4096
_HASH = "_hot_hash"


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _hot_table(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Hashes of the keys with at least about ``hot_rows`` rows, and about how many they have.

    There are at most as many as ``hot_rows`` goes into all rows, and none is left out.

    One pass over the key columns, counted in the map tasks first. Large thresholds are
    measured on a sample that still holds some two thousand rows of any hot key. What is
    found only chooses the path of a row, and two keys with one hash go the same way, so
    neither sampling nor a collision changes a result.
    """
    share = min(1.0, 2000 / hot_rows)
    threshold = hot_rows if share == 1.0 else hot_rows * share * 0.8
    hashed = df.select(key_hash(keys).alias(_HASH))
    if share < 1.0:
        hashed = hashed.sample(share, seed=11)
    found = hashed.groupBy(_HASH).count().filter(F.col("count") >= threshold)
    return found.select(_HASH, (F.col("count") / share).cast("bigint").alias("_rows"))


def hot_counts(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS
) -> dict[int, int]:
    """The rows of :func:`_hot_table` on the driver; for thresholds that leave few keys."""
    return {row[_HASH]: row["_rows"] for row in _hot_table(df, keys, hot_rows).collect()}


def hot_hashes(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> list[int]:
    """The hashes of :func:`hot_counts`."""
    return list(hot_counts(df, keys, hot_rows))


def _hash_text(keys: Sequence[str]) -> str:
    names = ", ".join("`" + k.replace("`", "``") + "`" for k in keys)
    return f"xxhash64({names})"


def is_hot(keys: Sequence[str], hashes: Sequence[int]) -> Column:
    """Whether a row's key is among ``hashes``; one hash set lookup per row."""
    if not hashes:
        return F.lit(False)
    # Written as SQL text: thousands of literals one by one would take seconds to pass over.
    return F.expr(f"{_hash_text(keys)} IN ({', '.join(f'{h}L' for h in hashes)})")


class HotKeys:
    """What :func:`hot_keys` found: up to ``LISTED_KEYS`` keys as a list, more as a stored table.

    A list costs a lookup per row. A table is joined, so neither the driver nor a plan holds
    keys in numbers that grow with the rows.
    """

    def __init__(self, keys: Sequence[str], listed: dict[int, int], stored: DataFrame | None):
        self.keys, self.listed, self.stored = list(keys), listed, stored

    def __bool__(self) -> bool:
        return bool(self.listed) or self.stored is not None

    @property
    def few(self) -> bool:
        return self.stored is None

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The rows of ``df`` without and with a hot key."""
        if self.few:
            hot = is_hot(self.keys, list(self.listed))
            return df.filter(~hot), df.filter(hot)
        hashes, same = self.stored.select(_HASH), self._same()
        return df.join(hashes, same, "left_anti"), df.join(hashes, same, "left_semi")

    def with_salts(self, df: DataFrame, hot_rows: int, salts: int | None = None) -> DataFrame:
        """``df`` with the number of salts of its key as ``_salts``, 1 for a key that is not hot."""
        # Numbers of salts are powers of two, so there are few of them.
        if self.few:
            groups: dict[int, list[int]] = {}
            for h, rows in self.listed.items():
                own = salts or 1 << max(1, math.ceil(math.log2(2 * rows / hot_rows)))
                groups.setdefault(own, []).append(h)
            many = F.lit(1)
            for own, hashes in groups.items():
                many = F.when(is_hot(self.keys, hashes), F.lit(own)).otherwise(many)
            return df.withColumn("_salts", many)
        power = F.greatest(F.lit(1), F.ceil(F.log2(2 * F.col("_rows") / hot_rows)))
        own = F.lit(salts) if salts else F.pow(F.lit(2), power).cast("int")
        found = df.join(self.stored.select(_HASH, own.alias("_own")), self._same(), "left")
        return found.select(*df.columns, F.coalesce("_own", F.lit(1)).alias("_salts"))

    def _same(self) -> Column:
        return F.expr(f"{_hash_text(self.keys)} = {_HASH}")


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> HotKeys:
    """The keys of ``df`` with at least about ``hot_rows`` rows, however many there are.

    Many are counted once more, to be stored.
    """
    found = _hot_table(df, keys, hot_rows)
    first = found.orderBy(F.desc("_rows"), _HASH).limit(LISTED_KEYS + 1).collect()
    if len(first) <= LISTED_KEYS:
        return HotKeys(keys, {row[_HASH]: row["_rows"] for row in first}, None)
    return HotKeys(keys, {}, materialise(found, "hot-keys"))


def row_bytes(df: DataFrame) -> Column | None:
    """Size of a row of ``df`` in memory, about; None for nested columns."""
    fixed, varying = 16 * len(df.columns), []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return None
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            varying.append(F.coalesce(F.octet_length(field.name), F.lit(0)))
    return sum(varying, F.lit(fixed)).cast("long")


def measure(df: DataFrame, keys: Sequence[str] = ()) -> tuple[int | None, int]:
    """Bytes of ``df`` as it is now (None if unknown) and rows of its most frequent key.

    One job over ``df``; without keys it moves nothing but totals, with keys rows are counted
    per key in the map tasks first. Give it only the columns that are to travel.
    """
    width = row_bytes(df)
    size = F.sum(F.lit(0) if width is None else width)
    counted = df.groupBy(*keys) if keys else df
    parts = counted.agg(F.count(F.lit(1)).alias("n"), size.alias("b"))
    total = parts.agg(F.sum("b").alias("b"), F.max("n").alias("n")).first() if keys else parts.first()
    return (None if width is None else total["b"] or 0), total["n"] or 0


def fits_broadcast(
    df: DataFrame, keys: Sequence[str], limit: int = BROADCAST_BYTES, per_key: int | None = None
) -> bool:
    """Whether ``df``, as measured now, is small enough to send to every executor.

    With ``per_key`` no key may have more rows than that either.
    """
    if limit <= 0:
        return False
    size, most = measure(df, keys if per_key is not None else ())
    return size is not None and size <= limit and (per_key is None or most <= per_key)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    hot_rows: int = HOT_ROWS,
    salts: int | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Inner or left equi-join in which the rows of a hot left key are spread over tasks.

    Rows of ``left`` with a hot key get a salt out of their own content (the same again after a
    retry); the few matching rows of ``right`` are repeated once per salt. Rows with a NULL
    key match nothing and do not travel: they are dropped or completed with NULLs in place.
    ``right`` is meant to be unique on ``keys``. Finding the hot keys reads ``left`` once more;
    ``hot`` says which they are if it is known already.
    Unless given, the number of salts follows from each key's own rows, so that no task gets
    many more than ``hot_rows`` rows of a key and no key is repeated for the sake of another.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how}")
    keys = list(keys)
    types = dict(left.dtypes)
    right = right.withColumns({k: F.col(k).cast(types[k]) for k in keys})
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(k).isNull()
    keyed = left.filter(~some_null)
    if hot is None:
        hot = hot_keys(keyed, keys, hot_rows)
    if hot:
        spread = F.xxhash64(*[F.col(c) for c in left.columns])
        keyed = hot.with_salts(keyed, hot_rows, salts)
        salt = F.when(F.col("_salts") > 1, F.pmod(spread, F.col("_salts"))).otherwise(F.lit(0))
        keyed = keyed.withColumn("_salt", salt.cast("int")).drop("_salts")
        copies = F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))
        right = hot.with_salts(right, hot_rows, salts).withColumn("_salt", copies).drop("_salts")
        joined = keyed.join(right, [*keys, "_salt"], how).drop("_salt")
    else:
        joined = keyed.join(right, keys, how)
    order = left.columns + [c for c in right.columns if c not in left.columns and c != "_salt"]
    joined = joined.select(*order)
    if how == "inner" or not any(left.schema[k].nullable for k in keys):
        return joined
    return joined.unionByName(left.filter(some_null), allowMissingColumns=True)
