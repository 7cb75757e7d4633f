"""Content checks by a tree of checksums: only what differs is compared row by row.

Rows are dealt into ranges of a hash of their key. Per range every variant has a checksum that
does not depend on the order of its rows. Ranges in which all variants agree are done; those in
which they differ are cut into smaller ones, and the rows of the smallest that differ are
compared. Checksums are added up in the map tasks, so tables that are alike shuffle some
thousand numbers each and no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.compare import row_fingerprint
from strata.operators.reconcile import FAIL, PASS

# Bits of the key's hash that make a range, level by level.
LEVELS = (12, 24, 36)
# Ranges that are sent to every executor to choose the rows of; more are not cut further.
LISTED = 100_000
_WORD = (1 << 32) - 1


def _range(keys: Sequence[str], bits: int) -> Column:
    values = [part for k in keys for part in (F.col(k).cast("string"), F.col(k).isNull())]
    return F.shiftright(F.xxhash64(*values), 64 - bits)


def _checksums(columns: Sequence[str]) -> list[Column]:
    """Sums of the halves of two hashes over all values, NULL a value of its own."""
    values = [part for c in columns for part in (F.col(c).cast("string"), F.col(c).isNull())]
    halves = []
    for seed in (0, 1):
        whole = F.xxhash64(F.lit(seed), *values)
        halves += [F.shiftrightunsigned(whole, 32), whole.bitwiseAND(F.lit(_WORD))]
    return [F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(f"s{i}") for i, h in enumerate(halves)]]


def _differing(parts: Sequence[DataFrame], keys, columns, bits: int) -> list[int] | None:
    """Ranges in which the variants do not all agree; None if there are more than ``LISTED``."""
    named = [df.withColumn("_variant", F.lit(i)) for i, df in enumerate(parts)]
    sums = reduce(DataFrame.unionByName, named).groupBy(
        _range(keys, bits).alias("_range"), "_variant"
    ).agg(*_checksums(columns))
    sums = sums.select("_range", F.struct(*sums.columns[2:]).alias("_sum"))
    per_range = sums.groupBy("_range").agg(
        F.count(F.lit(1)).alias("n"), F.min("_sum").alias("low"), F.max("_sum").alias("high")
    )
    wrong = per_range.filter((F.col("n") < len(parts)) | (F.col("low") != F.col("high")))
    found = [r[0] for r in wrong.select("_range").limit(LISTED + 1).collect()]
    return None if len(found) > LISTED else found


def _within(df: DataFrame, keys, bits: int, ranges: Sequence[int], how: str) -> DataFrame:
    spark = df.sparkSession
    listed = spark.createDataFrame([(r,) for r in ranges], "_range bigint")
    rows = df.withColumn("_range", _range(keys, bits))
    return rows.join(F.broadcast(listed), "_range", how).drop("_range")


def _per_key(parts: Mapping[int, DataFrame], keys, columns, total: int | None) -> DataFrame:
    """Different contents and variants of every key; ``total`` stands for the variants if given."""
    rows = [
        df.select(*keys, row_fingerprint(columns).alias("_print"), F.lit(i).alias("_variant"))
        for i, df in parts.items()
    ]
    single = reduce(DataFrame.unionByName, rows).distinct()
    variants = F.size(F.collect_set("_variant")) if total is None else F.lit(total)
    return single.groupBy(*keys).agg(
        F.size(F.collect_set("_print")).cast("bigint").alias("distinct_hashes"),
        variants.cast("bigint").alias("variant_count"),
    )


def content_check_by_ranges(
    variants: Mapping[str, DataFrame],
    keys: Sequence[str],
    columns: Sequence[str],
    only_mismatches: bool = False,
    unique_keys: bool = False,
    levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """The rows of ``reconcile.content_check``, for any number of variants.

    A key that several rows of one variant have with different values is a mismatch too. Finding
    such keys where the variants agree takes one variant's keys through a shuffle; with
    ``unique_keys`` the caller knows that there are none, and mismatches of tables that agree
    cost their checksums only. Give stored tables: each level reads the rows that are left.
    """
    keys, columns = list(keys), list(columns)
    everything = list(dict.fromkeys([*keys, *columns]))
    parts = [df.select(*everything) for df in variants.values()]
    spark, opened, bits, ranges = parts[0].sparkSession, parts, 0, None
    for level in levels:
        found = _differing(opened, keys, everything, level)
        if found is None:
            break
        bits, ranges = level, found
        if not found:
            break
        opened = [_within(df, keys, bits, ranges, "left_semi") for df in parts]
    agreed = (F.col("distinct_hashes") == 1) & (F.col("variant_count") == len(parts))
    checked = []
    if ranges is None or ranges:
        checked.append(_per_key(dict(enumerate(opened)), keys, columns, None))
    if ranges is not None and not (only_mismatches and unique_keys):
        same = parts[0] if not ranges else _within(parts[0], keys, bits, ranges, "left_anti")
        checked.append(_per_key({0: same}, keys, columns, len(parts)))
    if not checked:
        none = parts[0].select(*keys).limit(0).schema
        fields = none.add("distinct_hashes", "long").add("variant_count", "long")
        return spark.createDataFrame([], fields.add("status", "string"))
    result = reduce(DataFrame.unionByName, checked)
    result = result.withColumn("status", F.when(agreed, PASS).otherwise(FAIL))
    return result.filter(F.col("status") == FAIL) if only_mismatches else result
