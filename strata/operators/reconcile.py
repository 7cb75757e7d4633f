"""Checks that tables built in different ways hold the same rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.compare import row_fingerprint

PASS, FAIL = "PASS", "FAIL"


def _verdict(passed: Column) -> Column:
    return F.when(passed, PASS).otherwise(FAIL)


def row_counts(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Rows per (variant, table), also for empty tables, in one pass and one shuffle."""
    spark = next(iter(tables.values())).sparkSession
    named = spark.createDataFrame(
        [(variant, table, 0) for variant, table in tables],
        "variant string, table_name string, one int",
    )
    ones = [
        df.select(
            F.lit(variant).alias("variant"), F.lit(table).alias("table_name"), F.lit(1).alias("one")
        )
        for (variant, table), df in tables.items()
    ]
    counted = reduce(DataFrame.unionByName, ones, named).groupBy("variant", "table_name")
    return counted.agg(F.sum("one").alias("row_count")).orderBy("table_name", "variant")


def expected_counts(spark, expected: Mapping[str, int]) -> DataFrame:
    return spark.createDataFrame(
        list(expected.items()), "table_name string, expected_rows bigint"
    )


def count_check(
    tables: Mapping[tuple[str, str], DataFrame], expected: Mapping[str, int]
) -> DataFrame:
    """Expected and actual rows per variant and table with a verdict."""
    counts = row_counts(tables)
    wanted = expected_counts(counts.sparkSession, expected)
    matches = F.col("row_count") == F.col("expected_rows")
    checked = counts.join(F.broadcast(wanted), "table_name").select(
        "table_name", "variant", "expected_rows", "row_count", _verdict(matches).alias("status")
    )
    return checked.orderBy("table_name", "variant")


def content_check(
    variants: Mapping[str, DataFrame],
    keys: Sequence[str],
    columns: Sequence[str],
    only_mismatches: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """Per key: different row contents and variants that have it; sorted by key if ``ordered``.

    A key passes when all variants have it and all agree. Which variants have a row is one
    bit each; equal rows are merged in the map tasks before each of the two shuffles, so any
    number of copies of a key is harmless.
    """
    names = list(variants)
    if len(names) > 63:
        raise ValueError("at most 63 variants at a time")
    parts = [
        variants[name].select(
            *keys,
            row_fingerprint(columns).alias("_print"),
            F.lit(1 << place).cast("bigint").alias("_bit"),
        )
        for place, name in enumerate(names)
    ]
    prints = reduce(DataFrame.unionByName, parts).groupBy(*keys, "_print")
    per_print = prints.agg(F.bit_or("_bit").alias("_bits"))
    per_key = per_print.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("distinct_hashes"),
        F.bit_count(F.bit_or("_bits")).cast("bigint").alias("variant_count"),
    )
    agreed = (F.col("distinct_hashes") == 1) & (F.col("variant_count") == len(names))
    checked = per_key.withColumn("status", _verdict(agreed))
    if only_mismatches:
        checked = checked.filter(F.col("status") == FAIL)
    return checked.orderBy(*keys) if ordered else checked


def summary(checks: DataFrame) -> DataFrame:
    """One row per table out of :func:`count_check`: variants passing, and who fails with what."""
    failing = F.when(
        F.col("status") == FAIL, F.concat_ws("=", "variant", F.col("row_count").cast("string"))
    )
    # collect_list leaves NULLs out and holds at most one short text per variant.
    per_table = checks.groupBy("table_name", "expected_rows").agg(
        F.count_if(F.col("status") == PASS).alias("variants_passing"),
        F.count(F.lit(1)).alias("total_variants"),
        F.array_join(F.array_sort(F.collect_list(failing)), ", ").alias("failing_variants"),
    )
    all_pass = F.col("variants_passing") == F.col("total_variants")
    overall = F.when(all_pass, "ALL PASS").otherwise("SOME FAIL")
    return per_table.withColumn("overall_status", overall).orderBy("table_name")
