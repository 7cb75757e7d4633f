"""Expectations on rows and declared tests on tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.operators.clean import with_keys

REPORT = "table_name string, test string, column_name string, failures bigint"


def _holds(rule: Column) -> Column:
    """A rule that cannot be decided is not met."""
    return F.coalesce(rule, F.lit(False))


def expect_or_drop(
    df: DataFrame, rules: Mapping[str, Column], name: str | None = None
) -> tuple[DataFrame, Observation]:
    """Rows that meet every rule, and the counts of all rows and of violations per rule.

    Rules see the columns of ``df``, that is values after casting. The counts are taken while
    the rows are written; read them from the observation afterwards.
    """
    seen = Observation(name) if name else Observation()
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count_if(~_holds(rule)).alias(label) for label, rule in rules.items()]
    kept = df.observe(seen, *counts)
    for rule in rules.values():
        kept = kept.filter(_holds(rule))
    return kept, seen


def expectation_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule: rows seen, kept and dropped by it."""
    totals = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(~_holds(rule)).alias(label) for label, rule in rules.items()],
    )
    per_rule = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.col(r).alias("dropped")) for r in rules]
    )
    return totals.select(F.col("n").alias("rows_seen"), F.inline(per_rule)).select(
        "rule", "rows_seen", (F.col("rows_seen") - F.col("dropped")).alias("rows_kept"), "dropped"
    )


def flag_rejects(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Adds ``failed_rules``: the names of the rules a row breaks, in the order given."""
    broken = [F.when(~_holds(rule), F.lit(label)) for label, rule in rules.items()]
    return df.withColumn("failed_rules", F.array_compact(F.array(*broken)))


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the others with the names of the rules they break."""
    flagged = flag_rejects(df, rules)
    clean = F.size("failed_rules") == 0
    return flagged.filter(clean).drop("failed_rules"), flagged.filter(~clean)


# --- declared tests: each gives rows of REPORT --------------------------------------------


def column_tests(
    df: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """All not-NULL and accepted-value tests of a table in a single aggregate.

    NULL is not an unaccepted value; test for it apart.
    """
    tests = [("not_null", c, F.count_if(F.col(c).isNull())) for c in not_null]
    for c, values in (accepted or {}).items():
        tests.append(("accepted_values", c, F.count_if(~F.col(c).isin(*values))))
    totals = df.agg(*[count.alias(f"t{i}") for i, (_, _, count) in enumerate(tests)])
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(test).alias("test"),
                F.lit(column).alias("column_name"),
                F.col(f"t{i}").alias("failures"),
            )
            for i, (test, column, _) in enumerate(tests)
        ]
    )
    return totals.select(F.inline(rows))


def _report(counts: DataFrame, table: str, test: str, column: str, failures: Column) -> DataFrame:
    return counts.agg(F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit(table).alias("table_name"),
        F.lit(test).alias("test"),
        F.lit(column).alias("column_name"),
        "failures",
    )


def unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """How many key values occur more than once; NULL keys are not counted."""
    repeated = with_keys(df, keys).groupBy(*keys).count().filter("count > 1")
    return _report(repeated, table, "unique", ", ".join(keys), F.count(F.lit(1)))


def relationships(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """How many child rows name a parent that does not exist; NULL names none.

    Child rows are counted per value before the join, so a hot value crosses it as one row.
    """
    values = with_keys(child, [column]).groupBy(F.col(column).alias("k")).count()
    known = parent.select(F.col(parent_column).alias("k"))
    orphans = values.join(known, "k", "left_anti")
    return _report(orphans, table, "relationships", column, F.sum("count"))


def report(*tests: DataFrame) -> DataFrame:
    """Reports of several tests as one, with a status."""
    rows = tests[0]
    for more in tests[1:]:
        rows = rows.unionByName(more)
    status = F.when(F.col("failures") == 0, "PASS").otherwise("FAIL")
    return rows.withColumn("status", status)
