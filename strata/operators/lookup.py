"""Bringing dimension columns to fact rows. Every fact row comes out exactly once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.clean import with_keys
from strata.operators.history import END_AT, START_AT, VALID_FROM, VALID_TO
from strata.operators.ordered import carried_forward, range_slices
from strata.operators.skew import (
    BROADCAST_BYTES,
    HOT_ROWS,
    fits_broadcast,
    hot_keys,
    salted_join,
)

# A key with more versions than this is looked up by order, not by trying all of them.
LONG_HISTORY = 64


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left lookup. ``on`` maps fact to dimension columns, ``take`` result names to dimension columns.

    A dimension measured to fit is broadcast; otherwise the join shuffles and hot keys are
    spread. Facts without a match get NULL. ``dim`` is unique on its keys.
    """
    types = dict(fact.dtypes)
    side = dim.select(
        *[F.col(d).cast(types[f]).alias(f) for f, d in on.items()],
        *[F.col(d).alias(name) for name, d in take.items()],
    )
    if fits_broadcast(side, list(on), broadcast_bytes):
        return fact.join(F.broadcast(side), list(on), "left").select(*fact.columns, *take)
    return salted_join(fact, side, list(on), "left", hot_rows)


def _validity(encoding: str) -> tuple[str, str]:
    if encoding == "closed":
        return VALID_FROM, VALID_TO
    if encoding == "half_open":
        return START_AT, END_AT
    raise ValueError(f"unknown encoding {encoding}")


def _covers(at: Column, end: Column, encoding: str) -> Column:
    """Whether a version that has started by ``at`` still holds then."""
    return at <= end if encoding == "closed" else end.isNull() | (at < end)


def _holds_at_all(encoding: str) -> Column:
    """Leaves out versions that end before they start, and so hold at no time."""
    start, end = F.col("_start"), F.col("_end")
    return start <= end if encoding == "closed" else end.isNull() | (start < end)


def lookup_scd2(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    at: str,
    take: Mapping[str, str],
    encoding: str = "closed",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left lookup of the dimension version valid at the fact's ``at``.

    A small dimension with short histories is broadcast and the version picked among those of
    the key. Otherwise facts and version starts are put in one order per key and every fact
    takes the version before it, which costs one shuffle and sort of the facts however long
    the histories are; keys beyond ``hot_rows`` are cut into slices, also within one ``at``.
    The versions of a key must not overlap; those that end before they start are left out.
    """
    start, end = _validity(encoding)
    types = dict(fact.dtypes)
    keys = list(on)
    side = dim.select(
        *[F.col(d).cast(types[f]).alias(f) for f, d in on.items()],
        F.col(start).alias("_start"),
        F.col(end).alias("_end"),
        *[F.col(d).alias(name) for name, d in take.items()],
    )
    side = with_keys(side, [*keys, "_start"]).filter(_holds_at_all(encoding))
    start_type = dict(side.dtypes)["_start"]
    if types[at] != start_type and (types[at], start_type) != ("date", "timestamp"):
        raise ValueError(f"{at} is {types[at]} but versions start at a {start_type}")
    when = F.col(at).cast(start_type)

    if fits_broadcast(side, keys, broadcast_bytes, LONG_HISTORY):
        same_key = [fact[k] == side[k] for k in keys]
        inside = (side["_start"] <= when) & _covers(when, side["_end"], encoding)
        picked = fact.join(F.broadcast(side), [*same_key, inside], "left")
        return picked.select(*[fact[c] for c in fact.columns], *[side[n] for n in take])

    missing = F.col(at).isNull()
    for k in keys:
        missing = missing | F.col(k).isNull()
    taken = {n: side.schema[n].dataType for n in take}
    no_version = {n: F.lit(None).cast(kind) for n, kind in taken.items()}

    versions = side.select(
        *keys,
        F.col("_start").alias("_at"),
        F.lit(0).alias("_kind"),
        F.struct("_end", *take).alias("_version"),
    )
    payload = [c for c in fact.columns if c not in keys]
    facts = fact.filter(~missing).select(
        *keys, when.alias("_at"), F.lit(1).alias("_kind"), F.struct(*payload).alias("_fact")
    )
    mixed = facts.unionByName(versions, allowMissingColumns=True)

    def pick(rows: DataFrame) -> DataFrame:
        found = carried_forward(rows, keys, ["_at", "_kind"], "_version", "_hit")
        holds = _covers(F.col("_at"), F.col("_hit._end"), encoding)
        hit = F.when(F.col("_hit").isNotNull() & holds, F.col("_hit"))
        return found.filter("_kind = 1").select(
            *[F.col(c) if c in keys else F.col(f"_fact.{c}") for c in fact.columns],
            *[hit[n].alias(n) for n in take],
        )

    hot = hot_keys(mixed, keys, hot_rows)
    usual, large = hot.split(mixed)
    result = pick(usual)
    if hot:
        # The last part of the order spreads the facts of one key and time over slices.
        large = large.withColumn("_spread", F.xxhash64("_fact"))
        sliced = range_slices(large, [*keys, "_at", "_kind", "_spread"])
        result = result.unionByName(pick(sliced))
    return result.unionByName(fact.filter(missing).withColumns(no_version))
