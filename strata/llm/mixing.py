"""Mixing overlapping sources to target weights by min-cost flow.

Documents are added up by membership pattern, the set of sources they belong to. A flow routes
the words of the patterns to the quotas of the sources. The first use of a word costs nothing,
the second one unit, and so on: costs are convex, so no word is used again while another that
could take its place is unused. Per pattern the flow says how often all of its documents are
used and how many words come on top; those are taken in the order of a seeded hash, up to a
threshold that is found by sums per slice of the hash. Only patterns come to the driver; whether
a document is taken follows from its own row and its pattern's threshold.
"""

from __future__ import annotations

import json
import math
from collections import deque
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import picked
from strata.scratch import materialise

SHARE = 1.5
REPEATS = 2
SEED = 17
# Weights are given per source, so their number is a person's choice; more patterns than this
# are an error and not left out.
MAX_PATTERNS = 100_000
_SLICE_BITS = 52  # The 12 bits above are a slice.
_CYCLE = (3.0, 1.0, 2.0)

Pattern = tuple[str | None, ...]


def n_words(text: str | Column) -> Column:
    """Number of words; zero for NULL."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cycled(sources: Sequence[str | None], cycle: Sequence[float] = _CYCLE) -> dict:
    """Weights in turn, for sources in the order of their code points, NULL last."""
    ordered = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: cycle[i % len(cycle)] for i, s in enumerate(ordered)}


def targets(
    sizes: Mapping[str | None, int],
    weights: Mapping[str | None, float],
    total: float,
    limit: float = REPEATS,
) -> dict[str | None, float]:
    """``total`` shared by weight, none above ``limit`` times its size; the excess is shared again."""
    found: dict[str | None, float] = {}
    free, pool = dict(weights), float(total)
    while free:
        weight = sum(free.values())
        shares = {s: pool * w / weight if weight else 0.0 for s, w in free.items()}
        full = {s: float(limit * sizes[s]) for s, share in shares.items() if share > limit * sizes[s]}
        if not full:
            return found | shares
        found |= full
        pool -= sum(full.values())
        free = {s: w for s, w in free.items() if s not in full}
    return found


def flow(
    patterns: Mapping[Pattern, int], quotas: Mapping[str | None, int], repeats: int = REPEATS
) -> dict[tuple[Pattern, str | None], int]:
    """Words from each pattern to each source: as many as the quotas take, at least cost.

    Successive shortest paths. Costs lie on the uses of a pattern alone, so a cheapest path is
    any path that starts with the earliest use: uses are opened one after the other, and each
    is filled along shortest augmenting paths.
    """
    sent: dict[tuple[Pattern, str | None], int] = {}
    users: dict[str | None, set[Pattern]] = {}
    left = dict(quotas)
    for _ in range(repeats):
        supply = dict(patterns)
        waiting = deque(supply)
        while waiting:
            start = waiting.popleft()
            while supply[start] and (path := _path(start, left, users)):
                forward, backward = path[0::2], path[1::2]
                end = forward[-1][1]
                amount = min(supply[start], left[end], *[sent[edge] for edge in backward])
                for p, q in forward:
                    sent[p, q] = sent.get((p, q), 0) + amount
                    users.setdefault(q, set()).add(p)
                for p, q in backward:
                    sent[p, q] -= amount
                    if not sent[p, q]:
                        users[q].discard(p)
                supply[start] -= amount
                left[end] -= amount
    return {edge: amount for edge, amount in sent.items() if amount}


def _path(start: Pattern, left: Mapping, users: Mapping) -> list[tuple[Pattern, str | None]]:
    """Edges from ``start`` to a source with room, used and taken back in turn; empty if none."""
    came: dict = {}
    reached: set = set()
    queue = deque([start])
    seen = {start}
    while queue:
        pattern = queue.popleft()
        for source in pattern:
            if source in reached or source not in left:
                continue
            reached.add(source)
            came[("source", source)] = pattern
            if left[source] > 0:
                path = [(pattern, source)]
                while pattern != start:
                    back = came[("pattern", pattern)]
                    path += [(pattern, back), (came[("source", back)], back)]
                    pattern = came[("source", back)]
                return path[::-1]
            for other in users.get(source, ()):
                if other not in seen:
                    seen.add(other)
                    came[("pattern", other)] = source
                    queue.append(other)
    return []


def _pattern_of(docs: DataFrame, source: str) -> Column:
    if isinstance(docs.schema[source].dataType, T.ArrayType):
        listed = F.to_json(F.array_sort(F.array_distinct(F.col(source))))
        return F.coalesce(listed, F.lit("[null]"))
    return F.to_json(F.array(F.col(source)))


def _order_of(key: str | Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(key) if isinstance(key, str) else key)


class Mix:
    """The plan of a mix over ``docs``; see :func:`mix` and :func:`mixed`."""

    def __init__(self, docs, key, text, source, weights, share, repeats, seed):
        self.docs, self.key, self.source, self.seed = docs, key, source, seed
        rows = picked(docs, _key=key, _text=text, _source=source)
        rows = rows.select("_key", n_words("_text").alias("_size"), _pattern_of(rows, "_source").alias("_pattern"))
        self.rows = materialise(rows, "mix-sizes")
        sums = self.rows.groupBy("_pattern").agg(F.sum("_size").alias("n"))
        found = sums.limit(MAX_PATTERNS + 1).collect()
        if len(found) > MAX_PATTERNS:
            raise ValueError(f"more than {MAX_PATTERNS} combinations of sources")
        patterns = {tuple(json.loads(r["_pattern"])): r["n"] for r in found}
        self.sizes: dict[str | None, int] = {}
        for pattern, size in patterns.items():
            for s in pattern:
                self.sizes[s] = self.sizes.get(s, 0) + size
        weights = weights(list(self.sizes)) if callable(weights) else weights
        total = share * sum(patterns.values())
        self.targets = targets(self.sizes, weights, total, repeats)
        quotas = {s: math.floor(t) for s, t in self.targets.items()}
        self.sent = flow(patterns, quotas, repeats)
        amounts: dict[Pattern, int] = {}
        for (pattern, _), amount in self.sent.items():
            amounts[pattern] = amounts.get(pattern, 0) + amount
        self.plan = [
            (
                r["_pattern"],
                amounts.get(p, 0) // n if n else 0,
                amounts.get(p, 0) % n if n else 0,
            )
            for r, (p, n) in zip(found, patterns.items())
        ]

    def thresholds(self) -> DataFrame:
        """Per pattern: uses of every document, and the last place in the order used once more."""
        spark = self.docs.sparkSession
        plan = spark.createDataFrame(self.plan, "_pattern string, _whole int, _rest bigint")
        rows = self.rows.withColumn("_order", _order_of("_key", self.seed))
        rows = rows.withColumn("_slice", F.shiftright("_order", _SLICE_BITS).cast("int"))
        slices = rows.groupBy("_pattern", "_slice").agg(F.sum("_size").alias("_n"))
        running = Window.partitionBy("_pattern").orderBy("_slice")
        slices = slices.withColumn("_after", F.sum("_n").over(running))
        slices = slices.join(F.broadcast(plan), "_pattern")
        # The slice in which the words that come on top run out.
        last = slices.filter((F.col("_after") > F.col("_rest")) & (F.col("_after") - F.col("_n") <= F.col("_rest")))
        last = last.select("_pattern", "_slice", (F.col("_after") - F.col("_n")).alias("_before"), "_rest")
        inside = rows.join(F.broadcast(last), ["_pattern", "_slice"])
        within = Window.partitionBy("_pattern").orderBy("_order")
        at = F.col("_before") + F.sum("_size").over(within) - F.col("_size") / 2
        taken = inside.withColumn("_at", at).filter(F.col("_at") <= F.col("_rest"))
        ends = taken.groupBy("_pattern").agg(F.max("_order").alias("_end"))
        # Without a document of that slice, the slices before it are taken.
        first = -(1 << 63 - _SLICE_BITS)
        edge = F.when(F.col("_slice") > first, F.shiftleft(F.col("_slice").cast("long"), _SLICE_BITS) - 1)
        ends = last.join(ends, "_pattern", "left").select(
            "_pattern", F.coalesce("_end", edge).alias("_end")
        )
        return plan.join(ends, "_pattern", "left").select("_pattern", "_whole", "_end")

    def copies(self) -> Column:
        """How often a row with its pattern's threshold is used."""
        once_more = F.col("_order") <= F.col("_end")
        return F.col("_whole") + F.when(once_more, 1).otherwise(0)


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=cycled,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, size, source_size, target, taken, copies.

    ``source`` is a name or an array of names; ``weights`` maps sources to weights, or makes
    such a mapping from the list of sources. Targets share ``share`` times all words. NULL is a
    source of its own; a NULL text has no words. For a row of several sources, source_size and
    target are those of its first. Rows that repeat a key are taken together. The same rows,
    weights and seed give the same mix. An empty table gives no rows.
    """
    made = Mix(docs, key, text, source, weights, share, repeats, seed)
    spark = docs.sparkSession
    listed = []
    for pattern, _, _ in made.plan:
        first = next(iter(json.loads(pattern)), None)
        listed.append((pattern, made.sizes.get(first, 0), made.targets.get(first, 0.0)))
    facts = spark.createDataFrame(listed, "_pattern string, source_size bigint, target double")
    rows = made.rows.withColumn("_order", _order_of("_key", seed))
    rows = rows.join(F.broadcast(made.thresholds()), "_pattern").join(F.broadcast(facts), "_pattern")
    rows = rows.withColumn("copies", made.copies())
    return rows.select(
        F.col("_key").alias(key),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_size") * F.col("copies")).alias("taken"),
        "copies",
    )


def mixed(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=cycled,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """The rows of the mix, each as often as it is used, columns as they are; see :func:`mix`."""
    made = Mix(docs, key, text, source, weights, share, repeats, seed)
    marked = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
        _pattern_of(docs, source).alias("_pattern"),
        _order_of(docs[key], seed).alias("_order"),
    )
    used = marked.join(F.broadcast(made.thresholds()), "_pattern").withColumn("_n", made.copies())
    repeated = used.filter("_n > 0").withColumn("_use", F.explode(F.sequence(F.lit(1), "_n")))
    return repeated.select("_row.*")
