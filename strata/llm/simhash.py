"""Near-duplicates by SimHash fingerprints and tables of distances to pivots.

Fingerprints at ``bits`` or fewer differing bits (3) are linked, and documents of linked
fingerprints are one group, however long the chain.

Candidates. The 64 bits are cut into six blocks. Two linked fingerprints differ in at most three
of them, so they agree on the rest: each distinct fingerprint goes to 20 buckets, one for every
choice of three blocks that may differ. A bucket with more than ``BUCKET`` fingerprints is cut in
the same way over the bits it leaves open (32, then 16, then 8); a bucket that leaves eight bits
open has at most 256 fingerprints. So no bucket is large and no pair is lost.

Pivots. Each fingerprint brings its Hamming distances to reference fingerprints along. By the
triangle inequality two linked ones differ by at most 3 in each coordinate; pairs that differ
more in any are discarded, the survivors are verified bit by bit. A bucket gives the edges of a
spanning forest of what it verified, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import attach, fresh, picked, prepared, without
from strata.scratch import materialise

BITS = 3
BUCKET = 256
PIVOTS = 16
_SEED = 42  # Fixed value: seed of the shingle hashes.
_BLOCKS = 6
_DEPTH = 3
_PIECE = 1 << 16
_ALL = (1 << 64) - 1


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of a text as an unsigned number; zero for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    ones, total = np.zeros(64, dtype=np.int64), len(words) - size + 1
    for at in range(0, total, _PIECE):
        runs = zip(*[words[at + k : min(at + _PIECE, total) + k] for k in range(size)])
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(run), _SEED) for run in runs), dtype="<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _printer():
    """The function of a column; made for each use, since it keeps what the session ships then."""

    @F.pandas_udf(T.LongType())
    def print_of(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint(t) for t in texts], dtype=np.uint64)
        return pd.Series(found.view(np.int64))

    return print_of


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """_key and _print (the fingerprint as a signed 64-bit number) of every row."""
    prepared(docs.sparkSession)
    rows = picked(docs, _key=key, _text=text)
    return rows.select("_key", _printer()("_text").alias("_print"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def masks(free: int) -> list[int]:
    """The choices of half of the bits in ``free`` that may differ, by blocks."""
    places = [i for i in range(64) if free >> i & 1]
    cuts = [round(len(places) * k / _BLOCKS) for k in range(_BLOCKS + 1)]
    blocks = [sum(1 << p for p in places[a:b]) for a, b in zip(cuts, cuts[1:])]
    return [_signed(reduce(int.__or__, three)) for three in combinations(blocks, 3)]


def pivots(count: int = PIVOTS, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, count, dtype=np.uint64)


def distances(prints: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Table of Hamming distances, a row per fingerprint and a column per reference."""
    return np.bitwise_count(prints[:, None] ^ references[None, :]).astype(np.int8)


def _with_distances(prints: DataFrame, references: np.ndarray) -> DataFrame:
    def table(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = distances(batch["_print"].to_numpy().view(np.uint64), references)
            batch["_far"] = [row.tobytes() for row in found]
            yield batch

    return prints.mapInPandas(table, "_print bigint, _far binary")


def _forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the given pairs of positions."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := above.get(x, x)) != x:
            above[x] = above.get(y, y)
            x = y
        return x

    chosen = []
    for a, b in pairs.tolist():
        x, y = top(a), top(b)
        if x != y:
            above[max(x, y)] = min(x, y)
            chosen.append((a, b))
    return chosen


def links_in_order(buckets: np.ndarray, prints: np.ndarray, far: np.ndarray, bits: int = BITS):
    """Positions of the linked pairs within equal, neighbouring ``buckets``, as a forest."""
    found, lag = [], 1
    near = np.arange(len(prints))
    while True:
        near = near[near + lag < len(prints)]
        near = near[buckets[near] == buckets[near + lag]]
        if not len(near):
            break
        apart = np.abs(far[near] - far[near + lag]).max(axis=1)  # coordinate by coordinate
        left = near[apart <= bits]
        left = left[np.bitwise_count(prints[left] ^ prints[left + lag]) <= bits]
        found.append(np.stack([left, left + lag], axis=1))
        lag += 1
    return _forest(np.concatenate(found)) if found else []


def _bucket_links(batches: Iterator[pd.DataFrame], bits: int) -> Iterator[pd.DataFrame]:
    """Links of buckets that arrive one after the other; the last one waits for its rest."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        last = (rows["_mask"] == rows["_mask"].iat[-1]) & (rows["_value"] == rows["_value"].iat[-1])
        rest = rows[last]
        yield _links(rows[~last], bits)
    if rest is not None:
        yield _links(rest, bits)


def _links(rows: pd.DataFrame, bits: int) -> pd.DataFrame:
    prints = rows["_print"].to_numpy(dtype=np.int64)
    if len(prints) < 2:
        return pd.DataFrame({"_a": prints[:0], "_b": prints[:0]})
    names = rows[["_mask", "_value"]].to_numpy(dtype=np.int64)
    buckets = np.concatenate([[0], np.cumsum((names[1:] != names[:-1]).any(axis=1))])
    far = np.frombuffer(b"".join(rows["_far"]), dtype=np.int8).reshape(len(rows), -1)
    pairs = links_in_order(buckets, prints.view(np.uint64), far, bits)
    a, b = (np.array([p[k] for p in pairs], dtype=np.int64) for k in (0, 1))
    return pd.DataFrame({"_a": prints[a], "_b": prints[b]})


def link_fingerprints(
    prints: DataFrame, bits: int = BITS, bucket: int = BUCKET, pivot_count: int = PIVOTS
) -> DataFrame:
    """Edges (_a, _b) that connect what linked pairs of the distinct ``_print`` connect."""
    if bits > 3:
        raise ValueError("the blocks find pairs of up to three differing bits")
    rows = _with_distances(prints.select("_print"), pivots(pivot_count))
    rows = rows.withColumn("_mask", F.explode(F.array(*[F.lit(m) for m in masks(_ALL)])))
    edges = None
    for depth in range(_DEPTH):
        value = F.col("_print").bitwiseAND(F.bitwise_not(F.col("_mask")))
        rows = rows.withColumn("_value", value)
        sizes = rows.groupBy("_mask", "_value").agg(F.count(F.lit(1)).alias("_n"))
        shared = rows.join(sizes.filter("_n > 1"), ["_mask", "_value"])
        shared = materialise(shared, "simhash-buckets")
        last = depth == _DEPTH - 1
        fit = shared if last else shared.filter(F.col("_n") <= bucket)
        ordered = fit.drop("_n").repartition("_mask", "_value")
        ordered = ordered.sortWithinPartitions("_mask", "_value", "_print")
        found = ordered.mapInPandas(
            lambda batches: _bucket_links(batches, bits), "_a bigint, _b bigint"
        )
        edges = found if edges is None else edges.unionByName(found)
        rows = shared.filter(F.col("_n") > bucket).select("_print", "_far", "_mask")
        if last or rows.isEmpty():
            break
        rows = _cut(rows)
    return edges.distinct()


def _cut(rows: DataFrame) -> DataFrame:
    """Each row once for every finer choice of the bits that may differ."""

    def finer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, list[int]] = {}
        for batch in batches:
            for m in batch["_mask"].unique():
                known.setdefault(m, masks(int(m) & _ALL))
            batch["_mask"] = [known[m] for m in batch["_mask"]]
            yield batch.explode("_mask", ignore_index=True).astype({"_mask": "int64"})

    return rows.mapInPandas(finer, "_print bigint, _far binary, _mask bigint")


def components(edges: DataFrame) -> DataFrame:
    """(_node, _root): the smallest node that each node of ``edges`` (_a, _b) is connected with.

    Large-star and small-star steps in turn: every node's neighbours are hung below the
    smallest of them until nothing changes. Each round is written, so that a lost executor
    costs a re-read.
    """
    pairs = materialise(_ordered(edges), "components")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
        least = both.groupBy("_a").agg(F.min("_b").alias("_least"))
        least = least.withColumn("_least", F.least("_a", "_least"))
        large = both.join(least, "_a").filter("_b > _a")
        pairs = _ordered(large.select(F.col("_least").alias("_a"), "_b"))
        # Small star: a pair (a, b) has a < b, so the smaller neighbours of b are its a's.
        least = pairs.groupBy("_b").agg(F.min("_a").alias("_least"))
        small = pairs.join(least, "_b").select(F.col("_least"), F.col("_a"))
        small = small.select(F.col("_least").alias("_a"), F.col("_a").alias("_b"))
        own = least.select(F.col("_least").alias("_a"), "_b")
        pairs = materialise(_ordered(small.unionByName(own)), "components")
        state = pairs.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("_a", "_b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    roots = pairs.select(F.col("_b").alias("_node"), F.col("_a").alias("_root"))
    own = pairs.select(F.col("_a").alias("_node"), F.col("_a").alias("_root")).distinct()
    return roots.unionByName(own)


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b")
    ).filter("_a < _b").distinct()


def near_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    bits: int = BITS,
    bucket: int = BUCKET,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, fingerprint, component_id, group_size.

    component_id is the smallest key reachable over links, the own one included. NULL, empty
    and white-space texts have fingerprint zero and are linked like any other. NULL keys take
    part but are nobody's smallest key, unless a group has no other. No documents, no rows.
    """
    prints = materialise(fingerprints(docs, key, text), "simhash-prints")
    distinct = prints.groupBy("_print").agg(
        F.min("_key").alias("_least"), F.count(F.lit(1)).alias("_copies")
    )
    distinct = materialise(distinct, "simhash-distinct")
    roots = components(link_fingerprints(distinct, bits, bucket))
    placed = distinct.join(roots, F.col("_print") == F.col("_node"), "left")
    placed = placed.withColumn("_root", F.coalesce("_root", "_print"))
    groups = placed.groupBy("_root").agg(
        F.min("_least").alias("component_id"), F.sum("_copies").alias("group_size")
    )
    total = prints.count()
    named = attach(placed.drop("_node", "_least"), groups, "_root", "group_size", ["_print"], total)
    named = named.select("_print", "_copies", "component_id", "group_size")
    result = attach(prints, named, "_print", "_copies", ["_key"], total)
    return result.select(
        F.col("_key").alias(key),
        F.lpad(F.lower(F.hex("_print")), 16, "0").alias("fingerprint"),
        "component_id",
        F.col("group_size").cast("long").alias("group_size"),
    )


def near_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group, that with the smallest key; columns as they are.

    Where keys repeat or are NULL, rows are told apart by key and fingerprint, and one row stays
    of those that repeat both. NULL and empty texts are near each other, long texts are taken
    whole, an empty table stays empty, and columns may have any name.
    """
    prepared(docs.sparkSession)
    groups = materialise(near_groups(docs, key, text), "near-groups")
    dropped = groups.filter(~F.col(key).eqNullSafe(F.col("component_id")))
    unsure = groups.groupBy(key).count().filter(F.col(key).isNull() | (F.col("count") > 1))
    if unsure.isEmpty():
        return without(docs, dropped.select(key), {key: F.col(key)})
    names = {key: F.col(key), "fingerprint": F.lpad(F.lower(F.hex(_printer()(text))), 16, "0")}
    kept = without(docs, dropped.select(*names), names)
    mark = fresh(docs, "_near_mark")
    once = kept.withColumn(mark, names["fingerprint"]).dropDuplicates([key, mark])
    return once.select(*docs.columns)
