"""Verdicts on urls by a cascade of Bloom filters.

A listing holds rules (host and beginning of a path, like ``example.org/es/``) and name parts
(``casino``). What a url could be listed under are its keys: every ending of its host at a dot
together with every beginning of its path, for the sizes that occur in the listing, and the parts
of its host between dots and hyphens. The distinct keys of all urls are the universe.

A cascade answers for every key of the universe whether it is listed. Its first level is a Bloom
filter of the listed keys; the second holds the other keys that the first takes for listed, the
third the listed keys that the second takes for others, and so on until a level is wrong about
none. The first level that does not know a key tells which side it is on, so answers are exact.
The first level lets few keys through, the others half; that gives the smallest cascade.

The levels take about ``1.5 * log2(keys / listed keys) + 4`` bits a listed key. They are sent to
every executor, and urls are judged where they are: no join. Beyond ``CASCADE_BYTES`` the keys
are dealt by hash into parts with a cascade each, and the urls pass one part after the other.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import prepared
from strata.scratch import materialise

# Bytes of a cascade that are sent to every executor at a time.
CASCADE_BYTES = 32 << 20
# Levels are wrong about half of what they are asked; so many would need the same two hashes.
LEVELS = 200
VERDICTS = ("allow", "block")
_BUCKET_BITS = 32_768  # Fixed value: bits in one bitmap of bitmap_construct_agg.


class Level(NamedTuple):
    """A Bloom filter: hashes per key, number of bits, and the bits."""

    hashes: int
    size: int
    bits: np.ndarray


# --- filters ------------------------------------------------------------------------------


def _places(h1: np.ndarray, h2: np.ndarray, salt: int, size: int) -> np.ndarray:
    """A place out of ``size`` per key, another one for every salt."""
    step = np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
    mixed = (h1 + step) ^ (h2 * (step | np.uint64(1)))
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (mixed ^ (mixed >> np.uint64(31))) % np.uint64(size)


def _salt(level: int, number: int) -> int:
    return 1 + level * 64 + number


def _known(h1: np.ndarray, h2: np.ndarray, level: int, one: Level) -> np.ndarray:
    found = np.ones(len(h1), dtype=bool)
    for number in range(one.hashes):
        at = _places(h1, h2, _salt(level, number), one.size)
        found &= (one.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def listed(h1: np.ndarray, h2: np.ndarray, cascade: Sequence[Level]) -> np.ndarray:
    """Whether each key, given by its two hashes, is listed; exact for keys of the universe."""
    depth = np.zeros(len(h1), dtype=np.int64)
    going = np.arange(len(h1))
    for level, one in enumerate(cascade):
        going = going[_known(h1[going], h2[going], level, one)]
        if not len(going):
            break
        depth[going] = level + 1
    return depth % 2 == 1


def _numbers(hashes: pa.Array) -> np.ndarray:
    return hashes.to_numpy(zero_copy_only=False).view(np.uint64)


def _encoded(members: DataFrame, count: int, wrong: float, level: int) -> Level:
    """The filter of ``members``; one aggregate whose rows are pieces of the filter."""
    hashes = max(1, round(-math.log2(wrong)))
    size = max(64, math.ceil(count * hashes / math.log(2)))

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def places(h1: pa.Array, h2: pa.Array) -> pa.Array:
        first, second = _numbers(h1), _numbers(h2)
        each = [_places(first, second, _salt(level, n), size) for n in range(hashes)]
        flat = np.stack(each, axis=1).astype(np.int64).ravel()
        offsets = np.arange(0, len(flat) + 1, hashes, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat + 1))

    at = members.select(F.explode(places("_h1", "_h2")).alias("_at"))
    pieces = at.groupBy(F.bitmap_bucket_number("_at").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_bits")
    )
    bits = np.zeros(-(-size // _BUCKET_BITS) * _BUCKET_BITS // 8, dtype=np.uint8)
    for bucket, piece in pieces.toLocalIterator():
        start = (bucket - 1) * _BUCKET_BITS // 8
        bits[start : start + len(piece)] = np.frombuffer(piece, dtype=np.uint8)
    return Level(hashes, size, bits[: -(-size // 8)])


def build_cascade(keys: DataFrame) -> list[Level]:
    """The cascade of the keys with ``_listed`` among all ``keys`` (_h1, _h2, _listed).

    Each level is built on Spark from what the level before is wrong about. Nothing listed
    gives no levels.
    """
    spark = keys.sparkSession
    members, others = keys.filter("_listed"), keys.filter("NOT _listed")
    count, rest = members.count(), others.count()
    wrong = min(0.5, max(2.0**-40, count / (math.sqrt(2) * max(rest, 1))))
    cascade: list[Level] = []
    while count:
        level = len(cascade)
        if level == LEVELS:
            raise ValueError("two keys have the same hashes and cannot be told apart")
        one = _encoded(members, count, wrong, level)
        cascade.append(one)
        shared = spark.sparkContext.broadcast(one)

        @F.arrow_udf(T.BooleanType())
        def taken(h1: pa.Array, h2: pa.Array) -> pa.Array:
            return pa.array(_known(_numbers(h1), _numbers(h2), level, shared.value))

        mistaken = materialise(others.filter(taken("_h1", "_h2")), "cascade-mistaken")
        members, others, count, wrong = mistaken, members, mistaken.count(), 0.5
    return cascade


def _expected_bytes(count: int, universe: int) -> int:
    return math.ceil(count * (1.5 * math.log2(max(universe, 2) / max(count, 1)) + 4) / 8)


# --- keys of urls -------------------------------------------------------------------------


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for NULL and without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    small = "abcdefghijklmnopqrstuvwxyz"
    return (
        F.translate(F.regexp_extract(text, pattern, 1), small.upper(), small),
        F.regexp_extract(text, pattern, 2),
    )


def _rule_keys(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """What rules of these shapes (labels of the host, length of the path) could fit."""
    labels = F.split(host, r"\.")
    keys = [
        F.when(
            (F.size(labels) >= names) & (F.char_length(path) >= size),
            F.concat(
                F.array_join(F.slice(labels, -names, names), "."), F.substring(path, 1, size)
            ),
        )
        for names, size in shapes
    ]
    # The longest first, and of equally long ones the smallest.
    ranked = [F.when(k.isNotNull(), F.struct(-F.char_length(k), k.alias("k"))) for k in keys]
    kept = F.array_sort(F.array_distinct(F.array_compact(F.array(*ranked))))
    return F.transform(kept, lambda one: one["k"])


def _no_strings() -> Column:
    return F.array().cast("array<string>")


def _entries(listing: DataFrame) -> DataFrame:
    """Distinct entries; one with both verdicts blocks."""
    known = F.col("verdict").isin(*VERDICTS)
    checked = F.when(known, F.col("verdict")).otherwise(
        F.raise_error(F.concat(F.lit("no such verdict: "), F.coalesce("verdict", F.lit("NULL"))))
    )
    rows = listing.filter("entry IS NOT NULL").select(
        F.col("entry").alias("_key"), checked.alias("_verdict")
    )
    return rows.groupBy("_key").agg(F.max("_verdict").alias("_verdict"))


def _shapes(entries: DataFrame) -> list[tuple[int, int]]:
    """Sizes of the rules: labels of the host and length of the path; few, whatever the listing."""
    host = F.substring_index("_key", "/", 1)
    sizes = entries.filter(F.col("_key").contains("/")).select(
        F.size(F.split(host, r"\.")).alias("names"),
        (F.char_length("_key") - F.char_length(host)).alias("size"),
    )
    return sorted((r["names"], r["size"]) for r in sizes.distinct().collect())


def judged(
    pages: DataFrame, listing: DataFrame, url: str = "url", limit: int = CASCADE_BYTES
) -> DataFrame:
    """One row per row of ``pages``: ``row`` (all its columns as a struct), host, path, rule,
    listed (name parts of the host that are listed to block), verdict.

    ``listing`` has the columns entry and verdict (allow or block). An entry with a slash is a
    rule; it fits its host and all subdomains where the path begins as the rule's. Of the rules
    that fit the longest decides, of equally long ones the smallest. Without a rule a url is
    blocked if a part of its host (between dots and hyphens) is listed to block, and allowed
    otherwise, so an allowed part has no effect.

    A NULL, an empty url and one without ``://`` have an empty host and path; no rule with a
    path fits them, and they are allowed. Long urls and hosts are taken whole. Repeated rows are
    judged alike, each for itself; columns of ``pages`` keep any name, for they stay inside
    ``row``. Empty tables give no rows, and an empty listing allows everything. Entries that are
    NULL are left out, repeated ones count once, one listed with both verdicts blocks, and
    another verdict stops the job. Rules are compared as they are written, hosts in lower case.
    """
    spark = pages.sparkSession
    prepared(spark)
    entries = materialise(_entries(listing), "cascade-entries")
    shapes = _shapes(entries)
    host, path = host_and_path(pages[url])
    rows = pages.select(
        F.struct(*[pages[c] for c in pages.columns]).alias("row"),
        host.alias("host"),
        path.alias("path"),
    )
    rules = _rule_keys(F.col("host"), F.col("path"), shapes) if shapes else _no_strings()
    parts = F.array_distinct(
        F.filter(F.split(F.col("host"), "[.-]"), lambda part: part != "")
    )
    rows = rows.withColumns({"_rules": rules, "_parts": parts})
    keys = F.concat("_rules", "_parts")
    cascades = _cascades(rows.select(F.explode(keys).alias("_key")), entries, limit)
    hashed = rows.withColumns(
        {
            "_h1": F.transform(keys, lambda k: F.xxhash64(k)),
            "_h2": F.transform(keys, lambda k: F.xxhash64(k, F.lit(1))),
            "_marks": F.transform(keys, lambda k: F.lit(0).cast("tinyint")),
        }
    )
    for part, pair in enumerate(cascades):
        if part:
            # One part's cascades at a time are on the executors.
            hashed = materialise(hashed, "cascade-marks")
        hashed = hashed.withColumn("_marks", _marker(spark, pair, part, len(cascades))(
            "_h1", "_h2", "_marks"
        ))
    return _verdicts(hashed)


def _cascades(
    keys: DataFrame, entries: DataFrame, limit: int
) -> list[tuple[list[Level], list[Level]]]:
    """A cascade per verdict, for each part of the keys."""
    seen = keys.select("_key", F.lit(None).cast("string").alias("_verdict"), F.lit(1).alias("_n"))
    both = seen.unionByName(entries.withColumn("_n", F.lit(0)))
    # Entries that are no key of any url drop out: they could fit nothing.
    universe = both.groupBy("_key").agg(
        F.max("_verdict").alias("_verdict"), F.max("_n").alias("_n")
    )
    universe = materialise(
        universe.filter("_n = 1").select(
            F.xxhash64("_key").alias("_h1"), F.xxhash64("_key", F.lit(1)).alias("_h2"), "_verdict"
        ),
        "cascade-universe",
    )
    total, found = universe.agg(F.count(F.lit(1)), F.count("_verdict")).first()
    count = max(1, math.ceil(_expected_bytes(found, total) / limit)) if found else 0
    done = []
    for part in range(count):
        own = universe.filter(F.pmod("_h2", F.lit(count)) == part) if count > 1 else universe
        done.append(
            tuple(
                build_cascade(
                    own.select(
                        "_h1", "_h2", F.col("_verdict").eqNullSafe(verdict).alias("_listed")
                    )
                )
                for verdict in VERDICTS
            )
        )
    return done


def _marker(spark: SparkSession, pair: tuple, part: int, parts: int):
    """Marks per key: 0 not listed, 1 listed to allow, 2 to block; other parts' keys stay."""
    shared = spark.sparkContext.broadcast(pair)

    @F.arrow_udf(T.ArrayType(T.ByteType()))
    def marked(h1: pa.Array, h2: pa.Array, marks: pa.Array) -> pa.Array:
        first, second = _numbers(h1.flatten()), _numbers(h2.flatten())
        found = np.array(marks.flatten().to_numpy(zero_copy_only=False))
        own = np.flatnonzero(second.view(np.int64) % parts == part)
        for value, cascade in enumerate(shared.value, start=1):
            found[own[listed(first[own], second[own], cascade)]] = value
        lengths = np.concatenate([[0], np.cumsum(marks.value_lengths().to_numpy())])
        return pa.ListArray.from_arrays(
            pa.array(lengths.astype(np.int32)), pa.array(found.astype(np.int8))
        )

    return marked


def _verdicts(marked: DataFrame) -> DataFrame:
    count = F.size("_rules")
    rules = F.filter(
        F.arrays_zip("_rules", F.slice("_marks", F.lit(1), count).alias("_marks")),
        lambda one: one["_marks"] > 0,
    )
    parts = F.filter(
        F.arrays_zip("_parts", F.slice("_marks", count + 1, F.size("_parts")).alias("_marks")),
        lambda one: one["_marks"] == 2,
    )
    first = F.get("_fit", F.lit(0))
    blocks = F.when(first.isNotNull(), first["_marks"] == 2).otherwise(F.size("listed") > 0)
    fitted = marked.withColumns(
        {"_fit": rules, "listed": F.transform(parts, lambda one: one["_parts"])}
    )
    return fitted.select(
        "row",
        "host",
        "path",
        first["_rules"].alias("rule"),
        "listed",
        F.when(blocks, F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
    )


def allowed(
    pages: DataFrame, listing: DataFrame, url: str = "url", limit: int = CASCADE_BYTES
) -> DataFrame:
    """Rows of ``pages`` whose url is allowed, columns as they are; see :func:`judged`."""
    found = judged(pages, listing, url, limit).filter("verdict = 'allow'")
    return found.select("row.*")


# --- the listing of the query -------------------------------------------------------------

# Rules and their verdicts.
RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]
# Parts of host names that stand for adverts, betting, drugs, pornography, spam.
PARTS = [
    "adult", "ads", "adserver", "banner", "bet", "bets", "betting", "casino", "doubleclick",
    "escort", "gambling", "loan", "loans", "lottery", "malware", "payday", "phishing", "pill",
    "pills", "poker", "popup", "porn", "replica", "sex", "slots", "spam", "spyware", "torrent",
    "tracker", "tracking", "viagra", "warez", "xxx",
]


def default_listing(spark: SparkSession) -> DataFrame:
    """The rules above, and the parts above to block."""
    rows = [*RULES, *[(part, "block") for part in PARTS]]
    return spark.createDataFrame(rows, "entry string, verdict string")
