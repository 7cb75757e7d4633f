"""Spelling variants: words one edit apart, found by pivotal grams.

Bigrams are put in an order, the rarest first (any order gives the same pairs, a rare one cheaply).
The first three bigrams of a word by that order and place are its prefix. Two disjoint ones of
them, the cheapest by frequency as dynamic programming finds them, are its pivots. One inserted,
deleted or replaced letter destroys at most one of two disjoint bigrams, so of two words one edit
apart, the one whose prefix ends earlier in the order has a pivot that is whole in the other and
in the prefix there.

Position limits. The edit is on one side of a whole pivot, and on the other side nothing has
changed. So pivots meet prefix bigrams at the same distance from the beginning with the same
letters before, or at the same distance from the end with the same letters behind, in words whose
lengths differ by one at most. What meets is verified by its edit distance.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import picked, prepared
from strata.operators.skew import salted_join
from strata.scratch import materialise

# Fixed value: the letters of a word.
LETTERS = r"[A-Za-zÀ-ÿ]"
SHORTEST = 6
OFTEN = 5
RATIO = 5
# Bigrams whose frequency is sent to the executors; all others count as rarer than these.
GRAMS = 1 << 16
# Prefix entries under one key that are left to one task.
HOT_ENTRIES = 20_000
_PIVOTS = 2
_PREFIX = 3  # Two letters a bigram, one edit: 2 * 1 + 1.

_Gram = tuple[int, str, int]


# --- words --------------------------------------------------------------------------------


def runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST
) -> DataFrame:
    """``key`` and run: every run of letters with at least ``shortest`` of them, A-Z lower-cased.

    Runs are maximal and repeated as often as they occur, in whole texts; a NULL or empty text
    has none. Only A-Z change: other capitals are letters of their own.
    """
    rows = picked(docs, _key=key, _text=text)
    found = F.regexp_extract_all(F.coalesce("_text", F.lit("")), F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0))
    return rows.select(F.col("_key").alias(key), F.explode(found).alias("run")).withColumn(
        "run", _small(F.col("run"))
    )


def _small(word: Column) -> Column:
    """A-Z in lower case. Where there are no other capitals, that is what lower() does."""
    small = "abcdefghijklmnopqrstuvwxyz"
    other = word.rlike("[À-Þ]")
    return F.when(other, F.translate(word, small.upper(), small)).otherwise(F.lower(word))


def counted(
    words: DataFrame, word: str = "word", shortest: int = SHORTEST, often: int = OFTEN
) -> DataFrame:
    """word and n of every word with ``shortest`` letters or more that occurs ``often`` or more."""
    rows = picked(words, word=word).filter(F.char_length("word") >= shortest)
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= often)


# --- pivots -------------------------------------------------------------------------------


def prefix_of(word: str, frequency: Mapping[str, int]) -> list[_Gram]:
    """The first bigrams in the order (frequency, bigram, place), sorted by it.

    A fourth is added if it repeats the third one place later: a whole pivot may have moved by
    one place.
    """
    pairs = [word[at : at + 2] for at in range(len(word) - 1)]
    grams = sorted((frequency.get(pair, 0), pair, at) for at, pair in enumerate(pairs))
    _, pair, at = grams[_PREFIX - 1]
    return grams[: _PREFIX + (grams[_PREFIX : _PREFIX + 1] == [(grams[_PREFIX - 1][0], pair, at + 1)])]


def pivots_of(prefix: Sequence[_Gram]) -> tuple[_Gram, ...]:
    """The disjoint bigrams of the prefix with the smallest sum of frequencies.

    ``best[k][i]`` is the cheapest choice of k disjoint ones out of the first i by place.
    """
    grams = sorted(prefix[:_PREFIX], key=lambda gram: gram[2])
    none = (float("inf"), ())
    best = [[(0, ())] * (len(grams) + 1)]
    for count in range(1, _PIVOTS + 1):
        row = [none]
        for i, gram in enumerate(grams):
            apart = sum(earlier[2] + 2 <= gram[2] for earlier in grams[:i])
            cost, chosen = best[count - 1][apart]
            row.append(min(row[i], (cost + gram[0], (*chosen, gram))))
        best.append(row)
    return best[_PIVOTS][-1][1]


_ENTRY = T.StructType(
    [
        T.StructField("frequency", T.LongType()),
        T.StructField("gram", T.StringType()),
        T.StructField("place", T.IntegerType()),
    ]
)


def _with_grams(words: DataFrame) -> DataFrame:
    """Adds _prefix and _pivots to words (word, n)."""
    spark = words.sparkSession
    prepared(spark)
    places = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = words.select(F.explode(F.transform(places, lambda p: F.substring("word", p, 2))).alias("gram"))
    counts = grams.groupBy("gram").count().orderBy(F.desc("count"), "gram").limit(GRAMS)
    frequency = spark.sparkContext.broadcast({gram: n for gram, n in counts.collect()})
    entries = T.ArrayType(_ENTRY)

    @F.arrow_udf(T.StructType([T.StructField("prefix", entries), T.StructField("pivots", entries)]))
    def chosen(words: pa.Array) -> pa.Array:
        known, found = frequency.value, []
        for word in words.to_pylist():
            prefix = prefix_of(word, known)
            found.append({"prefix": map(_named, prefix), "pivots": map(_named, pivots_of(prefix))})
        listed = [{name: list(value) for name, value in one.items()} for one in found]
        kind = pa.list_(pa.struct([("frequency", pa.int64()), ("gram", pa.string()), ("place", pa.int32())]))
        return pa.array(listed, pa.struct([("prefix", kind), ("pivots", kind)]))

    found = words.withColumn("_chosen", chosen("word"))
    return found.select(
        "word", "n", F.col("_chosen.prefix").alias("_prefix"), F.col("_chosen.pivots").alias("_pivots")
    )


def _named(gram: _Gram) -> dict:
    return dict(zip(("frequency", "gram", "place"), gram))


def _entries(words: DataFrame, grams: str, lengths: Sequence[int]) -> DataFrame:
    """Two rows per bigram and length: at its distance from the beginning and from the end."""
    one = F.col("_one")
    before = F.substring(F.col("word"), F.lit(1), one["place"])
    behind = F.substring(F.col("word"), one["place"] + 3, F.char_length("word"))
    from_end = F.char_length("word") - one["place"] - 1
    sides = F.array(
        F.struct(one["place"].alias("place"), F.xxhash64(before).alias("beside")),
        F.struct((-from_end).alias("place"), F.xxhash64(behind).alias("beside")),
    )
    rows = words.select("word", "n", "_prefix", F.explode(grams).alias("_one"))
    rows = rows.withColumns(
        {
            "_side": F.explode(sides),
            "_last": F.element_at("_prefix", _PREFIX),
        }
    )
    sizes = F.array(*[F.char_length("word") + step for step in lengths])
    return rows.select(
        one["gram"].alias("_gram"),
        F.col("_side.place").alias("_place"),
        F.col("_side.beside").alias("_beside"),
        F.explode(sizes).alias("_length"),
        "word",
        "n",
        "_last",
    )


def near_pairs(words: DataFrame, hot_entries: int = HOT_ENTRIES) -> DataFrame:
    """word, n, other, other_n: words exactly one inserted, deleted or replaced letter apart.

    ``words`` (word, n) are distinct and have five letters or more; both directions of a pair
    are given. Keys with more than ``hot_entries`` entries are spread over tasks.
    """
    stored = materialise(_with_grams(words), "spelling-grams")
    prefixes = _entries(stored, "_prefix", [0])
    pivots = _entries(stored, "_pivots", [-1, 0, 1]).select(
        "_gram", "_place", "_beside", "_length",
        F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("_last").alias("_other_last"),
    )
    met = salted_join(prefixes, pivots, ["_gram", "_place", "_beside", "_length"], "inner", hot_entries)
    verified = met.filter(
        (F.col("_other_last") <= F.col("_last"))
        & (F.col("word") != F.col("other"))
        & (F.levenshtein("word", "other", 1) == 1)
    )
    both = F.array(
        F.struct("word", "n", "other", "other_n"),
        F.struct(
            F.col("other").alias("word"),
            F.col("other_n").alias("n"),
            F.col("word").alias("other"),
            F.col("n").alias("other_n"),
        ),
    )
    # A pair may meet under several keys.
    return verified.select(F.explode(both).alias("_pair")).select("_pair.*").distinct()


# --- groups -------------------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """word and root out of word and form, by jumps that double.

    Every form occurs several times as often as its word, so chains end, after few steps.
    """
    jumps = materialise(forms.select("word", F.col("form").alias("root")), "spelling-jumps")
    while True:
        further = jumps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = jumps.join(further, "root", "left").select(
            "word",
            F.coalesce("_next", "root").alias("root"),
            F.col("_next").isNotNull().alias("_moved"),
        )
        moved = materialise(moved, "spelling-jumps")
        jumps = moved.select("word", "root")
        if moved.filter("_moved").isEmpty():
            return jumps


def variants(words: DataFrame, ratio: int = RATIO, hot_entries: int = HOT_ENTRIES) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``words`` (word, n).

    The form of a word is its near word (see :func:`near_pairs`) of largest n, of equal ones the
    smallest in code-point order, if it occurs ``ratio`` times as often or more, else NULL. The
    root is where following forms ends, the word itself if it has none. n_near is the number of
    near words, form_n the n of the form.

    ``words`` may hold other columns, which are left out; a NULL word or n, and words of fewer
    than five letters, are left out; a word that is repeated counts with the sum of its n. No
    words give no rows. Long words are compared whole.
    """
    if ratio < 2:
        raise ValueError("a form has to occur more often than its word")
    rows = picked(words, word="word", n="n").filter(F.char_length("word") >= 5)
    rows = rows.filter("n IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    stored = materialise(rows, "spelling-words")
    near = near_pairs(stored, hot_entries).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("_best"),
    )
    enough = -F.col("_best.less") >= ratio * F.col("n")
    near = near.select(
        "word",
        "n_near",
        F.when(enough, F.col("_best.other")).alias("form"),
        F.when(enough, -F.col("_best.less")).alias("form_n"),
    )
    near = materialise(near, "spelling-near")
    roots = _roots(near.filter("form IS NOT NULL"))
    return (
        stored.join(near, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )
