"""Line-first cleaning: rules per line, then a verdict on what is left of the document.

Only DataFrame functions. Lines that fail a rule are removed: lines of symbols, of separators or
without the punctuation of prose, navigation, shouting and boilerplate. Documents that lose more
than ``most_lost`` of their words to that are rejected, and so are those that fail the base rules
(too few words, or half of them in repeated windows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, picked, words_of

LEAST_WORDS = 50
MOST_REPEATED = 50  # Percent of the words.
MOST_LOST = 0.4
WINDOW = 3
_PLACE_BITS = 21
_PLACES = 1 << _PLACE_BITS

# --- fixed values: characters counted as symbols, marks of navigation and boilerplate ---------

SYMBOLS = "#*$%&|<>"
WORD = r"[^\x20\x09-\x0D]+"
BOILERPLATE = (
    r"(?i)(all rights reserved|copyright \(c\)|©|terms of (use|service)|privacy policy"
    r"|cookie policy|we use cookies|accept (all )?cookies|subscribe to our|sign up for our"
    r"|click here|javascript (is|must be) (disabled|enabled)|powered by|lorem ipsum"
    r"|licen[sc]ed under|released under the|is licensed|permission is hereby granted"
    r"|without warrant(y|ies) of any kind)"
)
NAVIGATION = (
    r"(?i)^\W*(home|menu|skip to content|log ?in|sign ?in|sign ?up|register|next( page)?"
    r"|previous( page)?|back to top|read more|share( this)?|tweet|print|contact( us)?|about( us)?"
    r"|search|site ?map|faq|help)\W*$"
)

# ------------------------------------------------------------------------------------------------


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def _symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, SYMBOLS, ""))


def _covered(order: Column, same, place) -> Column:
    """Words covered by windows that are next to an equal one in ``order``."""

    def twice(window: Column, k: Column) -> Column:
        neighbours = [same(window, F.get(order, k - 1)), same(window, F.get(order, k + 1))]
        return F.coalesce(neighbours[0], F.lit(False)) | F.coalesce(neighbours[1], F.lit(False))

    places = F.transform(
        F.filter(order, twice), lambda w: F.sequence(place(w), place(w) + WINDOW - 1)
    )
    return F.size(F.array_distinct(F.flatten(places)))


def _by_pairs(pairs: Column) -> Column:
    """Words in repeated windows among pairs of a window's hash and place."""
    return _let(
        F.array_sort(pairs),
        lambda order: _covered(order, lambda a, b: a["h"] == b["h"], lambda w: w["i"]),
    )


def _pairs(hashes: Column) -> Column:
    return F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i")))


def _by_packed(hashes: Column) -> Column:
    """Windows as one number each, upper bits of the hash and place, which sort fast.

    Windows without another of the same upper bits are out; the others, few in most texts, are
    compared by their whole hashes.
    """
    packed = F.transform(hashes, lambda h, i: h.bitwiseAND(F.lit(-_PLACES)).bitwiseOR(i.cast("long")))

    def near(a: Column, b: Column) -> Column:
        same = F.shiftright(a.bitwiseXOR(b), _PLACE_BITS) == 0
        return F.coalesce(same, F.lit(False))

    def whole(w: Column) -> Column:
        place = w.bitwiseAND(F.lit(_PLACES - 1))
        return F.struct(F.get(hashes, place.cast("int")).alias("h"), place.alias("i"))

    def candidates(order: Column) -> Column:
        some = F.filter(
            order, lambda w, k: near(w, F.get(order, k - 1)) | near(w, F.get(order, k + 1))
        )
        return F.transform(some, whole)

    return _by_pairs(_let(F.array_sort(packed), candidates))


def n_repeated_words(words: Column) -> Column:
    """Words in windows that are found twice or more in a document, the first find included.

    Windows are compared by 64-bit hashes. Documents without a repeated window, which are most, need
    no sort.
    """
    starts = F.sequence(F.lit(1), F.size(words) - WINDOW + 1)

    def window(at: Column) -> Column:
        return F.xxhash64(*[F.element_at(words, at + k) for k in range(WINDOW)])

    def repeated(hashes: Column) -> Column:
        none = F.size(F.array_distinct(hashes)) == F.size(hashes)
        few = F.size(hashes) < _PLACES
        return F.when(none, 0).when(few, _by_packed(hashes)).otherwise(_by_pairs(_pairs(hashes)))

    hashes = F.transform(starts, window)
    return F.when(F.size(words) < WINDOW, 0).otherwise(_let(hashes, repeated)).cast("long")


def line_passes(line: Column) -> Column:
    """Whether a line looks like prose. Lines without words pass and carry nothing."""
    words = F.regexp_count(line, F.lit(WORD))
    symbols = 10 * _symbols(line) > words
    shouting = (line == F.upper(line)) & (line != F.lower(line)) & (words >= 3)
    unpunctuated = ~F.rlike(line, F.lit(r"[.,;:!?…。、！？]")) & (words >= 12)
    # Only lines of a heading's or a notice's length are navigation or boilerplate.
    navigation = (F.length(line) < 60) & F.rlike(line, F.lit(NAVIGATION))
    boilerplate = (F.length(line) < 300) & F.rlike(line, F.lit(BOILERPLATE))
    fails = navigation | boilerplate | shouting | unpunctuated | symbols
    return ~fails


def line_first(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    most_lost: float = MOST_LOST,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, counts of the base rules, verdict, cleaned text.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed; n_lines_removed,
    words_left, kept, cleaned (the lines that pass). NULL, empty and white-space texts have no
    words and fail the base rules. Repeated rows are judged one by one.
    """
    rows = picked(docs, _key=key, _text=text).withColumn("_text", F.coalesce("_text", F.lit("")))
    rows = rows.withColumns({"_words": words_of(F.col("_text")), "_lines": F.split("_text", "\n")})
    rows = rows.withColumns(
        {
            "_full": F.filter("_lines", lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]"))),
            "_left": F.filter("_lines", line_passes),
        }
    )
    cleaned = F.array_join("_left", "\n")
    counted = rows.select(
        "_key",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_text", SPACE, "")).cast("long").alias("word_chars"),
        _symbols(F.col("_text")).cast("long").alias("n_symbols"),
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        n_repeated_words(F.col("_words")).alias("n_repeat_words"),
        (F.size("_lines") - F.size("_left")).cast("long").alias("n_lines_removed"),
        cleaned.alias("cleaned"),
    )
    counted = counted.withColumn(
        "words_left", F.regexp_count("cleaned", F.lit(WORD)).cast("long")
    )
    few = F.col("n_words") < LEAST_WORDS
    repetitive = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    failed = few | repetitive
    enough = F.col("words_left") >= (1 - most_lost) * F.col("n_words")
    return counted.select(
        F.col("_key").alias(key),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & enough).alias("kept"),
        "n_lines_removed",
        "words_left",
        "cleaned",
    )
