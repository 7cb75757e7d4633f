"""Language-model scores from a subword lattice.

A word may be cut into the pieces of an existing vocabulary in many ways. The forward recursion
adds the probabilities of all of them in log space, piece by piece from left to right; the
probability of a document is that of its words and its end. Pieces never cross a word's border,
so a document's recursion falls apart into those of its words, and each distinct word of the
corpus is done once: distinct words are counted over the whole corpus, scored, and joined back.
The frequent ones, a list of fixed length, go to every executor, the others through a join.

The vocabulary file brings pieces in order of their merges, no probabilities; that order gives
the first weights, and rounds of expected counts over the words of the learning rows, again by
forward and backward recursions, make them a model of the corpus. A character outside the
vocabulary costs one escape and then a uniform choice, so that every text has a probability.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import left_out, words_of
from strata.scratch import materialise

ROUNDS = 2
# Longest piece, in characters, that takes part; the vocabulary has none longer.
LONGEST = 16
# Words that every executor gets with their scores.
FREQUENT = 100_000
_START = "▁"  # Fixed value: the vocabulary's mark of the beginning of a word.
_END, _ESCAPE = "</s>", "<unk>"
_CODE_POINTS = 0x110000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = 1
# Cells of a table of words by characters; words beyond _SHORT keep no list of their edges.
_BLOCK = 200_000
_SHORT = 64
_GATHERED = 1 << 20


@lru_cache(maxsize=2)
def vocabulary(path: str) -> list[str]:
    """The pieces of a sentencepiece file in its order, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
    # Words have been cut out and lower-cased, so no other piece can occur in one.
    inner = [p for p in pieces if _START not in p[1:] and p == _lower(p) and len(p) <= LONGEST]
    return [*inner, _ESCAPE, _END]


def _lower(text: str) -> str:
    """A-Z in lower case, everything else as it is."""
    return text.translate(_TO_LOWER)


_TO_LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def first_weights(pieces: list[str]) -> np.ndarray:
    """Probabilities that fall with the rank in the vocabulary."""
    weights = 1.0 / (np.arange(len(pieces)) + 10.0)
    return weights / weights.sum()


class Lattice:
    """Forward and backward recursions over many words at a time."""

    def __init__(self, pieces: list[str], weights: np.ndarray):
        self.size = len(pieces)
        self.log = np.log(weights)
        self.escape = self.log[pieces.index(_ESCAPE)] - np.log(_CODE_POINTS)
        self.escape_id, self.end_id = pieces.index(_ESCAPE), pieces.index(_END)
        codes = [np.array([ord(c) for c in p], dtype=np.uint64) for p in pieces[: self.escape_id]]
        hashes = np.array([_hash(c) for c in codes], dtype=np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.longest = max(map(len, codes))
        self.powers = _powers(self.longest + 1)

    def _ids(self, hashes: np.ndarray) -> np.ndarray:
        """Piece of each hash, -1 for none."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def _edges(self, codes: np.ndarray, backward: bool = False) -> Iterator[tuple]:
        """Pieces between two places of words of one length: from, to, ids, log weights.

        In the order of their ends, or the other way round. A single character always has an
        edge, if need be that of the escape.
        """
        n, length = codes.shape
        running = np.zeros((n, length + 1), dtype=np.uint64)
        for i in range(length):
            running[:, i + 1] = running[:, i] * _BASE + codes[:, i] + np.uint64(_SHIFT)
        ends = range(1, length + 1)
        for end in reversed(ends) if backward else ends:
            for start in range(max(0, end - self.longest), end):
                power = self.powers[end - start]
                ids = self._ids(running[:, end] - running[:, start] * power)
                known = ids >= 0
                if start == end - 1:
                    weights = np.where(known, self.log[ids], self.escape)
                    yield start, end, np.where(known, ids, self.escape_id), weights
                elif known.any():
                    yield start, end, ids, np.where(known, self.log[ids], -np.inf)

    def forward(self, codes: np.ndarray, edges=None) -> np.ndarray:
        """Log probability of the beginnings of each word: all segmentations added."""
        n, length = codes.shape
        alpha = np.full((n, length + 1), -np.inf)
        alpha[:, 0] = 0.0
        for start, end, _, weights in edges or self._edges(codes):
            alpha[:, end] = np.logaddexp(alpha[:, end], alpha[:, start] + weights)
        return alpha

    def expected(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected use of each piece in words that occur so often."""
        n, length = codes.shape
        edges = list(self._edges(codes)) if length <= _SHORT else None
        alpha = self.forward(codes, edges)
        beta = np.full((n, length + 1), -np.inf)
        beta[:, length] = 0.0
        uses = np.zeros(self.size)
        # From the back: when an edge is met, all that follows its end has been added.
        for start, end, ids, weights in reversed(edges) if edges else self._edges(codes, True):
            through = weights + beta[:, end]
            beta[:, start] = np.logaddexp(beta[:, start], through)
            share = np.exp(alpha[:, start] + through - alpha[:, length])
            used = ids >= 0
            uses += np.bincount(ids[used], (share * counts)[used], self.size)
        return uses


def _hash(codes: np.ndarray) -> np.uint64:
    value = np.uint64(0)
    with np.errstate(over="ignore"):
        for c in codes:
            value = value * _BASE + c + np.uint64(_SHIFT)
    return value


def _powers(count: int) -> np.ndarray:
    powers = np.ones(count, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(1, count):
            powers[i] = powers[i - 1] * _BASE
    return powers


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length at a time: their positions and their characters with the mark."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for length in np.unique(lengths):
        mine = np.flatnonzero(lengths == length)
        step = max(1, _BLOCK // (int(length) + 1))
        for at in range(0, len(mine), step):
            some = mine[at : at + step]
            text = "".join(_START + words[i] for i in some)
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
            yield some, codes.astype(np.uint64).reshape(len(some), length + 1)


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of words put together up to so many characters.

    The recursions go over all words of one length at a time, so short batches are slow.
    """
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += int(batch["_word"].str.len().sum())
        if size >= _GATHERED:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def word_scores(lattice: Lattice, words: list[str]) -> np.ndarray:
    """log10 probability of each word."""
    found = np.zeros(len(words))
    for some, codes in by_length(words):
        found[some] = lattice.forward(codes)[:, -1]
    return found / np.log(10)


def tokens_of(text: str | None) -> list[str]:
    """Words with A-Z in lower case; white space is that of ASCII."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return [w.decode("utf-8", "surrogatepass") for w in raw]


def _word_counts(rows: DataFrame) -> DataFrame:
    """Distinct words of all rows: how often in learning rows, how often in all."""
    lowered = F.translate("_text", string.ascii_uppercase, string.ascii_lowercase)
    words = rows.select(F.explode(words_of(lowered)).alias("_word"), "_held")
    learnt = F.count_if(~F.col("_held")).alias("_c")
    return words.groupBy("_word").agg(learnt, F.count(F.lit(1)).alias("_n"))


def _learnt(counts: DataFrame, ends: int, pieces: list[str], rounds: int) -> np.ndarray:
    """Weights after some rounds of expected counts over the learning words."""
    weights = first_weights(pieces)
    words = counts.filter("_c > 0").select("_word", "_c")

    def expect(batches: Iterator[pd.DataFrame], weights: np.ndarray) -> Iterator[pd.DataFrame]:
        lattice, uses = Lattice(pieces, weights), np.zeros(len(pieces))
        for batch in _gathered(batches):
            names, often = batch["_word"].tolist(), batch["_c"].to_numpy(dtype=float)
            for some, codes in by_length(names):
                uses += lattice.expected(codes, often[some])
        used = np.flatnonzero(uses)
        yield pd.DataFrame({"_id": used, "_uses": uses[used]})

    for _ in range(rounds):
        now = weights
        parts = words.mapInPandas(lambda b: expect(b, now), "_id int, _uses double")
        # One row per piece of the vocabulary comes to the driver.
        sums = parts.groupBy("_id").agg(F.sum("_uses").alias("n")).collect()
        uses = np.zeros(len(pieces))
        for row in sums:
            uses[row["_id"]] = row["n"]
        uses[len(pieces) - 1] += ends
        weights = (uses + 0.01) / (uses + 0.01).sum()
    return weights


def lattice_scores(
    docs: DataFrame,
    vocabulary_file: str,
    held_out: Column | None = None,
    key: str = "doc_id",
    text: str = "text",
    rounds: int = ROUNDS,
    frequent: int = FREQUENT,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    Tokens are words with A-Z in lower case and one end per document. Rows with ``held_out``
    (by default a fifth, by their key) are scored and teach nothing. base_score is the log10
    probability by smoothed token counts, score that of the lattice. NULL, empty and white-space
    texts are an end alone. Repeated rows count as often as they occur. Without learning rows the
    weights are those of the vocabulary's order.
    """
    held = left_out(key, 5) if held_out is None else held_out
    pieces = vocabulary(vocabulary_file)
    rows = docs.select(docs[key].alias("_key"), docs[text].alias("_text"), held.alias("_held"))
    counts = materialise(_word_counts(rows), "lattice-counts")
    ends = rows.filter("NOT _held").count()
    totals = counts.filter("_c > 0").agg(F.sum("_c"), F.count(F.lit(1))).first()
    tokens = (totals[0] or 0) + ends
    distinct = totals[1] + (1 if ends else 0)
    weights = _learnt(counts, ends, pieces, rounds)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(pieces, weights)
        for batch in _gathered(batches):
            batch["_p"] = word_scores(lattice, batch["_word"].tolist())
            yield batch

    scored = counts.mapInPandas(score, "_word string, _c bigint, _n bigint, _p double")
    scored = materialise(scored.withColumn("_b", F.log10(F.col("_c") + 0.5)), "lattice-words")
    # A list of fixed length, of words of a fixed length at most.
    top = scored.filter(F.length("_word") <= _SHORT).orderBy(F.desc("_n"), "_word").limit(frequent)
    listed = {r["_word"]: (r["_c"] > 0, r["_b"], r["_p"]) for r in top.collect()}
    shared = docs.sparkSession.sparkContext.broadcast(listed)

    @F.pandas_udf(_PARTS)
    def split(texts: pd.Series) -> pd.DataFrame:
        known = shared.value
        return pd.DataFrame([_parts(t, known) for t in texts], columns=_PARTS.names)

    stored = rows.select("_key", "_held", split("_text").alias("_p"))
    stored = stored.select(F.monotonically_increasing_id().alias("_row"), "_key", "_held", "_p.*")
    stored = materialise(stored, "lattice-rows")
    rare = stored.select("_row", F.explode(F.arrays_zip("_words", "_times")).alias("_w"))
    rare = rare.select("_row", F.col("_w._words").alias("_word"), F.col("_w._times").alias("_t"))
    rare = rare.join(scored, "_word").groupBy("_row").agg(
        F.sum(F.when(F.col("_c") > 0, F.col("_t")).otherwise(0)).alias("_rare_known"),
        F.sum(F.col("_t") * F.col("_b")).alias("_rare_base"),
        F.sum(F.col("_t") * F.col("_p")).alias("_rare_score"),
    )
    both = stored.drop("_words", "_times").join(rare, "_row", "left")
    total = {n: F.col(f"_{n}") + F.coalesce(f"_rare_{n}", F.lit(0)) for n in ("known", "base", "score")}
    end_base, end_score = np.log10(ends + 0.5), np.log10(weights[len(pieces) - 1])
    scale = float(np.log10(tokens + 0.5 * (distinct + 1)))
    n_tokens = F.col("_tokens") + 1
    return both.select(
        F.col("_key").alias(key),
        F.col("_held").alias("held_out"),
        n_tokens.alias("n_tokens"),
        (total["known"] + (1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (total["base"] + float(end_base) - n_tokens * scale).alias("base_score"),
        (total["score"] + float(end_score)).alias("score"),
    )


_PARTS = T.StructType(
    [
        T.StructField("_tokens", T.LongType()),
        T.StructField("_known", T.LongType()),
        T.StructField("_base", T.DoubleType()),
        T.StructField("_score", T.DoubleType()),
        T.StructField("_words", T.ArrayType(T.StringType())),
        T.StructField("_times", T.ArrayType(T.LongType())),
    ]
)


def _parts(text: str | None, known: dict[str, tuple[bool, float, float]]) -> tuple:
    """What the frequent words of a text add up to, and its other words with their counts."""
    words = Counter(tokens_of(text))
    n_known, base, score, rest, times = 0, 0.0, 0.0, [], []
    for word, n in words.items():
        facts = known.get(word)
        if facts is None:
            rest.append(word)
            times.append(n)
        else:
            n_known += n * facts[0]
            base += n * facts[1]
            score += n * facts[2]
    return sum(words.values()), n_known, base, score, rest, times
