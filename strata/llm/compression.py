"""Quality of texts by compression with dictionaries of good and of bad text.

Two zstandard dictionaries are built, from labelled good and labelled bad texts. A text is cut
into blocks, each block is compressed with both, and the sizes are added up over the whole text.
The difference of the two sizes over their sum, together with the size per byte under the good
dictionary (texts that repeat themselves shrink under either), goes through a logistic curve
that is fitted on other labelled texts than the dictionaries.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import left_out, picked, prepared

# Labelled texts per class that are used to learn, and bytes of them for a dictionary.
SAMPLE = 3000
SAMPLE_BYTES = 24 << 20
# Bytes of labelled texts per class that come to the driver; longer texts than a sixteenth of
# them teach nothing.
TAUGHT_BYTES = 32 << 20
DICTIONARY = 112_640
BLOCK = 1024
LEVEL = 3
_HEAD = 20  # Bytes that every text is taken to have besides its own.
_LEAST_SAMPLES = 16


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    @cached_property
    def compressors(self) -> list[zstandard.ZstdCompressor]:
        made = []
        for data in (self.good, self.bad):
            if not data:
                made.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))
                continue
            dictionary = zstandard.ZstdCompressionDict(data)
            dictionary.precompute_compress(level=LEVEL)
            made.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False
                )
            )
        return made

    def sizes(self, text: str | None) -> tuple[int, int, int]:
        """Bytes of a text with the good and the bad dictionary, and without compression."""
        data = (text or "").encode("utf-8", "surrogatepass")
        blocks = [data[at : at + BLOCK] for at in range(0, len(data), BLOCK)] or [b""]
        good, bad = (sum(len(c.compress(b)) for b in blocks) for c in self.compressors)
        return good, bad, len(data)

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        """Score of each text from 0 to 1; an empty text has a score like any other."""
        z = features([self.sizes(t) for t in texts]) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def features(sizes: Sequence[tuple[int, int, int]]) -> np.ndarray:
    good, bad, plain = np.array(sizes, dtype=float).reshape(-1, 3).T
    rate = 3 * good / (plain + _HEAD)
    apart = 10 * (good - bad) / (good + bad)
    return np.stack([np.ones(len(good)), apart, rate, rate**2, 100 / (plain + _HEAD)], axis=1)


def dictionary(texts: Sequence[str], size: int = DICTIONARY) -> bytes:
    """A dictionary of these texts; the texts themselves where they are too few to train one."""
    samples = [t.encode("utf-8", "surrogatepass") for t in texts if t]
    held, kept = 0, []
    for sample in samples:
        held += len(sample)
        if held > SAMPLE_BYTES and kept:
            break
        kept.append(sample)
    if len(kept) >= _LEAST_SAMPLES:
        try:
            return zstandard.train_dictionary(min(size, max(1024, held // 8)), kept).as_bytes()
        except zstandard.ZstdError:  # the samples have too little in common
            pass
    return b"".join(kept)[-size:]


def calibrated(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton's method."""
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + ridge * weights
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(x.shape[1])
        weights = weights - np.linalg.solve(curve, slope)
    return weights


def learn(good: Sequence[str], bad: Sequence[str], size: int = DICTIONARY) -> Model:
    """Dictionaries from every other text of each class, the curve from the rest.

    Without texts of both classes there is nothing to tell apart: every score is 1/2 then, or
    near to the class that there is.
    """
    rough = Model(dictionary(good[0::2], size), dictionary(bad[0::2], size), ())
    rest = [*good[1::2], *bad[1::2]]
    y = np.array([1.0] * len(good[1::2]) + [0.0] * len(bad[1::2]))
    x = features([rough.sizes(t) for t in rest])
    return Model(rough.good, rough.bad, tuple(calibrated(x, y).tolist()))


def learnt(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    held_out: Column | None = None,
    sample: int = SAMPLE,
    taught_bytes: int = TAUGHT_BYTES,
) -> Model:
    """The model of at most ``sample`` labelled texts per class outside ``held_out``.

    The sample is drawn by a hash of the key from ``labels``, whatever the size of the tables;
    its keys, a list of fixed length, are looked up in ``docs`` in one pass. NULL labels, NULL
    keys and labels without a document teach nothing; a key labelled twice counts once, and so
    does a key with several documents (the smallest text). Of each class ``taught_bytes`` are
    used, in the order of the hash; texts beyond a sixteenth of that are left out.
    """
    prepared(docs.sparkSession)
    held = left_out(key, 3) if held_out is None else held_out
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held)
    known = known.groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_label"))
    drawn = None
    for value in (0, 1):
        some = known.filter(F.col("_label") == value).orderBy(F.xxhash64("_key"), "_key")
        some = some.limit(sample)
        drawn = some if drawn is None else drawn.unionByName(some)
    rows = picked(docs, _key=key, _text=text)
    text_of = F.coalesce("_text", F.lit(""))
    rows = rows.select("_key", text_of.alias("_text"), F.octet_length(text_of).alias("_size"))
    short = rows.filter(F.col("_size") <= taught_bytes // 16)
    single = short.join(F.broadcast(drawn), "_key").groupBy("_key", "_label").agg(
        F.min(F.struct("_text", "_size")).alias("_row")
    )
    # At most ``sample`` rows of a class.
    by_hash = Window.partitionBy("_label").orderBy(F.xxhash64("_key"), "_key")
    running = F.sum("_row._size").over(by_hash.rowsBetween(Window.unboundedPreceding, 0))
    fitting = single.withColumn("_running", running).filter(F.col("_running") <= taught_bytes)
    found = fitting.orderBy(F.xxhash64("_key"), "_key").select("_label", "_row._text").collect()
    texts = {v: [r["_text"] for r in found if r["_label"] == v] for v in (0, 1)}
    return learn(texts[1], texts[0])


def _scorer(model: Model):
    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()), dtype=float)

    return score


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    parts: int = 3,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, held_out, score, predicted.

    A third of all keys is held out and teaches nothing. NULL is an empty text and has a score;
    long texts are scored whole; equal texts, repeated rows among them, have equal scores. No
    documents give no rows; without labels every score is 1/2. Other columns may have any name.
    """
    model = learnt(docs, labels, key, text, label, left_out(key, parts))
    rows = picked(docs, _key=key, _text=text)
    scored = rows.select("_key", _scorer(model)("_text").alias("score"))
    return scored.select(
        F.col("_key").alias(key),
        left_out("_key", parts).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    least: float = 0.5,
) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``, columns as they are.

    Rows are judged one by one, as in :func:`quality_scores`; columns may have any name.
    """
    model = learnt(docs, labels, key, text, label)
    return docs.filter(_scorer(model)(F.col(text)) >= least)
