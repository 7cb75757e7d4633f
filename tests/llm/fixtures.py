"""Small tables with everything that an operator has to live with."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# The last columns have names that operators use inside.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("_key", T.StringType()),
        T.StructField("_text", T.LongType()),
        T.StructField("kept", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("_print", T.StringType()),
        T.StructField("_pattern", T.StringType()),
    ]
)


def prose(rng: random.Random, words: int) -> str:
    bank = ["stone", "river", "under", "small", "light", "garden", "over", "walking", "été", "Grüße"]
    bank += [f"w{rng.randint(0, 400)}" for _ in range(40)]
    text = " ".join(rng.choice(bank) for _ in range(words))
    return re.sub(r"(\S+ \S+ \S+ \S+ \S+ \S+ \S+)", r"\1.", text)


def texts() -> list[tuple[int | None, str | None]]:
    """Ids and texts: copies, near copies, NULLs, empty, white, odd and long ones."""
    rng = random.Random(5)
    rows: list[tuple[int | None, str | None]] = []
    for i in range(40):
        rows.append((i, prose(rng, rng.randint(1, 120))))
    rows += [(100 + i, rows[3][1]) for i in range(12)]
    rows += [(200 + i, rows[5][1].replace(" ", "  ", i)) for i in range(4)]
    long = prose(rng, 3000)
    for i in range(8):  # near copies: one word of many differs
        words = long.split(" ")
        words[17 * i + 5] = f"other{i}"
        rows.append((300 + i, " ".join(words)))
    rows += [(400, None), (401, ""), (402, " \t\n"), (403, "one"), (404, "One"), (405, "a\x0bb\x0cc\r\n")]
    rows += [(406, "x" * 20_000), (407, "word " * 9_000), (408, "\x1c odd   spaces here ")]
    rows += [(None, "no id"), (None, None), (None, rows[3][1])]
    rows += [(7, rows[7][1]), (7, rows[7][1])]  # repeated rows
    return rows


def documents(spark, rows=None):
    listed = texts() if rows is None else rows
    sources = ["a", "b", None, "é", "c"]
    return spark.createDataFrame(
        [
            (d, t, "a" if i % 3 == 0 else sources[i % 5], "k", i, "no", "s", "p", "q")
            for i, (d, t) in enumerate(listed)
        ],
        SCHEMA,
    ).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def normal(text: str | None) -> str:
    return SPACE.sub(" ", text or "")
