"""Spelling variants against comparison of all words with all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from strata.llm import queries, spelling
from tests.llm.fixtures import documents, empty, texts

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, ratio=5):
    near = {w: [v for v in counts if v != w and one_edit(w, v)] for w in counts}
    forms = {}
    for word, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        if best and counts[best] >= ratio * counts[word]:
            forms[word] = best
    rows = {}
    for word, n in counts.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        rows[word] = (form, root, n, len(near[word]), counts[form] if form else None)
    return rows


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = df.collect()
    assert len(rows) == len({r.word for r in rows})
    return {r.word: tuple(r)[1:] for r in rows}


def edited(rng, word, alphabet):
    at = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    if kind == 0:
        return word[:at] + rng.choice(alphabet) + word[at:]
    return word[:at] + (rng.choice(alphabet) if kind == 1 else "") + word[at + 1 :]


@pytest.mark.parametrize("alphabet, hot", [("ab", 50), ("abcdeéÀ", 20_000)])
def test_variants(spark, alphabet, hot):
    rng = random.Random(len(alphabet))
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randint(6, 9))) for _ in range(120)}
    for _ in range(3):
        words |= {edited(rng, w, alphabet) for w in sorted(words)}
    words |= {"a" * n for n in range(6, 12)} | {"ab" * n for n in range(3, 7)}
    words |= {"z" * 5000, "z" * 4999, "z" * 2000 + "y" + "z" * 2999}
    counts = {w: 5 ** rng.randint(1, 6) + rng.randint(0, 2) for w in sorted(words) if len(w) >= 6}
    rows = spark.createDataFrame(
        [(w, n, "x", "p") for w, n in counts.items()], "word string, n long, other string, _prefix string"
    )
    assert result(spelling.variants(rows, hot_entries=hot)) == brute(counts)


def test_odd_rows(spark):
    rows = [("walking", 5), ("walking", 5), ("walkin", 100), (None, 3), ("short", None), ("tiny", 9), ("aaaaa", 7)]
    found = result(spelling.variants(spark.createDataFrame(rows, "word string, n long")))
    assert found == brute({"walking": 10, "walkin": 100, "aaaaa": 7})
    nothing = spark.createDataFrame([], "word string, n long")
    assert result(spelling.variants(nothing)) == {}
    assert result(spelling.variants(spelling.counted(spelling.runs(empty(spark)).withColumnRenamed("run", "word")))) == {}
    with pytest.raises(ValueError, match="more often"):
        spelling.variants(nothing, ratio=1)


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(3)
    for _ in range(500):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(5, 12)))
        frequency = {a + b: rng.randint(1, 9) for a in "abc" for b in "abc"}
        prefix = spelling.prefix_of(word, frequency)
        found = spelling.pivots_of(prefix)
        costs = [a[0] + b[0] for a in prefix[:3] for b in prefix[:3] if a[2] + 2 <= b[2]]
        assert found[0][2] + 2 <= found[1][2] and sum(g[0] for g in found) == min(costs)


def test_query_with_its_slips(spark, tmp_path):
    rows = texts() + [(900 + i, "Straßen ÉTÉété garden walking " * 6) for i in range(900)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    frequent = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    assert result(queries.op12_pivotal_spelling(spark, str(tmp_path))) == brute(frequent)
    assert any(row[0] for row in brute(frequent).values())
