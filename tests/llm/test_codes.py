"""Vector codes against plain k-means over whole distance tables."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from strata.llm import ball_codes

SCHEMA = (
    "vec_id long, embedding array<double>, label int, _key string, _values string, code string, error string"
)


def plain(rows, parts, entries, rounds):
    kept = []
    for key, vector, label in rows:
        if vector and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((key, [math.floor(1024 * x) for x in vector], label))
    ordered = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    first = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in ordered[:entries]]
    books = [[v[p] for v in first] for p in range(parts)]

    def assigned():
        codes = []
        for vector in cut:
            row = []
            for part, book in zip(vector, books):
                d = [sum((a - b) ** 2 for a, b in zip(part, entry)) for entry in book]
                row.append((d.index(min(d)), min(d)))
            codes.append(row)
        return codes

    for _ in range(rounds):
        codes = assigned()
        for p, book in enumerate(books):
            for e in range(len(book)):
                mine = [v[p] for v, row in zip(cut, codes) if row[p][0] == e]
                if mine:
                    book[e] = [sum(c) // len(mine) for c in zip(*mine)]
    codes = assigned()
    errors = [sum(d for _, d in row) for row in codes]
    by_label = Counter()
    for (_, _, label), error in zip(kept, errors):
        by_label[label] += error
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return Counter(
        (key, "".join(f"{e:02x}" for e, _ in row), error, by_label[label], sha)
        for (key, _, label), row, error in zip(kept, codes, errors)
    )


def vectors(scale=1.0, seed=1, count=300):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 8))
    rows = []
    for i in range(count):
        vector = (centres[rng.integers(12)] + rng.normal(size=8) * 0.1) * scale
        rows.append((i, [float(x) for x in vector], [None, 1, 2][min(i % 7, 2)]))
    rows += [(7, rows[7][1], 1), (7, rows[8][1], None), (None, rows[9][1], 2), (None, [0.0] * 8, 2)]
    rows += [(900 + i, [0.5 / 1024] * 8, 3) for i in range(5)]  # ties, and entries alike
    rows += [(-5, None, 1), (-4, [], 1), (-3, [1.0] * 7 + [None], 1), (-2, [math.nan] * 8, 1), (-1, [math.inf] * 8, 1)]
    return rows


@pytest.mark.parametrize(
    "scale, entries, rounds, block", [(1.0, 40, 4, 200), (1.0, 256, 1, 1 << 21), (15_000.0, 20, 3, 1 << 21), (0.002, 9, 4, 64)]
)
def test_codes(spark, monkeypatch, scale, entries, rounds, block):
    monkeypatch.setattr(ball_codes, "BLOCK", block)
    rows = vectors(scale, seed=entries)
    df = spark.createDataFrame([(*r, "k", "v", "c", "e") for r in rows], SCHEMA).repartition(3)
    found = ball_codes.vector_codes(df, entries=entries, rounds=rounds)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(map(tuple, found.collect())) == plain(rows, 4, entries, rounds)


def test_balls_find_what_whole_tables_find():
    rng = np.random.default_rng(4)
    for spread in (2, 30, 10_000_000):
        rows = rng.integers(-spread, spread + 1, (500, 3))
        before = rng.integers(-spread, spread + 1, (60, 3))
        before[10:14] = before[3]
        codes, _ = ball_codes.nearest(rows, before)
        after = before.copy()
        after[::3] += rng.integers(-1, 2, after[::3].shape) * max(1, spread // 20)
        moved = (after != before).any(axis=1)
        got = ball_codes.nearest_by_balls(rows, after, codes, moved)
        for a, b in zip(got, ball_codes.nearest(rows, after)):
            assert (a == b).all()


def test_stable_balls_are_not_searched(monkeypatch):
    entries = np.array([[0, 0], [1000, 0], [0, 1000], [5000, 5000]])
    rows = np.concatenate([entries + d for d in (0, 1, 2)])
    codes, _ = ball_codes.nearest(rows, entries)
    asked = []
    full = ball_codes.squared_distances
    monkeypatch.setattr(ball_codes, "squared_distances", lambda a, b: asked.append(len(a)) or full(a, b))
    ball_codes.nearest_by_balls(rows, entries, codes, np.ones(4, dtype=bool))
    assert asked == [4]  # only the entries among themselves


def test_what_cannot_be_coded(spark):
    def coded(vector_rows, **options):
        df = spark.createDataFrame(vector_rows, "vec_id long, embedding array<double>, label int")
        return ball_codes.vector_codes(df, **options).collect()

    assert coded([]) == [] and coded([(1, None, None), (2, [], 1)]) == []
    for wrong in ([(1, [1.0] * 8, 1), (2, [1.0] * 4, 1)], [(1, [1.0] * 6, 1)]):
        with pytest.raises(ValueError, match="cannot be cut"):
            coded(wrong)
    with pytest.raises(Exception, match="too large"):
        coded([(1, [1e300] * 4, 1)])
    with pytest.raises(ValueError, match="hexadecimal"):
        coded([], entries=257)
