"""Mixing: targets, flow against brute force, and what is taken."""

import random
from itertools import product

import pytest

from strata.llm import mixing
from tests.llm.fixtures import WORD, documents, empty, texts


def test_targets_are_shared_by_weight_up_to_a_limit():
    sizes = {"a": 100, "b": 100, "c": 10, None: 40}
    weights = mixing.cycled(list(sizes))
    assert weights == {"a": 3.0, "b": 1.0, "c": 2.0, None: 3.0}
    found = mixing.targets(sizes, weights, 1.5 * 250)
    assert sum(found.values()) == pytest.approx(375)
    assert found["c"] == 20 and found[None] == 80
    assert found["a"] == 200 and found["b"] == pytest.approx(75)
    assert mixing.targets({"a": 0}, {"a": 1.0}, 0) == {"a": 0.0}
    assert mixing.targets({}, {}, 0) == {}


def cheapest(patterns, quotas, repeats):
    """Most words, then least cost, over all whole flows of tiny tables."""
    edges = [(p, s) for p in patterns for s in p]
    best = None
    for amounts in product(*[range(min(repeats * patterns[p], quotas[s]) + 1) for p, s in edges]):
        used = {p: sum(a for (q, _), a in zip(edges, amounts) if q == p) for p in patterns}
        into = {s: sum(a for (_, t), a in zip(edges, amounts) if t == s) for s in quotas}
        if any(used[p] > repeats * patterns[p] for p in patterns) or any(into[s] > quotas[s] for s in quotas):
            continue
        cost = sum(max(0, used[p] - patterns[p]) for p in patterns)
        best = max(best or (-1, 0), (sum(amounts), -cost))
    return best


def test_flow_is_largest_and_cheapest():
    rng = random.Random(3)
    for _ in range(60):
        patterns = {p: rng.randint(0, 3) for p in [("a",), ("b",), ("a", "b")] if rng.random() < 0.8}
        quotas = {"a": rng.randint(0, 5), "b": rng.randint(0, 5)}
        sent = mixing.flow(patterns, quotas, 2)
        used = {p: sum(n for (q, _), n in sent.items() if q == p) for p in patterns}
        into = {s: sum(n for (_, t), n in sent.items() if t == s) for s in quotas}
        assert all(used[p] <= 2 * patterns[p] for p in patterns)
        assert all(into[s] <= quotas[s] for s in quotas)
        cost = sum(max(0, used[p] - patterns[p]) for p in patterns)
        assert (sum(sent.values()), -cost) == (cheapest(patterns, quotas, 2) or (0, 0))


def test_mix_meets_targets(spark):
    # One id per row, so that results can be told apart by source.
    docs = documents(spark, [(i, t) for i, (_, t) in enumerate(texts())])
    found = {r.doc_id: r for r in mixing.mix(docs).collect()}
    sources: dict = {}
    for r in docs.select("doc_id", "text", "source").collect():
        assert found[r.doc_id]["size"] == len(WORD.findall(r.text or ""))
        sources.setdefault(r.source, []).append(found[r.doc_id])
    sizes = {s: sum(r["size"] for r in rows) for s, rows in sources.items()}
    expected = mixing.targets(sizes, mixing.cycled(list(sizes)), 1.5 * sum(sizes.values()))
    for s, rows in sources.items():
        assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in rows)
        assert {r.source_size for r in rows} == {sizes[s]}
        assert all(r.target == pytest.approx(expected[s]) for r in rows)
        assert abs(sum(r.taken for r in rows) - expected[s]) <= max(r["size"] for r in rows) + 1
    assert len(found) == docs.count()


def test_the_same_rows_give_the_same_mix(spark):
    docs = documents(spark)
    one = sorted(map(str, mixing.mix(docs).collect()))
    assert one == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    other = sorted(map(str, mixing.mix(docs, seed=5).collect()))
    assert len(other) == len(one)


def test_rows_are_repeated_as_often_as_they_are_used(spark):
    docs = documents(spark, [(i, " ".join(["w"] * (1 + i % 9))) for i in range(300)])
    used = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    rows = mixing.mixed(docs)
    assert rows.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert counts == {d: n for d, n in used.items() if n}


def test_documents_of_several_sources(spark):
    rows = [(i, "w " * 10, ["a", "b"] if i % 2 else ["a"]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source array<string>")
    made = mixing.mix(docs, weights={"a": 1.0, "b": 1.0}, share=0.5).collect()
    assert sum(r.taken for r in made) == pytest.approx(200, abs=20)
    # Documents of both sources also serve b, whose quota only they can fill.
    both = sum(r.taken for r in made if r.doc_id % 2)
    assert both >= 90


def test_nothing_to_mix(spark):
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mixed(empty(spark)).count() == 0
    blank = documents(spark, [(1, None), (2, ""), (None, None), *[(d, None) for d, _ in texts()[:3]]])
    assert all(r.taken == 0 for r in mixing.mix(blank).collect())
