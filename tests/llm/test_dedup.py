"""Exact and near duplicates against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import exact, simhash
from tests.llm.fixtures import documents, empty, normal, texts


def smallest(ids):
    known = [i for i in ids if i is not None]
    return min(known) if known else None


# --- exact -------------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [1 << 15, 1 << 24])
def test_exact_groups(spark, bits):
    groups: dict[str, list] = {}
    for key, text in texts():
        groups.setdefault(normal(text), []).append(key)
    expected = Counter()
    for text, keys in groups.items():
        keep = smallest(keys)
        sha = hashlib.sha256(text.encode()).hexdigest()
        for key in keys:
            expected[key, keep if len(keys) > 1 else key, len(keys), key == keep, sha] += 1
    found = exact.exact_groups(documents(spark), filter_bits=bits, digests=True)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, found.collect())) == expected


def test_beginnings_alone_do_not_make_copies(spark):
    rows = [(1, "same head " * 50 + "a"), (2, "same head " * 50 + "b"), (3, "same head " * 50 + "a")]
    found = {r.doc_id: r.keep_id for r in exact.exact_groups(documents(spark, rows)).collect()}
    assert found == {1: 1, 2: 2, 3: 1}


def test_exact_dedup_keeps_one_row_per_text(spark):
    docs = documents(spark)
    kept = exact.exact_dedup(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert Counter(normal(r.text) for r in rows) == Counter({normal(t) for _, t in texts()})
    by_text: dict[str, list] = {}
    for key, text in texts():
        by_text.setdefault(normal(text), []).append(key)
    assert all(r.doc_id == smallest(by_text[normal(r.text)]) for r in rows)


def test_exact_of_nothing(spark):
    assert exact.exact_groups(empty(spark)).count() == 0
    assert exact.exact_dedup(empty(spark)).count() == 0


def test_exact_stays_in_the_jvm(spark):
    plan = exact.exact_groups(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- near --------------------------------------------------------------------------------


def plain_print(text):
    """Bit by bit, as it is defined."""
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()]
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(b" ".join(run), 42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    top = {p: p for p in prints}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    listed = sorted(top)
    for i, a in enumerate(listed):
        for b in listed[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = root(a), root(b)
                top[max(x, y)] = min(x, y)
    return {p: root(p) for p in listed}


def test_fingerprints_and_groups(spark):
    rows = texts()
    prints = [plain_print(t) for _, t in rows]
    roots = brute_components(prints)
    members: dict[int, list] = {}
    for (key, _), p in zip(rows, prints):
        members.setdefault(roots[p], []).append(key)
    expected = Counter(
        (key, f"{p:016x}", smallest(members[roots[p]]), len(members[roots[p]]))
        for (key, _), p in zip(rows, prints)
    )
    found = simhash.near_groups(documents(spark))
    assert found.columns == ["doc_id", "fingerprint", "component_id", "group_size"]
    assert Counter(map(tuple, found.collect())) == expected


def test_near_dedup_keeps_one_of_each_group(spark):
    docs = documents(spark)
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    rows = texts()
    roots = brute_components([plain_print(t) for _, t in rows])
    members: dict[int, list] = {}
    for key, text in rows:
        members.setdefault(roots[plain_print(text)], []).append(key)
    found = Counter((roots[plain_print(r.text)], r.doc_id) for r in kept.collect())
    assert found == Counter({(root, smallest(keys)): 1 for root, keys in members.items()})


def test_near_of_nothing(spark):
    assert simhash.near_groups(empty(spark)).count() == 0
    assert simhash.near_dedup(empty(spark)).count() == 0


def clustered(seed, clusters, each):
    """Prints in dense clusters, where buckets overflow, and by themselves."""
    rng = np.random.default_rng(seed)
    prints = set(rng.integers(0, 1 << 63, 200).tolist())
    for _ in range(clusters):
        centre = int(rng.integers(0, 1 << 63))
        for _ in range(each):
            flips = rng.choice(63, int(rng.integers(0, 5)), replace=False)
            prints.add(centre ^ sum(1 << int(b) for b in flips))
    return sorted(prints)


@pytest.mark.parametrize("bucket", [2, 256])
def test_every_link_counts_however_large_the_bucket(spark, bucket):
    prints = clustered(3, 3, 150)
    frame = spark.createDataFrame([(p,) for p in prints], "_print bigint")
    edges = simhash.link_fingerprints(frame, bucket=bucket)
    assert all((r._a ^ r._b).bit_count() <= 3 for r in edges.collect())
    roots = {r._node: r._root for r in simhash.components(edges).collect()}
    assert {p: roots.get(p, p) for p in prints} == brute_components(prints)


def test_long_chains_are_one_component(spark):
    chain = spark.range(400).selectExpr("id AS _a", "id + 1 AS _b").repartition(4)
    apart = spark.createDataFrame([(1000, 1001)], "_a bigint, _b bigint")
    roots = simhash.components(chain.unionByName(apart)).collect()
    assert {r._root for r in roots if r._node < 900} == {0} and len(roots) == 403


def test_masks_cover_any_three_bits():
    rng = np.random.default_rng(1)
    masks = [m & (1 << 64) - 1 for m in simhash.masks((1 << 64) - 1)]
    assert len(masks) == 20
    for _ in range(300):
        flips = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(flips & ~m == 0 for m in masks)


def test_pivots_discard_no_linked_pair():
    rng = np.random.default_rng(2)
    prints = rng.integers(0, 1 << 64, 500, dtype=np.uint64)
    moved = prints ^ np.uint64(0b1011)
    table = simhash.distances(np.concatenate([prints, moved]), simhash.pivots())
    assert np.abs(table[:500] - table[500:]).max() <= 3


def test_names_that_operators_use_inside_may_be_columns(spark):
    """Repeated rows take the way over marks; the columns are as they were."""
    names = ["_doc_id", "_text_sha256", "_near_mark", "_matching_doc_id", "_other_doc_id", "_matching_fingerprint"]
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (3, "other words are here now"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in names:
        docs = docs.withColumn(name, F.lit("mine"))
    for kept in (exact.exact_dedup(docs), simhash.near_dedup(docs)):
        assert kept.columns == docs.columns
        found = kept.collect()
        assert sorted((r.doc_id or 0, r.text or "") for r in found) == [
            (0, ""), (1, "a b c d e"), (3, "other words are here now")
        ]
        assert all(r[n] == "mine" for r in found for n in names)


def test_unique_keys_are_told_apart_without_hashes(spark):
    rows = [(i, f"text number {i % 40}" + " and more words" * (i % 3)) for i in range(120)]
    docs = documents(spark, rows)
    kept = {r.doc_id for r in exact.exact_dedup(docs).collect()}
    first = {}
    for key, text in rows:
        first.setdefault(text, key)
    assert kept == set(first.values())
