"""Verdicts on urls against plain comparison with every rule."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import url_cascade

HOSTS = ["a.org", "www.a.org", "b.a.org", "xa.org", "bad-casino.net", "net", "x.y.z.net", "org", "", "A.Org"]
PATHS = ["", "/", "/en/1", "/en/12", "/en/2", "/es/", "/es", "/ES/", "/en/1?q=/es/", "#/es/", "/é/ü"]
LISTING = [
    ("org/", "allow"), ("a.org/en/1", "block"), ("b.a.org/en", "allow"), ("a.org/é/", "block"),
    ("net/", "block"), ("z.net/es", "allow"), ("/en", "block"), ("casino", "block"), ("y", "allow"),
    ("org/es/", "block"), ("org/es/", "allow"), ("org/es/", "allow"), ("nowhere.com/", "block"), (None, "block"),
]


def urls():
    rows = [f"http://{h}{p}" for h in HOSTS for p in PATHS]
    rows += [None, "", "no scheme", "a://b://c.org/x", "x\ny://a.org/en/1\nz", "mailto:a@b.org"]
    rows += ["http://" + "l." * 300 + "a.org/" + "p" * 30_000, "http://a.org/en/1", "http://a.org/en/1"]
    rows += [f"http://u:p@c{i}.org:80/{i}" for i in range(20)]
    return rows


def expected(url, listing):
    match = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = match.groups() if match else ("", "")
    host = "".join(c.lower() if c.isascii() else c for c in host)
    verdicts = {}
    for entry, verdict in listing:
        if entry is not None:
            verdicts[entry] = max(verdict, verdicts.get(entry, verdict))
    fits = []
    for entry in verdicts:
        name, slash, rest = entry.partition("/")
        if slash and (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append(entry)
    rule = min(fits, key=lambda e: (-len(e), e), default=None)
    parts = [p for p in re.split("[.-]", host) if p]
    blocks = any(verdicts.get(p) == "block" for p in parts)
    verdict = verdicts[rule] if rule else ("block" if blocks else "allow")
    return host, path, rule, verdict


def listing_of(spark, rows=LISTING):
    return spark.createDataFrame(rows, "entry string, verdict string")


@pytest.mark.parametrize("limit", [url_cascade.CASCADE_BYTES, 10])
def test_urls_against_every_rule(spark, limit):
    rows = urls()
    pages = spark.createDataFrame(
        [(i, u, i, "x", None) for i, u in enumerate(rows)],
        "page_id long, url string, host long, rule string, _rules string",
    ).repartition(3)
    found = url_cascade.judged(pages, listing_of(spark), limit=limit)
    got = {r.row.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}
    assert got == {i: expected(u, LISTING) for i, u in enumerate(rows)}
    kept = url_cascade.allowed(pages, listing_of(spark), limit=limit)
    assert kept.columns == pages.columns
    blocked = {i for i, row in got.items() if row[3] == "block"}
    assert {r.page_id for r in kept.collect()} == set(range(len(rows))) - blocked


def test_nothing_to_judge_or_to_judge_by(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (None, None)], "page_id long, url string")
    assert url_cascade.judged(pages.limit(0), listing_of(spark)).count() == 0
    found = url_cascade.judged(pages, listing_of(spark, []))
    assert [(r.rule, r.verdict) for r in found.collect()] == [(None, "allow")] * 2
    with pytest.raises(Exception, match="no such verdict"):
        url_cascade.judged(pages, listing_of(spark, [("a.org/", "perhaps")])).collect()


@pytest.mark.parametrize("count, total", [(1, 5000), (300, 20_000), (60, 60)])
def test_a_cascade_is_exact(spark, count, total):
    chosen = set(random.Random(count).sample(range(total), count))
    keys = spark.createDataFrame([(f"k{i}", i in chosen) for i in range(total)], "k string, _listed boolean")
    keys = keys.select("k", F.xxhash64("k").alias("_h1"), F.xxhash64("k", F.lit(1)).alias("_h2"), "_listed")
    cascade = url_cascade.build_cascade(keys)
    rows = keys.collect()
    first = np.array([r._h1 for r in rows]).view(np.uint64)
    second = np.array([r._h2 for r in rows]).view(np.uint64)
    assert url_cascade.listed(first, second, cascade).tolist() == [r._listed for r in rows]
    if count < total / 10:
        spent = sum(level.size for level in cascade)
        assert spent <= 64 * len(cascade) + 1.6 * count * (np.log2(total / count) + 4)


def test_keys_that_hash_alike_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(url_cascade, "LEVELS", 6)
    keys = spark.createDataFrame([(1, 1, True), (1, 1, False)], "_h1 long, _h2 long, _listed boolean")
    with pytest.raises(ValueError, match="told apart"):
        url_cascade.build_cascade(keys)
