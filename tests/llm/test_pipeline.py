"""The registered queries and the pipeline over the driver's smallest tables."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from checks.compare import compare, duck
from strata.llm import compression, mixing
from strata.llm.queries import ORACLE, QUERIES
from tests.llm.fixtures import WORD, documents, empty, normal, texts
from tests.llm.test_dedup import brute_components, plain_print

SF_DIR = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not here")

COLUMNS = {
    "op1_": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op2_": ["doc_id", "fingerprint", "component_id"],
    "op3_": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op4_": ["doc_id", "held_out", "score", "predicted"],
    "op5_": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op6_": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op7_": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op8_": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op9_": ["doc_id", "size", "source_size", "target", "taken"],
    "op10_": ["page_id", "url", "text", "n_chars"],
    "op11_": ["page_id", "host", "path", "rule", "verdict"],
    "op12_": ["word", "form", "root", "n", "n_near", "form_n"],
    "op13_": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
}
# Tables other than documents that queries give a row for each row of; None for no table.
TABLES = {"op10_": "pages", "op11_": "pages", "op12_": None, "op13_": "embeddings"}


def test_one_query_per_operator():
    assert sorted(name.split("_")[0] + "_" for name in QUERIES) == sorted(COLUMNS)


@here
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    short = name.split("_")[0] + "_"
    wanted, table = COLUMNS[short], TABLES.get(short, "documents")
    assert [c for c in found.columns if c in wanted] == wanted
    rows = found.count()
    given = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count() if table else 1
    assert rows >= given if name.startswith(("op6_", "op12_")) else rows == given
    if name in ORACLE:
        assert compare(spark, duck(SF_DIR), SF_DIR, QUERIES[name], ORACLE[name]) is None


class Brute:
    """The stages by hand, over rows in memory."""

    def __init__(self, rows):
        self.rows = rows

    def exact(self):
        first = {}
        for r in sorted(self.rows, key=lambda r: r.doc_id):
            first.setdefault(normal(r.text), r)
        return Brute(list(first.values()))

    def near(self):
        roots = brute_components([plain_print(r.text) for r in self.rows])
        first = {}
        for r in sorted(self.rows, key=lambda r: r.doc_id):
            first.setdefault(roots[plain_print(r.text)], r)
        return Brute(list(first.values()))


@here
def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = compression.learnt(docs, labels)
    rows = docs.collect()
    good = model.scores([r.text for r in rows]) >= 0.5
    left = Brute([r for r, keep in zip(rows, good) if keep]).exact().near().rows
    after = corpus_pipeline.near_copies(
        spark, corpus_pipeline.exact_copies(spark, corpus_pipeline.quality(spark, docs, SF_DIR), SF_DIR), SF_DIR
    )
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in left)
    used = {r.doc_id: r.copies for r in mixing.mix(after).collect()}
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for r in left:
        ids = plain.encode(r.text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048
        bounds = [0, *range(first, len(ids) + 1, 2048)]
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            crc = zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())
            expected += [(r.doc_id, i, a, b - a, crc)] * used[r.doc_id]
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(expected)
    total = sum(r.length for r in found)
    assert len({r.sequence_id for r in found}) <= -(-total // 2048) + 2
    sizes = {r.doc_id: len(WORD.findall(r.text or "")) for r in left}
    assert sum(used[d] * n for d, n in sizes.items()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.1)


@here
def test_stages_keep_columns_and_live_with_anything(spark):
    odd = documents(spark)
    for table in (odd, empty(spark)):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_DIR)
            assert docs.columns == table.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= 0
    assert [name for name, _ in corpus_pipeline.STAGES] and len(texts()) == odd.count()


def test_the_rest_needs_none_of_this():
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for folder in ("strata", "checks"):
        for at, _, names in os.walk(os.path.join(root, folder)):
            if "llm" in os.path.relpath(at, root).split(os.sep):
                continue
            for name in names:
                if name.endswith(".py"):
                    assert "strata.llm" not in open(os.path.join(at, name)).read()
