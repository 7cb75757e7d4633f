"""The first drafts of the bench give the rows of the jobs that they are measured against."""

import os

import pytest

import bench
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not here")


@pytest.mark.parametrize("name", list(bench.NAIVE))
def test_first_draft(spark, name):
    ours, draft = QUERIES[name](spark, SF_DIR), bench.NAIVE[name](spark, SF_DIR)
    columns = sorted(set(ours.columns) & set(draft.columns))
    assert len(columns) >= len(ours.columns) - 1
    assert sorted(map(str, draft.select(columns).collect())) == sorted(map(str, ours.select(columns).collect()))
