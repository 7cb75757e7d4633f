import os

import pytest
from fixtures import rows
from pyspark import SparkContext
from pyspark.sql import DataFrameWriter

from checks.queries import QUERIES
from strata import scratch
from strata.scratch import materialise, scratch_root

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def on_cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://driver:7077")
    monkeypatch.setattr(scratch, "_tried", set(), raising=False)


def test_a_mounted_folder_is_taken_on_a_cluster(spark, on_cluster):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == shared
    assert (spark.sparkContext.applicationId, shared) in scratch._tried
    assert rows(materialise(spark.range(3), "three")) == [(0,), (1,), (2,)]


def test_without_a_checkpoint_folder_a_cluster_uses_the_warehouse(spark, on_cluster, monkeypatch):
    settings = type(spark.conf)
    unset = {"spark.checkpoint.dir": None}
    monkeypatch.setattr(SparkContext, "getCheckpointDir", lambda self: None)
    monkeypatch.setattr(
        settings, "get", lambda self, key, *a, get=settings.get: unset[key] if key in unset else get(self, key, *a)
    )
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    assert scratch_root(spark) == f"{warehouse}/strata-scratch"


def test_a_folder_in_which_rows_are_missing_is_refused(spark, on_cluster, monkeypatch):
    # What the driver sees of rows that executors wrote to disks of their own.
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: os.makedirs(path))
    with pytest.raises(ValueError, match="not the same folder"):
        scratch_root(spark)


@pytest.mark.parametrize("name", ["catalog_truncate", "dim_product", "ingest_batches"])
def test_queries_run_on_a_cluster_with_a_mounted_folder(spark, on_cluster, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
