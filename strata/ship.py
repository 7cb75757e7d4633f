"""Sending this package to the executors, for functions that run in Python there."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.abspath(__file__))
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let executors import this package, once per application.

    Nothing is sent where the package is on PYTHONPATH, as it is when it was installed on all
    machines or submitted with ``--py-files``.
    """
    root, context = os.path.dirname(_PACKAGE), spark.sparkContext
    on_path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root in on_path or context.applicationId in _shipped:
        return
    folder = tempfile.mkdtemp(prefix="strata-package-")
    name = os.path.basename(_PACKAGE)
    context.addPyFile(shutil.make_archive(os.path.join(folder, name), "zip", root, name))
    _shipped.add(context.applicationId)
