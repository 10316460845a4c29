"""Make this package importable in Python workers that were not started with it on their path."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="meterlake-code-"), os.path.basename(package))
    sc.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package)))
    _sent.add(sc.applicationId)


def shipped(operator):
    """An operator over tables that brings the package to the executors itself."""

    @functools.wraps(operator)
    def run(*args, **kw):
        for table in (*args, *kw.values()):
            if isinstance(table, DataFrame):
                ship(table.sparkSession)
                break
        return operator(*args, **kw)

    return run
