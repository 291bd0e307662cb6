"""Makes the package known to Python workers that don't have it on their path."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_DONE: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's source to the executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _DONE:
        return
    root = Path(__file__).parent
    path = os.path.join(tempfile.mkdtemp(prefix="quillgraph-"), "quillgraph.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"quillgraph/{f.relative_to(root)}")
    sc.addPyFile(path)
    _DONE.add(sc.applicationId)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query that sends the package first."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
