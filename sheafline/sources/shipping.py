"""The library's own code on the executors, wherever the driver was started."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent.parent

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source to the session's Python workers, once; the driver serves the file."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    path = Path(tempfile.mkdtemp()) / f"{PACKAGE.name}-{context.applicationId}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as found:
        for source in sorted(PACKAGE.rglob("*.py")):
            found.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with the library sent ahead of it."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
