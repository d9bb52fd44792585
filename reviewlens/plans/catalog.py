"""All registered queries."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

from reviewlens.plans import evaluation, explore, files, learned, profiles, rules  # noqa: F401
from reviewlens.plans.registry import ORACLES, QUERIES  # noqa: F401

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="reviewlens-"), "reviewlens")
    archive = shutil.make_archive(
        target, "zip", os.path.dirname(package), os.path.basename(package)
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
