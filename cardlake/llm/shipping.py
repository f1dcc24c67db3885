"""Makes this package importable for the Python workers of any executor."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hands the package to Spark's own file distribution, once per application.

    Operators with Python code call this, so they also run where the driver alone has the
    package on its path. The archive is built on the driver and fetched by the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    if os.path.isdir(package):  # else it runs from an archive that was shipped already
        archive = os.path.join(tempfile.mkdtemp(prefix="cardlake-"), "cardlake.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, root))
        context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
