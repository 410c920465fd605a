"""Make the package importable in Python workers, also where it is not installed on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED = "spanledger.llm.shipped"


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors, once for each application."""
    app = spark.sparkContext.applicationId
    if spark.conf.get(_SHIPPED, "") == app:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="spanledger-src-"), "spanledger_src.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("spanledger", os.path.relpath(path, package)))
    spark.sparkContext.addPyFile(archive)
    spark.conf.set(_SHIPPED, app)
