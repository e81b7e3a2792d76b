"""Makes this package importable on executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def spark_package(spark: SparkSession) -> None:
    """Ship the package's sources, once for each context."""
    sc = spark.sparkContext
    if getattr(sc, "_millrace_sources", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    # A file of the driver, which Spark sends to the executors.
    out = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace_sources.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("millrace", os.path.relpath(full, here)))
    sc.addPyFile(out)
    sc._millrace_sources = True
