"""Python workers find this package wherever the driver was started from."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def importable(spark: SparkSession) -> None:
    """Put the package's parent folder on the Python path of workers started from now on.

    Executors need the package at the same path, as with any installed library.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
