"""Let Python workers find this package."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Add the folder of ``tillroll`` to the Python path of workers started from now on.

    That serves sessions whose executors see the driver's folders, whichever
    folder the program was started from. On other clusters send the package with
    ``--py-files`` or install it; the added path then does no harm.
    """
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if top not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([top, *paths])
