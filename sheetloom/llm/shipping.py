"""Send the package to Python workers of sessions that were started without it."""

from __future__ import annotations

import os
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application: a zip of the package, built in the driver's own Spark folder,
    that Spark hands to every executor."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    path = os.path.join(context._temp_dir, f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    packed.write(full, os.path.relpath(full, root))
    context.addPyFile(path)
    _sent.add(context.applicationId)
