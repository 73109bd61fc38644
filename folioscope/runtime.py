"""What a session needs before Python code of this package runs on its workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers once a context, unless their PYTHONPATH already has it."""
    context = spark.sparkContext
    if ROOT in os.environ.get("PYTHONPATH", "").split(os.pathsep) or context.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(), "folioscope.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(os.path.join(ROOT, "folioscope")):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    out.write(file, os.path.relpath(file, ROOT))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
