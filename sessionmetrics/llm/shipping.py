"""Makes this package importable in the Python workers.

``spark-submit --py-files`` does the same; a session started some other way
gets a zip of the package through Spark's own file server, once.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the workers of ``spark`` unless already done."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or not os.path.isdir(_PACKAGE):
        return
    root, name = os.path.split(_PACKAGE)
    path = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}-package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(_PACKAGE):
            for file in files:
                if file.endswith(".py"):
                    full = os.path.join(folder, file)
                    out.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
