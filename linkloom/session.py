"""Sends this package to executors, whose Python has to import it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Adds the package to the application once, as one small archive."""
    application = spark.sparkContext.applicationId
    if application in _SENT:
        return
    package = Path(__file__).resolve().parent
    archive = str(Path(tempfile.mkdtemp(prefix="linkloom-")) / "linkloom.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, str(file.relative_to(package.parent)))
    spark.sparkContext.addPyFile(archive)
    _SENT.add(application)
