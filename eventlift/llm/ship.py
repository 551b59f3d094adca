"""Send the package to executors that cannot import it from their own path."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import eventlift

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    home = Path(eventlift.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="eventlift-code-")) / "eventlift.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(home.rglob("*.py")):
            out.write(path, path.relative_to(home.parent))
    context.addPyFile(str(archive))
    _sent.add(context.applicationId)
