"""Send this package to the executors, which may not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once per application."""
    context = spark.sparkContext
    if getattr(context, "_strata_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="strata-code-")) / "strata.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(_PACKAGE.rglob("*.py")):
            archive.write(file, file.relative_to(_PACKAGE.parent))
    context.addPyFile(str(target))
    context._strata_shipped = True
