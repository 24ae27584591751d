"""Makes this package importable on executors, wherever the driver imported it from."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_granary_shipped", False):
        return
    here = Path(__file__).resolve().parent
    if here.parent.suffix != ".zip":  # not on an executor's own copy
        # the driver serves the archive to executors, also to those that come later, as long as it lives
        folder = tempfile.mkdtemp()
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        target = Path(folder) / "src" / here.name
        shutil.copytree(here, target, ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(f"{folder}/granary", "zip", target.parent))
    context._granary_shipped = True
