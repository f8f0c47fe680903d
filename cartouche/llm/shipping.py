"""Workers import this package: send it with the session, so that a driver may run from any folder."""

from __future__ import annotations

import shutil
import tempfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import SparkSession

import cartouche


@lru_cache(maxsize=1)
def archive() -> str:
    root = Path(cartouche.__file__).parent
    folder = tempfile.mkdtemp(prefix="spark-")
    kept = Path(folder) / "package" / root.name
    shutil.copytree(root, kept, ignore=shutil.ignore_patterns("__pycache__"))
    return shutil.make_archive(f"{folder}/{root.name}", "zip", kept.parent)


def ship(spark: SparkSession) -> None:
    """Add the package to the session's files, once a session. The driver serves it to executors."""
    name = Path(archive()).name
    if not any(str(f).endswith(f"/{name}") for f in spark.sparkContext._python_includes + list(spark.sparkContext.listFiles)):
        spark.sparkContext.addPyFile(archive())
