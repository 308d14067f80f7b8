"""Sessions, and making this package known to Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
_SHIPPED: set[str] = set()


def local_session(cores: int = 8, **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("quire")
    settings = {"spark.sql.shuffle.partitions": str(cores), "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false"} | conf
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send the package to the workers, unless they find it on their path."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    places = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    if any(p and Path(p).resolve() == ROOT for p in places):
        return
    packed = Path(tempfile.mkdtemp(prefix="quire-")) / "quire.zip"
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted((ROOT / "quire").rglob("*.py")):
            z.write(f, f.relative_to(ROOT))
    context.addPyFile(str(packed))
