"""Makes the package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parent.parent
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's source to the workers, once for each application, unless their PYTHONPATH already has it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or str(_ROOT) in os.environ.get("PYTHONPATH", "").split(":"):
        return
    target = Path(tempfile.mkdtemp(prefix="twinframe-")) / "twinframe.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted((_ROOT / "twinframe").rglob("*.py")):
            out.write(source, source.relative_to(_ROOT))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)
