"""Makes the package importable in Python workers.

A job started with ``--py-files`` or a PYTHONPATH that holds this package needs nothing.
Otherwise (a notebook, a driver that only extended its own ``sys.path``) the session ships the
package the usual way, as a zip file served by the driver.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    root = Path(__file__).resolve().parents[2]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _SHIPPED.add(app)
    target = Path(tempfile.mkdtemp(prefix="vitrina-ship-")) / "vitrina.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted((root / "vitrina").rglob("*.py")):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(str(target))
