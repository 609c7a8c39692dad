"""Make the package importable in Python workers."""

import io
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()
#: Rows and bytes of an Arrow batch: both sides of the exchange hold a few of them for every task.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches that fit long texts and lists, unless the session sets its own."""
    own = spark.conf.getAll
    for key, value in BATCHES.items():
        if key not in own:
            spark.conf.set(key, value)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application.

    Spark pickles library functions by reference, so workers must be able to import the package; a
    zip handed to ``addPyFile`` reaches them from the driver over Spark's own file server, whatever
    folders they share.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    if not root.is_dir():  # imported from a zip: it has been shipped already
        return
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    folder = tempfile.mkdtemp(prefix="ship")
    path = os.path.join(folder, f"{root.name}.zip")
    Path(path).write_bytes(buffer.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
