"""Give the executors this package, so that queries run where it is not installed."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


#: Rows that travel to Python at a time; Spark's own number is meant for short rows, and texts are long ones.
BATCH_ROWS, SPARK_BATCH_ROWS = 1_000, "10000"


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the session's Python files, once for each application.

    Arrow batches become smaller unless the session has a number of its own.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", SPARK_BATCH_ROWS) == SPARK_BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    context = spark.sparkContext
    if getattr(context, "_tallyweave_shipped", False):
        return
    root = Path(__file__).parent
    target = os.path.join(tempfile.mkdtemp(prefix="tallyweave-"), "tallyweave_src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(target)
    context._tallyweave_shipped = True
