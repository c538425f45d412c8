"""Session helpers: the library on the executors, and a session for local use."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors' Python workers this package, once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        top = Path(__file__).resolve().parent
        path = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace.zip")
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(top.rglob("*.py")):
                z.write(p, p.relative_to(top.parent))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
        # Whole texts go to Python workers: smaller batches than Spark's default, unless the session names its own.
        if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def local_session(cpus: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    conf = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
    }
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)
