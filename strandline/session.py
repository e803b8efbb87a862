"""The one place that builds a session for tests, the bench and local use."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "strandline", memory: str = "8g") -> SparkSession:
    """A local session with the settings a cluster would also carry (adaptive execution, UTC)."""
    shared = os.environ.get("STRANDLINE_SHARED") or tempfile.mkdtemp(prefix="strandline-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.checkpoint.dir", f"file://{shared}/checkpoint")
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
