"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Calendar days are UTC days; the rest lets Spark re-plan joins at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # jobs submitted side by side share the executors
    "spark.scheduler.mode": "FAIR",
}


def local_session(app: str, cores: int | str = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark. On a cluster use the one you are given."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cores),
        **extra,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which every executor can reach.

    A machine-local folder is used only when the setting is absent and Spark itself is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="starmill-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
