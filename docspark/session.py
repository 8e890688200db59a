"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """Session for tests and the local benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("docspark")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below the shared one the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only where it is unset
    (local tests) is a temporary folder of this machine used instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="docspark-")
    return os.path.join(base, f"docspark-{uuid.uuid4().hex}")
