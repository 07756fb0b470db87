"""Session and shared-folder helpers.

Intermediate tables (loaded releases, checkpoints, stream state) go under
the cluster's shared checkpoint folder, read from the session. Only a local
session without one gets a folder of its own (tests, local runs).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "linkgap", driver_memory: str = "8g") -> SparkSession:
    """Session for tests and local benches (AQE on, UI off, UTC)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    When the session has none, a local-mode session gets a fresh folder of
    its own; a cluster session must name one (a machine-local folder would
    not be visible to the executors).
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="linkgap-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared folder."""
    return f"{shared_dir(spark)}/linkgap/{name}-{uuid.uuid4().hex[:12]}"
