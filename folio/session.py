"""Session helpers: a local session for tests/bench and the shared work folder.

Library code never creates its own session; it takes the caller's.  The only
place that writes outside the result DataFrames (store snapshots, streaming
checkpoints) asks :func:`work_dir` for a folder under the cluster's
``spark.checkpoint.dir`` so that lost executors can recompute from a shared
location.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "folio") -> SparkSession:
    """Session used by tests and bench.  Cluster jobs use their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` names a shared filesystem; we read it
    and never replace it, and a cluster session without it is an error, as
    other machines would not see a folder of the driver's own.  Only a local
    session (tests, bench) gets a fresh folder under the system temp directory.
    """
    current = spark.conf.get(_CKPT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError(f"set {_CKPT_KEY} to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="folio-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return (spark.sparkContext.getCheckpointDir() or path).rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/folio/{name}-{uuid.uuid4().hex[:12]}"
