"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "usagetide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and a UTC clock; ``conf`` overrides."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Checkpoint files go when nothing refers to them any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` wins; a directory already set on the context comes
    next; only where neither exists on a single machine (tests, local runs) is a folder made.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    active = context.getCheckpointDir()
    if active is None:
        if configured is None:
            if not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            configured = tempfile.mkdtemp(prefix="usagetide-checkpoint-")
        context.setCheckpointDir(configured)
    return configured or active


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for ``name`` below the shared folder."""
    return os.path.join(shared_dir(spark), f"usagetide-{uuid.uuid4().hex}", name)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and cuts the lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
