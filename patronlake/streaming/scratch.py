"""Where streams keep checkpoints and outputs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder in the shared place the cluster names, spark.checkpoint.dir.

    Without one, a local folder will do for a local master alone: on a cluster each executor would
    write to a disk of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/patronlake-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="patronlake-")
