"""The folder that the driver and all executors share."""

from __future__ import annotations

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which a cluster has to name. Only in local mode, where all
    run in one process, a temporary folder takes its place."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    name = context.getConf().get("spark.checkpoint.dir", None)
    if current.isEmpty():
        if not name:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
            import tempfile

            name = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(name)
    return (name or context._jsc.sc().getCheckpointDir().get()).rstrip("/")
