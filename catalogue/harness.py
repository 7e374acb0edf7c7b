"""What a run on one machine needs besides the library."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def with_shared_folder(spark: SparkSession) -> SparkSession:
    """Gives a local session without ``spark.checkpoint.dir`` a checkpoint folder.

    All executors of a local session run on this machine and share the folder.
    On a cluster the setting stays as it is, and the library asks for it.
    """
    context = spark.sparkContext
    local = context.master.startswith("local") and "cluster" not in context.master
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if local and not named:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tarmac-"))
    return spark
