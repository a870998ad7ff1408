"""The folder all executors share, for tables that only live as long as a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``.

    Where it is not set, a temporary folder is used if Spark runs in one process on this
    machine. On a cluster it would be a folder that other machines do not see: an error.
    """
    base = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"{_SETTING} must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="vanescope-")
    return f"{base.rstrip('/')}/vanescope/{name}-{uuid.uuid4().hex}"
