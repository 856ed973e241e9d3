"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="plumbline-")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for one job, below the shared folder the cluster names.

    Only a local session without the setting gets a temporary folder: on a cluster no executor
    could read what another one wrote there.
    """
    base = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors can reach")
        base = _local_base()
    return f"{base.rstrip('/')}/plumbline/{label}-{uuid.uuid4().hex}"
