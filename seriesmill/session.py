"""Where a job may write tables that later stages, or later jobs, read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name for ``purpose`` below the cluster's shared checkpoint folder.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local session may do without:
    it gets a temporary folder of its own. Elsewhere a machine-local folder would be lost with its
    machine, so a missing setting is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="seriesmill-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
