"""A fresh folder for intermediate tables, on storage every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"


def new_workspace(spark: SparkSession, name: str = "tripmart") -> str:
    """A new path under the shared folder the cluster names.

    Only a session known to run in this one process may fall back to a local folder.
    """
    shared = spark.conf.get(SHARED_FOLDER, None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", None) or ""):
        raise RuntimeError(f"set {SHARED_FOLDER} to a folder all executors share")
    return tempfile.mkdtemp(prefix=f"{name}-")
