"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder the cluster names in ``spark.checkpoint.dir``.

    Only when that setting is absent (a local test session) is a folder on this machine
    used; a cluster must name a shared one, since executors write there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="winnow-")
    return f"{root.rstrip('/')}/winnow/{label}-{uuid.uuid4().hex}"
