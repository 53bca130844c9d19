"""Folders for stage tables."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"

# Folders made for local sessions that name none, by application.
_made: dict[str, str] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder that all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``.  A local session
    that has none gets one; a cluster session that has none is refused, because a
    folder of one machine would lose the table with the machine.
    """
    shared = spark.conf.get(SHARED_FOLDER, None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(f"set {SHARED_FOLDER} to a folder that all executors share")
        app = spark.sparkContext.applicationId
        shared = _made.setdefault(app, _made.get(app) or tempfile.mkdtemp(prefix="run-"))
    return f"{shared.rstrip('/')}/{label}-{uuid4().hex}"
