"""The folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` as the session has it.

    Where it is unset, a temporary folder is set if driver and executors are one process (master ``local``), as
    in tests; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            base = held.get()
        elif not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        else:
            own = tempfile.mkdtemp(prefix="conformity-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            base = f"file://{own}"
            spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/scratch/{name}-{uuid.uuid4().hex}"
