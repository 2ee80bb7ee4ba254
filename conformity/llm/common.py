"""What the training-data operators share: shared scratch tables, worker set-up and two-level numbering.

Only folders that every executor sees are used: ``spark.checkpoint.dir`` as the session has it. Where it is
unset, a temporary folder is set if driver and executors are one process (master ``local``), as in tests; on
a cluster that is an error.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows handed to Python at a time; texts can be long, so far fewer than Spark's default.
ARROW_ROWS = 512
ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package and keep the batches they receive small."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths and ROOT not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
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


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages start from files, not lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_saved(*frames: DataFrame) -> None:
    """Delete the files of tables made by ``saved`` that nothing needs any more."""
    for df in frames:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/llm/" in path:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def numbered(df: DataFrame, group: list[str], order: list[Column], name: str, rows: int | None = None, per_task: int = 8192) -> DataFrame:
    """Add ``name``: gapless numbers from 0 within each ``group`` (of no columns: within all rows), without
    one task per group.

    Rows are dealt to hash bins, numbered there, and shifted by the sizes of the earlier bins of their group,
    so that a group with a third of all rows is still many tasks. A bin has about ``per_task`` rows or, of
    larger groups, the square root of the group's; so has the list of a group's bins. ``rows``: the number of
    rows, if it is known.
    """
    bins_of = lambda n: F.ceil(n / F.greatest(F.lit(float(per_task)), F.sqrt(n))).cast("int")
    if group:
        sizes = df.groupBy(*group).agg(F.greatest(F.lit(1), bins_of(F.count(F.lit(1)))).alias("__bins"))
        dealt = df.join(sizes, group)
    else:
        n = df.count() if rows is None else rows
        dealt = df.withColumn("__bins", F.greatest(F.lit(1), bins_of(F.lit(n))))
    dealt = dealt.withColumn("__bin", F.pmod(F.xxhash64(*order), F.col("__bins")).cast("int")).drop("__bins")
    counts = dealt.groupBy(*group, "__bin").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    here = F.row_number().over(Window.partitionBy(*group, "__bin").orderBy(*order)) - 1
    placed = dealt.withColumn("__here", here).join(counts, [*group, "__bin"])
    return placed.withColumn(name, (F.col("__before") + F.col("__here")).cast("long")).drop("__bin", "__here", "__before")


#: Keys are sent to every task up to this many rows (of about 40 bytes); beyond it both sides are shuffled.
BROADCAST_ROWS = 500_000


def small(keys: DataFrame, rows: int | None = None) -> DataFrame:
    """``keys`` with a broadcast hint if counting shows that they are few enough."""
    n = keys.count() if rows is None else rows
    return F.broadcast(keys) if n <= BROADCAST_ROWS else keys


_holder: dict[str, object] = {"name": None, "clear": None}


def claim(name: str, clear: Callable[[], object] | None = None) -> None:
    """Say that operator ``name`` works in this Python worker, at the start of a task.

    Workers outlive stages. What another operator kept in this one (hashes of words, a vocabulary) is
    let go, so that a pipeline needs the memory of its largest stage, not of all of them.
    """
    if _holder["name"] != name:
        if _holder["clear"]:
            _holder["clear"]()
            gc.collect()
        _holder["name"], _holder["clear"] = name, clear
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # returns freed memory to the system where libc can
            ctypes.CDLL(None).malloc_trim(0)
