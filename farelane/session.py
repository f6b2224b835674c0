"""Session helpers: a local session for tests/bench and a shared scratch area.

On a cluster the session is created by the platform; the library never
overrides settings that are already present.  Scratch output (staged files,
gate staging tables) always goes under ``spark.checkpoint.dir`` -- the shared
folder the cluster names -- never under a machine-local temp folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on.  Applied only where the session has no value.
PLAN_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Wall-clock arithmetic on TIMESTAMP_NTZ does not depend on it, but keep
    # derived LTZ values reproducible.
    "spark.sql.session.timeZone": "UTC",
    # The repair / measure projections are wide; above ~8000 bytecodes
    # HotSpot does not JIT a generated method, so let Spark split such
    # stages into per-operator code instead of one huge method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Checkpointed copies (staged months, value counts) go when no longer used.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "farelane") -> SparkSession:
    """Local session for tests and the bench (never used by library code)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in PLAN_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: The one of PLAN_DEFAULTS that Spark's own default lacks: without it every wide projection runs interpreted.
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def ensure_plan_settings(spark: SparkSession) -> None:
    """Set the method limit in a session that has no value for it."""
    if spark.conf.get(METHOD_LIMIT, None) is None:
        spark.conf.set(METHOD_LIMIT, PLAN_DEFAULTS[METHOD_LIMIT])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where unset (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured and not current:
        spark.sparkContext.setCheckpointDir(configured)
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        local = tempfile.mkdtemp(prefix="farelane-ckpt-")
        spark.conf.set("spark.checkpoint.dir", local)
        spark.sparkContext.setCheckpointDir(local)
        current = spark.sparkContext.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir for one run."""
    root = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return os.path.join(root.rstrip("/"), "farelane-scratch", f"{label}-{uuid.uuid4().hex[:12]}")


#: Removes the files of a write's own shuffles as soon as it has ended; else they stay until the driver collects its garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Copies that the runs in progress have staged, the innermost run last.
_RUNS: ContextVar[tuple[list[str], ...]] = ContextVar("farelane_runs", default=())


@contextmanager
def own_shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """For a write: what it shuffled goes when it has ended."""
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """A run whose :func:`staged` copies go at its end, or before that with
    :func:`drop_staged`: for runs that write their result, which then reads
    none of them."""
    before = _RUNS.get()
    _RUNS.set((*before, []))
    try:
        yield
    finally:
        drop_staged(spark)
        _RUNS.set(before)


def drop_staged(spark: SparkSession) -> None:
    """Remove what the run in progress has staged so far; nothing outside of one."""
    if runs := _RUNS.get():
        while runs[-1]:
            remove_path(spark, runs[-1].pop())


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet below the checkpoint folder and read
    back: cuts the lineage as ``checkpoint()`` does, in a fraction of its
    bytes (columns, compressed; a checkpoint holds whole rows as they lie in
    memory).  Stays unless it is part of a :func:`staging` run."""
    path = scratch_path(df.sparkSession, label)
    if runs := _RUNS.get():
        runs[-1].append(path)
    with own_shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder of the library's own."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
