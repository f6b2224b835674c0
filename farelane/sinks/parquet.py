"""Year/month partitioned Parquet sink with idempotent month replacement.

``dynamic`` partition overwrite replaces exactly the months present in the
written frame and leaves every other month untouched, so re-running a month
(late corrections) is idempotent.  The option is set on the writer, not on
the session.

Writers: instead of funnelling the output through one task, a ``rebalance``
on the partition columns lets AQE cut a large month into several
advisory-size writer tasks and merge small months.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from farelane import spec
from farelane.plans import quality
from farelane.session import drop_staged, own_shuffles_removed, remove_path, scratch_path

PARTITION_COLUMNS = ("file_year", "file_month")


#: Files that a task may hold open at once: rows that lie by month need no sort before they are written.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_partitioned(df: DataFrame, path: str, partition_cols=PARTITION_COLUMNS,
                      overwrite: str = "dynamic", max_records_per_file: int | None = None, arranged: bool = False) -> None:
    """``arranged``: the tasks' rows lie by partition already, so they are
    neither shuffled nor sorted."""
    writer = ((df if arranged else df.hint("rebalance", *partition_cols)).write
                .mode("overwrite")
                .option("partitionOverwriteMode", overwrite)
                .partitionBy(*partition_cols))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    conf, before = df.sparkSession.conf, df.sparkSession.conf.get(WRITERS)
    try:
        if arranged:
            conf.set(WRITERS, "8")
        with own_shuffles_removed(df.sparkSession):
            writer.parquet(path)
    finally:
        conf.set(WRITERS, before)


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str], bloom: Sequence[str] = (), partition_cols=PARTITION_COLUMNS,
                    overwrite: str = "dynamic", row_group_bytes: int | None = None) -> None:
    """Month files whose rows are sorted by ``cluster_by``, with Parquet Bloom
    filters on ``bloom``: a lookup on those columns skips the row groups (and,
    by column index, the pages) that cannot hold its keys.  The sort is inside
    each writer task, so it adds no shuffle to :func:`write_partitioned`."""
    writer = (df.hint("rebalance", *partition_cols).sortWithinPartitions(*partition_cols, *cluster_by).write
                .mode("overwrite").option("partitionOverwriteMode", overwrite).partitionBy(*partition_cols))
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)


def clear_month(spark: SparkSession, target: str, values: Sequence[str], schema: StructType,
                partition_cols=PARTITION_COLUMNS) -> None:
    """Leave one partition of ``target`` without rows: dynamic overwrite does
    not touch a partition that the written frame has no row of."""
    folder = "/".join([target.rstrip("/"), *[f"{k}={v}" for k, v in zip(partition_cols, values)]])
    inner = StructType([f for f in schema.fields if f.name not in partition_cols])
    spark.createDataFrame([], inner).write.mode("overwrite").parquet(folder)


def gated_publish(df: DataFrame, target: str, strict: bool = True, months: Sequence[tuple] | None = None,
                  timestamp_type: str = "ntz", unique_key: Sequence[str] = spec.QUALITY_UNIQUE_KEY, arranged: bool = False) -> list[tuple]:
    """Curated frame -> quality gate -> month replacement in ``target``.

    1. Stage the frame once in the shared checkpoint folder, rows of a month
       together (``arranged`` ones lie so); the copy is removed at the end.
       In a ``staging`` run the copies that led to it go now.
    2. All checks on that copy.  Strict mode raises on any failure; ``target``
       is then untouched.
    3. Dynamic overwrite from the executors replaces the months present.
       ``months`` (file_year, file_month) names what was processed: a month
       of those that has no row left is emptied.
    Returns the failing report rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "gated")
    try:
        with own_shuffles_removed(spark):
            (df if arranged else df.hint("rebalance", *PARTITION_COLUMNS)).write.parquet(path)
        drop_staged(spark)
        staged = spark.read.schema(df.schema).parquet(path)
        bad = quality.gate(staged, strict, timestamp_type, unique_key)
        write_partitioned(staged, target, overwrite="dynamic", arranged=True)
        if months:
            present = {tuple(r) for r in staged.select(*PARTITION_COLUMNS).distinct().collect()}  # a row per month
            for month in months:
                if tuple(month) not in present:
                    clear_month(spark, target, month, staged.schema)
    finally:
        remove_path(spark, path)
    return bad
