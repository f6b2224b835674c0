"""Monthly curation as a Structured Streaming job over the raw file folder.

New raw files are discovered by the file source; ``trigger(availableNow)``
processes everything present and stops, so the same job serves the monthly
schedule and catch-up runs.  The keep-best window and the reversal-pair
aggregation are not streaming operators, so each micro-batch only tells
*which months* changed; ``foreachBatch`` then re-reads every file of those
months (dynamic overwrite replaces a whole month, so it must be rebuilt
from all of its files), curates, gates and publishes them.  Re-running a
month is idempotent.  Progress lives in a checkpoint under the shared
checkpoint folder, so a restarted job continues where it stopped.

Pairs and duplicates are searched inside each file month
(:meth:`farelane.spec.TripColumns.by_month`): what a batch holds must not
change the rows.  A batch load searches all the months that it loads unless
its columns are scoped the same way, so a charge and its reversal that lie in
files of different months are a pair there and not here.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from farelane import spec
from farelane.sinks.parquet import gated_publish
from farelane.sources.files import listed_months, month_glob
from farelane.sources.runmodes import read_selected
from farelane.spec import DEFAULT_COLUMNS, TripColumns


def run_incremental(spark: SparkSession, folder: str, vehicle: str, target: str, checkpoint: str,
                    curate_fn: Callable[[DataFrame, TripColumns], DataFrame],
                    cols: TripColumns = DEFAULT_COLUMNS, files_per_batch: int = 0, strict: bool = False, arranged: bool = False) -> list:
    """Process all raw files not yet seen; returns the per-batch gate failures.

    ``curate_fn`` gets the raw rows of whole months and ``cols`` scoped to the
    file month (``arranged``: its rows lie by month).  The stream carries file names only, so files of any schema
    vintage pass."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(month_glob(folder, vehicle)).select("path")
    failures: list = []

    def rebuild_months(batch: DataFrame, epoch_id: int) -> None:
        months = sorted(tuple(r) for r in listed_months(batch).collect())  # months touched by this batch
        if months:
            curated = curate_fn(read_selected(spark, folder, vehicle, months), cols.by_month())
            failures.extend((epoch_id,) + tuple(r) for r in gated_publish(
                curated, target, strict, months, unique_key=(*spec.QUALITY_UNIQUE_KEY, "file_year", "file_month"), arranged=arranged))

    query = (stream.writeStream.foreachBatch(rebuild_months)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return failures
