"""Parquet trip files: month staging, glob/merged scans, schema reconcile,
file provenance and partition-pruned reads of the curated table."""

from __future__ import annotations

from collections import OrderedDict
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, ShortType, StringType, StructType)

from farelane import spec
from farelane.session import own_shuffles_removed


# -- writing monthly raw files ---------------------------------------------------

def month_file_name(vehicle: str, year: Column, month: Column) -> Column:
    """``<vehicle>_tripdata_<yyyy>-<mm>.parquet`` from year / month columns."""
    return F.concat(F.lit(f"{vehicle}_tripdata_"), F.lpad(year.cast("string"), 4, "0"), F.lit("-"),
                    F.lpad(month.cast("string"), 2, "0"), F.lit(".parquet"))


def by_month_file(df: DataFrame, vehicle: str, year_col: str = "file_year", month_col: str = "file_month") -> DataFrame:
    """``df`` with the name of each row's month file as ``raw_file``, dealt and
    sorted by it.  Called on rows before they are widened, this moves the
    narrow rows only: :func:`write_month_files` then shuffles nothing."""
    return (df.withColumn("raw_file", month_file_name(vehicle, F.col(year_col), F.col(month_col)))
              .hint("rebalance", "raw_file").sortWithinPartitions("raw_file"))


def write_month_files(df: DataFrame, folder: str, vehicle: str,
                      year_col: str = "file_year", month_col: str = "file_month",
                      overwrite: str = "dynamic") -> str:
    """Land ``df`` as one raw dataset per month under ``folder``: every month
    becomes a Spark output folder whose name ends in
    ``<vehicle>_tripdata_<yyyy>-<mm>.parquet`` (year and month then live only
    in the name, as with downloaded monthly files).  A rebalance on the month
    lets AQE split a large month over several writers and merge small ones,
    so one month holding a third of the rows is not written by one task.
    Rows that :func:`by_month_file` has arranged are written as they lie.
    ``dynamic`` overwrite replaces only the months written (vintages can be
    landed one after another into the same folder)."""
    out = (df if "raw_file" in df.columns else by_month_file(df, vehicle, year_col, month_col)).drop(year_col, month_col)
    with own_shuffles_removed(df.sparkSession):
        (out.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
            .partitionBy("raw_file").parquet(folder))
    return folder


def month_glob(folder: str, vehicle: str, year: str = "*", month: str = "*") -> str:
    """Glob matching monthly raw files (plain files or Spark output folders)
    of this vehicle, and no file whose name merely ends like one."""
    return f"{folder.rstrip('/')}/{{,raw_file=}}{vehicle}_tripdata_{year}-{month}.parquet"


# -- reading ----------------------------------------------------------------------

def read_months(spark: SparkSession, paths: str | Sequence[str], merge_schema: bool = True,
                schema: StructType | str | None = None) -> DataFrame:
    """Multi-file Parquet scan; ``mergeSchema`` unions the column sets of
    file vintages (column names merge case-insensitively).  A known
    ``schema`` (e.g. from an earlier merge) skips the footer-merge job."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if schema is not None:
        return spark.read.schema(schema).parquet(*paths)
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(*paths)


def with_file_month(df: DataFrame, pattern: str = spec.FILE_MONTH_PATTERN,
                    year_col: str = "file_year", month_col: str = "file_month") -> DataFrame:
    """Add ``file_year`` / ``file_month`` (strings, '' when the name has no
    month) taken from the name of the file each row was read from.

    Uses the ``_metadata`` column, which keeps filter pushdown and column
    pruning (``input_file_name()`` blocks both).  Per row, a single regex
    yields ``yyyy-mm`` (shared by both outputs through common-subexpression
    elimination).  The default pattern reaches no further than the last two
    segments of the path, so that the path need not be cut to these first,
    which takes longer than the regex; for other patterns it is.
    """
    path = F.col("_metadata.file_path")
    tail = path if pattern == spec.FILE_MONTH_PATTERN else F.substring_index(path, "/", -2)
    ym = F.regexp_extract(tail, pattern, 1)
    return df.withColumns({year_col: F.substring(ym, 1, 4), month_col: F.substring(ym, 6, 2)})


def file_listing(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] = ("path",)) -> DataFrame:
    """``path`` (or ``modificationTime``, ``length``) of every file below
    ``paths``; no file is opened (the binary source reads contents only when
    that column is asked for)."""
    return spark.read.format("binaryFile").load([paths] if isinstance(paths, str) else list(paths)).select(*columns)


def listed_months(listing: DataFrame, pattern: str = spec.FILE_MONTH_PATTERN) -> DataFrame:
    """Distinct ``(file_year, file_month)`` of a listing's file names."""
    ym = F.regexp_extract(F.substring_index("path", "/", -2), pattern, 1)
    return (listing.select(ym.alias("ym")).where("ym <> ''").distinct()
                   .select(F.substring("ym", 1, 4).alias("file_year"), F.substring("ym", 6, 2).alias("file_month")))


def months_of(spark: SparkSession, folder: str, vehicle: str) -> list[tuple[str, str]]:
    """Months with raw files, in order.  Only one row per month reaches the driver."""
    return sorted(tuple(r) for r in listed_months(file_listing(spark, month_glob(folder, vehicle))).collect())


# -- schema reconcile ------------------------------------------------------------------

_NUMERIC_RANK = {ByteType: 0, ShortType: 1, IntegerType: 2, LongType: 3,
                 FloatType: 4, DoubleType: 5}


def _wider(a: DataType, b: DataType) -> DataType:
    if a == b:
        return a
    ra, rb = _NUMERIC_RANK.get(type(a)), _NUMERIC_RANK.get(type(b))
    if ra is not None and rb is not None:
        w = a if ra >= rb else b
        # long with float widens to double, as Spark's own numeric promotion
        if {type(a), type(b)} == {LongType, FloatType}:
            return DoubleType()
        return w
    if isinstance(a, DecimalType) or isinstance(b, DecimalType):
        return DoubleType()
    return StringType()


def reconcile(frames: Iterable[DataFrame]) -> DataFrame:
    """Union frames of different vintages by column name: missing columns
    become typed NULLs and numeric types widen (int < bigint < double),
    which ``mergeSchema`` refuses to do."""
    frames = list(frames)
    types: "OrderedDict[str, DataType]" = OrderedDict()
    canon: dict[str, str] = {}
    for f in frames:
        for field in f.schema.fields:
            key = field.name.lower()
            name = canon.setdefault(key, field.name)
            types[name] = _wider(types[name], field.dataType) if name in types else field.dataType

    def aligned(f: DataFrame) -> DataFrame:
        have = {x.lower(): x for x in f.columns}
        return f.select(*[(F.col(have[n.lower()]).cast(t) if n.lower() in have else F.lit(None).cast(t)).alias(n)
                          for n, t in types.items()])

    return reduce(lambda a, b: a.unionByName(b), [aligned(f) for f in frames])


def read_reconciled(spark: SparkSession, paths: str | Sequence[str], provenance: bool = True) -> DataFrame:
    """Read monthly files whose schemas drifted: one scan per group of files
    whose types agree (see :mod:`farelane.sources.footers`), reconciled by
    name with widened types.  Without drift this is one scan."""
    from farelane.sources.footers import scan_groups
    scans = [read_months(spark, part, schema=schema) for schema, part in scan_groups(spark, paths)]
    if provenance:
        scans = [with_file_month(s) for s in scans]
    return scans[0] if len(scans) == 1 else reconcile(scans)


# -- curated table ----------------------------------------------------------------------

def curated_schema(layout=spec.CURATED_COLUMNS, timestamp_type: str = "ntz") -> str:
    """DDL schema of the curated table (partition columns stay strings)."""
    stamp = "timestamp_ntz" if timestamp_type == "ntz" else "timestamp"
    return ", ".join(f"{dst} {stamp if t == 'timestamp' else t}" for _, dst, t in layout)


def read_partitioned(spark: SparkSession, path: str, schema: StructType | str | None = None,
                     where: Column | str | None = None) -> DataFrame:
    """Read a year/month partitioned table.  With an explicit schema the
    partition columns keep their declared type (``'01'`` stays a string
    instead of being inferred as 1) and position; a ``where`` on them
    prunes folders."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    if schema is not None:  # partition columns come last from the reader: restore declared order
        df = df.select(*spark.createDataFrame([], schema).columns)
    return df.where(where) if where is not None else df


def read_last_months(spark: SparkSession, path: str, months: int, schema: StructType | str | None = None) -> DataFrame:
    """The last ``months`` (fewer than PAST_MONTHS_MAX) months that a
    partitioned table holds.  Which those are is found at run time, from the
    listing: Spark prunes the table's folders by the result of that side of
    the join, and the driver sees no month."""
    if not 0 < months < spec.PAST_MONTHS_MAX:
        raise ValueError(f"months must lie between 0 and {spec.PAST_MONTHS_MAX}")
    folder = r"/file_year=(\d{4})/file_month=(\d{2})/[^/]*$"
    held = (file_listing(spark, f"{path.rstrip('/')}/file_year=*/file_month=*")
            .select(F.regexp_extract("path", folder, 1).alias("file_year"), F.regexp_extract("path", folder, 2).alias("file_month")).distinct())
    recent = Window.orderBy(F.desc("file_year"), F.desc("file_month"))  # one row a month
    manifest = held.withColumn("_n", F.row_number().over(recent)).where(F.col("_n") <= months).drop("_n")
    table = read_partitioned(spark, path, schema)
    return table.join(F.broadcast(manifest), ["file_year", "file_month"]).select(*table.columns)  # at most `months` rows
