"""Footer catalogue of Parquet files.

One job reads every footer once, in the tasks (``pyarrow.fs`` opens the file;
no row is read), and reduces the files to (raw dataset, schema).  The driver
gets one row for each of those, and file names only of datasets whose own
files have types that conflict.  Schemas that agree in the types of their
common columns form one scan, however many there are and in whatever order
the months alternate between them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from farelane import spec
from farelane.sources.files import file_listing

SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def _normal(schema: StructType) -> StructType:
    """Names and types alone: NULLs and comments make no other schema."""
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


def _read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark.sql.pandas.types import from_arrow_schema
    for batch in batches:
        paths, schemas, rows = batch.column("path").to_pylist(), [], []
        for path in paths:
            store, name = fs.FileSystem.from_uri(re.sub(r"^s3a://", "s3://", re.sub(r"^file:/+", "/", path)))
            with store.open_input_file(name) as source:
                footer = pq.read_metadata(source)
            stored = (footer.metadata or {}).get(SPARK_SCHEMA)
            schema = (StructType.fromJson(json.loads(stored)) if stored
                      else from_arrow_schema(footer.schema.to_arrow_schema(), prefer_timestamp_ntz=True))
            schemas.append(_normal(schema).json())
            rows.append(footer.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(schemas, pa.string()), pa.array(rows, pa.int64())],
                                         names=["path", "schema", "n_rows"])


def footer_catalogue(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, schema`` (JSON) and ``n_rows`` of every file below ``paths``,
    and its ``dataset``: the folder named like a monthly file, or the file."""
    found = file_listing(spark, paths).mapInArrow(_read_footers, "path string, schema string, n_rows long")
    folder = F.regexp_replace("path", "/[^/]*$", "")
    monthly = F.regexp_like(folder, F.lit(spec.FILE_MONTH_PATTERN))
    return found.withColumn("dataset", F.when(monthly, folder).otherwise(F.col("path")))


def compatible(schemas: Sequence[StructType]) -> list[tuple[StructType, list[int]]]:
    """Classes of schemas whose common columns (case-insensitive) have equal
    types: the union of their columns, and which schemas they are."""
    classes: list[tuple[dict[str, StructField], list[int]]] = []
    for i, schema in enumerate(schemas):
        fields = {f.name.lower(): f for f in schema.fields}

        def fits(held: dict[str, StructField]) -> bool:
            types: list[tuple[DataType, DataType]] = [(held[k].dataType, f.dataType) for k, f in fields.items() if k in held]
            return all(a == b for a, b in types)
        for held, members in classes:
            if fits(held):
                for k, f in fields.items():
                    held.setdefault(k, f)
                members.append(i)
                break
        else:
            classes.append((dict(fields), [i]))
    return [(StructType(list(held.values())), members) for held, members in classes]


def scan_groups(spark: SparkSession, paths: str | Sequence[str]) -> list[tuple[StructType, list[str]]]:
    """Which datasets and files one scan can read, and the scan's schema."""
    rows = sorted(footer_catalogue(spark, paths).select("dataset", "schema").distinct().collect())
    if not rows:
        raise ValueError(f"no Parquet file below {paths}")
    texts = list(dict.fromkeys(r.schema for r in rows))
    classes = compatible([StructType.fromJson(json.loads(t)) for t in texts])
    of = {texts[i]: k for k, (_, members) in enumerate(classes) for i in members}
    kinds: dict[str, set[int]] = {}
    for r in rows:
        kinds.setdefault(r.dataset, set()).add(of[r.schema])
    groups: list[tuple[StructType, list[str]]] = [(schema, []) for schema, _ in classes]
    for dataset, found in kinds.items():
        if len(found) == 1:
            groups[min(found)][1].append(dataset)
    mixed = [d for d, found in kinds.items() if len(found) > 1]
    if mixed:
        for r in sorted(footer_catalogue(spark, mixed).select("path", "schema").collect()):
            groups[of[r.schema]][1].append(r.path)
    return [g for g in groups if g[1]]
