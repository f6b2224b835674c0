"""Dimension tables: CSV reader and built-in code tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from farelane import spec
from farelane.operators.dedup import duplicate_keys

CSV_SCHEMAS = {
    "payment_type": StructType([StructField("payment_type", IntegerType()),
                                StructField("payment_type_desc", StringType())]),
    "ratecode": StructType([StructField("RatecodeID", IntegerType()),
                            StructField("RatecodeDesc", StringType())]),
    "trip_type": StructType([StructField("trip_type", IntegerType()),
                             StructField("trip_type_desc", StringType())]),
    "taxi_zone": StructType([StructField("LocationID", IntegerType()),
                             StructField("Borough", StringType()),
                             StructField("Zone", StringType()),
                             StructField("service_zone", StringType())]),
}


def read_csv_dim(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Header CSV with an explicit schema.  Blanks around values are removed
    (files put a blank after each comma), extra trailing tokens are ignored
    (PERMISSIVE), and strings such as ``NA`` / ``N/A`` stay strings."""
    df = (spark.read.schema(schema)
          .option("header", True)
          .option("ignoreLeadingWhiteSpace", True)
          .option("ignoreTrailingWhiteSpace", True)
          .option("mode", "PERMISSIVE")
          .option("escape", '"')
          .csv(path))
    return df.select(*[F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType)
                       else F.col(f.name) for f in df.schema.fields])


def read_lookup_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four lookup tables of a folder: payment_type, ratecode, trip_type, taxi_zone."""
    folder = folder.rstrip("/")
    return {name: read_csv_dim(spark, f"{folder}/{name}.csv", schema)
            for name, schema in CSV_SCHEMAS.items()}


def read_csv_checked(spark: SparkSession, path: str, schema: StructType | str, key: str) -> DataFrame:
    """As :func:`read_csv_dim`, and beside the columns each row's ``line`` and
    ``reason``: NULL for a sound row, else the first of ``unclosed quote``,
    ``too few fields``, ``too many fields`` (blank ones behind the last do not
    count), ``bad <column>`` (text that the type refuses) and ``no key``.
    Header and blank lines are no rows."""
    fields = (schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema).fields
    n, names = len(fields), [f.name for f in fields]
    lines = spark.read.text(path).select(F.rtrim(F.regexp_replace("value", "\r$", "")).alias("line")).where("line <> ''")
    bare = F.regexp_replace("line", '"([^"]|"")*"', "q")  # sound quoted fields
    lines = lines.where(F.regexp_replace(F.lower("line"), '[\\s"]', "").rlike("^" + ",".join(x.lower() for x in names) + ",*$") == F.lit(False))
    split = F.split(bare, ",", -1)
    text = F.from_csv("line", ", ".join(f"`{x}` string" for x in names),
                      {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "escape": '"', "mode": "PERMISSIVE"})
    raw = lines.withColumns({"_text": text, "_fields": split, "_open": F.contains(bare, F.lit('"'))})
    value = {f.name: F.trim(F.col(f"_text.{f.name}")) for f in fields}
    typed = {f.name: value[f.name] if isinstance(f.dataType, StringType) else value[f.name].try_cast(f.dataType) for f in fields}
    beyond = F.exists(F.slice("_fields", n + 1, F.greatest(F.size("_fields") - n, F.lit(0))), lambda x: F.trim(x) != "")
    reason = F.when(F.col("_open"), "unclosed quote").when(F.size("_fields") < n, "too few fields").when(beyond, "too many fields")
    for f in fields:
        reason = reason.when((value[f.name] != "") & typed[f.name].isNull(), f"bad {f.name}")
    reason = reason.when(typed[key].isNull(), "no key")
    return raw.select(*[typed[x].alias(x) for x in names], "line", reason.alias("reason"))


def doubled_keys(dim: DataFrame, key: str) -> DataFrame:
    """Lookup keys that occur more than once: each would multiply the facts
    that a left join matches with it."""
    return duplicate_keys(dim.where(F.col(key).isNotNull()), [key])


LOOKUP_KEYS = {"payment_type": "payment_type", "ratecode": "RatecodeID", "trip_type": "trip_type", "taxi_zone": "LocationID"}


def check_lookup_folder(spark: SparkSession, folder: str) -> list[tuple[str, str, int]]:
    """(table, finding, rows) of the four lookup files: rejected lines by
    reason, and doubled keys.  Empty if all are sound; one row a finding."""
    found: list[tuple[str, str, int]] = []
    for name, schema in CSV_SCHEMAS.items():
        rows = read_csv_checked(spark, f"{folder.rstrip('/')}/{name}.csv", schema, LOOKUP_KEYS[name])
        reasons = rows.where("reason IS NOT NULL").groupBy("reason").count().collect()
        found += sorted((name, r["reason"], r["count"]) for r in reasons)
        doubled = doubled_keys(rows.where("reason IS NULL"), LOOKUP_KEYS[name]).count()
        found += [(name, "doubled key", doubled)] if doubled else []
    return found


def code_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """The three small code dimensions from their fixed values.

    Built from Arrow, so each is a local relation whose size the planner
    knows: joins broadcast it at planning and never shuffle the facts on a
    code of a few values (a frame made from a list has no known size)."""
    def local(name: str, rows) -> DataFrame:
        schema = CSV_SCHEMAS[name]
        columns = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(zip(*rows), schema)]
        return spark.createDataFrame(pa.Table.from_arrays(columns, names=schema.names), schema)
    return {name: local(name, rows) for name, rows in (
        ("payment_type", spec.PAYMENT_TYPES), ("ratecode", spec.RATECODES), ("trip_type", spec.TRIP_TYPES))}


def zone_from_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension played by nation + region: key n_nationkey,
    Borough = region name, Zone = nation name, service_zone = 'Region <k>'."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
                  .select(F.col("n_nationkey").alias("LocationID"),
                          F.col("r_name").alias("Borough"),
                          F.col("n_name").alias("Zone"),
                          F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")).alias("service_zone")))


def write_lookup_csv(df: DataFrame, path: str, quote_strings: bool = True, trailing_sep: bool = True,
                     line_sep: str = "\r\n") -> str:
    """Write a frame as lookup CSV files in the hand-edited style: a header
    line in every file, a blank after every comma, optionally quoted strings
    and a trailing comma, CRLF line ends.

    Lines are rendered by Spark expressions and written by the CSV writer
    (one file per partition, each with its header), with separator and quote
    characters that never occur in the text, so each line is written as is.
    """
    def render(f):  # NULL is an empty field; a quote inside a value is doubled
        v = F.col(f.name).cast("string")
        if quote_strings and isinstance(f.dataType, StringType):
            v = F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.coalesce(v, F.lit(""))
    body = F.concat_ws(", ", *[render(f) for f in df.schema.fields])
    if trailing_sep:
        body = F.concat(body, F.lit(","))
    (df.select(body.alias(", ".join(df.columns))).write.mode("overwrite")
       .option("header", True).option("sep", "\u0001").option("quote", "\u0002")
       .option("lineSep", line_sep).csv(path))
    return path
