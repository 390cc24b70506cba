"""Readers for the five sources, with declared schemas.

The operational tables come from files (parquet by default) or from a JDBC
database through reader options; the two lookups are CSV files with a header.
Only the declared columns are selected, so Catalyst prunes everything else at
the scan (``ReadSchema``) or in the JDBC column list.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas


class MissingColumns(ValueError):
    """A source lacks declared columns."""


# Record ids are only compared, never calculated with: text ids stay text.
ID_COLUMNS = ("id", "pfrid")


def conform(df: DataFrame, schema: T.StructType, optional: Collection[str] = ()) -> DataFrame:
    """Project ``df`` onto ``schema``: declared columns in declared order and
    types.  A declared column that the input lacks is an error, unless it is
    ``optional`` (then it is null)."""
    present = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in present and f.name not in optional]
    if missing:
        raise MissingColumns(f"the source has no column {', '.join(missing)} (it has {', '.join(df.columns)})")
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for field in schema.fields:
        src = present.get(field.name.lower())
        value = F.col(f"`{src}`") if src is not None else F.lit(None)
        text_id = field.name in ID_COLUMNS and src is not None and isinstance(types[src], T.StringType)
        cols.append(value.alias(field.name) if text_id else value.cast(field.dataType).alias(field.name))
    return df.select(*cols)


def read_csv_lookup(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row, comma separated, UTF-8, every column text.

    Empty cells become null.  No schema inference: the declared schema is
    applied, and the header only has to carry the declared names.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", ",")
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .csv(path)
    )


def read_aircraft_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Aircraft lookup (registration, serial, model, manufacturer).

    ``lookup_line`` is a sort key, not a count: (file path, start of the block
    in the file, place in the task).  It keeps the line order of one file and
    the path order of several, however Spark packs them into tasks, and so
    decides which of two rows with the same registration wins in the Aircrafts
    dimension.
    """
    line = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    return read_csv_lookup(spark, path, schemas.AIRCRAFT_LOOKUP).withColumn("lookup_line", line)


def read_personnel(spark: SparkSession, path: str) -> DataFrame:
    """Maintenance personnel (reporter id -> airport), all text."""
    return read_csv_lookup(spark, path, schemas.PERSONNEL)


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a partitioned JDBC scan (credentials come from the caller)."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("a partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def read_source(
    spark: SparkSession,
    schema: T.StructType,
    path: str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Any Spark data source projected onto a declared source schema."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    df = reader.load(path) if path is not None else reader.load()
    return conform(df, schema)


def read_flights(spark: SparkSession, path: str | None = None, fmt: str = "parquet", options=None) -> DataFrame:
    return read_source(spark, schemas.FLIGHTS, path, fmt, options)


def read_maintenance(spark: SparkSession, path: str | None = None, fmt: str = "parquet", options=None) -> DataFrame:
    return read_source(spark, schemas.MAINTENANCE, path, fmt, options)


def read_reports(spark: SparkSession, path: str | None = None, fmt: str = "parquet", options=None) -> DataFrame:
    return read_source(spark, schemas.REPORTS, path, fmt, options)
