"""Landing files: write feeds as CSV, JSON or Parquet, and infer a feed's schema once."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import DecimalType, IntegralType, StructField, StructType, TimestampType

from shelfline.sources import tables

# Holds every whole number that is inferred, and fractions.
ANY_NUMBER = DecimalType(38, 10)

# Settings per format for reading a feed's types; sub-folders of a feed belong to the feed.
READ_OPTIONS = {
    "csv": {"header": "true", "escape": '"', "recursiveFileLookup": "true"},
    "json": {"recursiveFileLookup": "true"},
    "parquet": {"recursiveFileLookup": "true"},
}

# Text feeds land compressed. A file is then one task's, so it holds a bounded number of rows.
TEXT_FILES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "1000000"}


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**TEXT_FILES).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**TEXT_FILES).option("header", True).option("escape", '"').csv(path)


def split_arrivals(df: DataFrame, key: Column, cut) -> tuple[DataFrame, DataFrame]:
    """The rows up to a key and the rows after it, as two arrival batches."""
    return df.filter(key <= cut), df.filter(key > cut)


def infer_schema(spark: SparkSession, path: str, fmt: str, sampling_ratio: float = 1.0) -> StructType:
    """Column names and types found in the files (a Parquet footer already holds them).

    CSV files may differ in their headers, so the first of them tells.
    """
    reader = spark.read.format(fmt).options(**READ_OPTIONS[fmt])
    if fmt == "csv":
        path = min(spark.read.options(recursiveFileLookup="true").text(path).inputFiles(), default=path)
    if fmt == "csv":
        reader = reader.option("inferSchema", True)
    if fmt != "parquet":
        reader = reader.option("samplingRatio", sampling_ratio)
    return reader.load(path).schema


def lasting_schema(found: StructType, declared: StructType, fmt: str) -> StructType:
    """A schema inferred from a first delivery, made fit for later ones.

    Known columns take their declared type; only times that were found stay times, and a later record whose time cannot
    be read in any spelling keeps its text in the corrupt-record column. Whole numbers of other columns become decimals, as a
    later delivery may bring a fraction. Known columns that the first delivery lacks are added. A Parquet file holds
    its types, so nothing is changed there.
    """
    if fmt == "parquet":
        return found
    known = {field.name: field for field in declared.fields}

    def lasting(field: StructField) -> StructField:
        if field.name in known and not isinstance(field.dataType, TimestampType):
            return known[field.name]
        return StructField(field.name, ANY_NUMBER if isinstance(field.dataType, IntegralType) else field.dataType)

    missing = [field for field in declared.fields if field.name not in found.names]
    return StructType([*map(lasting, found.fields), *missing])


def remembered_schema(
    spark: SparkSession,
    store: str,
    path: str,
    fmt: str,
    sampling_ratio: float = 1.0,
    declared: StructType | None = None,
) -> StructType:
    """The schema inferred when the feed was first read, kept at ``store`` and used ever after.

    ``declared`` names the columns that are known before, see :func:`lasting_schema`.
    """
    if tables.exists(spark, f"{store}/{tables.READY}"):
        return StructType.fromJson(json.loads(spark.read.text(store, wholetext=True).head()[0]))
    schema = infer_schema(spark, path, fmt, sampling_ratio)
    if declared is not None:
        schema = lasting_schema(schema, declared, fmt)
    spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").text(store)
    tables.mark(spark, store)
    return schema
