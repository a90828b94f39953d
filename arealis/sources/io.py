"""Readers and the table writer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.functions.recode import nan_to_null, pad_code

VERTEX = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return df.select(*columns) if columns else df


def read_survey(spark: SparkSession, path: str, columns: Sequence[str] | None = None, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Person microdata with NaN turned into null."""
    return nan_to_null(read_table(spark, path, columns, fmt, schema, **options))


def read_census(
    spark: SparkSession, path: str, min_age: float | None = None, status: Sequence[object] | None = None, columns: Sequence[str] | None = None, age_column: str = "edad", status_column: str = "condact3"
) -> DataFrame:
    """Census rows or cells above an age and of some activity states; the universe filters reach the scan."""
    df = read_table(spark, path)
    if min_age is not None:
        df = df.filter(F.col(age_column) > min_age)
    if status is not None:
        df = df.filter(F.col(status_column).isin(*status))
    return df.select(*columns) if columns else df


def read_covariates(spark: SparkSession, path: str, key: str | None = None, width: int | None = None) -> DataFrame:
    df = nan_to_null(read_table(spark, path))
    return df.withColumn(key, pad_code(key, width)) if key and width else df


def read_zones(spark: SparkSession, path: str, region_column: str | None = None, region: str | None = None, code: str | None = None, width: int | None = None) -> DataFrame:
    """Polygon attributes and vertices of one region, area code padded."""
    df = read_table(spark, path)
    if region_column:
        df = df.filter(F.col(region_column) == region)
    return df.withColumn(code, pad_code(code, width)) if code and width else df


def read_pixels(spark: SparkSession, path: str, start: str, end: str, bands: Sequence[str], date: str = "date", band: str = "band", columns: Sequence[str] | None = None) -> DataFrame:
    """Pixel samples of a stored collection in the half-open window [start, end) and the wanted bands."""
    kept = pixels_between(read_table(spark, path), start, end, bands, date, band)
    return kept.select(*columns) if columns else kept


def pixels_between(pixels: DataFrame, start: str, end: str, bands: Sequence[str], date: str = "date", band: str = "band") -> DataFrame:
    """Pixel samples of a table in the half-open window [start, end) and the wanted bands."""
    return pixels.filter((F.col(date) >= F.lit(start).cast("timestamp")) & (F.col(date) < F.lit(end).cast("timestamp")) & F.col(band).isin(*bands))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", fmt: str = "parquet") -> str:
    """Write a stage output.  Partition only by a column with few values."""
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "overwrite", path: str | None = None) -> str:
    """Save a table bucketed and sorted by its join key, so later joins on the key need no shuffle."""
    writer = df.write.mode(mode).bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return table
