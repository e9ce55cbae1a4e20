"""Raw match files: header check, all-text scan and typed scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

from ..files import Files
from ..schemas import RAW_COLUMNS, RAW_SCHEMA


def missing_columns(columns: list[str]) -> list[str]:
    """Required raw columns absent from a header; order and extra names do not matter."""
    present = set(columns)
    return [c for c in RAW_COLUMNS if c not in present]


def _header(reader: DataFrameReader, path: str) -> list[str]:
    """Column names of the first file; only its first line is read."""
    columns = reader.csv(path).columns
    missing = missing_columns(columns)
    if missing:
        raise ValueError(f"{path} lacks the required columns {', '.join(missing)}")
    return columns


def header(spark: SparkSession, path: str, **options) -> list[str]:
    """Column names as the first file has them."""
    return spark.read.options(header=True, **options).csv(path).columns


def _read(spark: SparkSession, path: str, types: dict[str, str], options: dict) -> DataFrame:
    """The 22 required columns, matched to the file by header name.

    The schema lists the names in the file's own order, so columns may come in any
    order and unknown ones are skipped. ``enforceSchema=False`` makes Spark compare
    every file's header with it and raise on a difference, where the default would
    silently shift the columns. A short line gives nulls, an unreadable number too.
    """
    if not Files(spark).exists(path):
        raise FileNotFoundError(f"no raw matches at {path}")
    reader = spark.read.options(header=True, enforceSchema=False, **options)
    schema = T.StructType(
        [T.StructField(c, types.get(c, T.StringType())) for c in _header(reader, path)]
    )
    return reader.schema(schema).csv(path).select(*RAW_COLUMNS)


def read_raw_text(spark: SparkSession, path: str, **options) -> DataFrame:
    """Raw matches as they stand in the file, every column as text."""
    return _read(spark, path, {}, options)


def read_raw(spark: SparkSession, path: str, **options) -> DataFrame:
    """Raw matches with numbers parsed by the scan; the date stays text."""
    return _read(spark, path, {f.name: f.dataType for f in RAW_SCHEMA}, options)
