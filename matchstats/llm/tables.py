"""Tables, shared folders and schemas of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchstats.session import scratch_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame, computed once and kept as Parquet in the shared folder.

    Later steps read files that outlive executors, so nothing is computed twice and no
    lineage grows.
    """
    path = scratch_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def with_fields(frame: DataFrame, **added: T.DataType) -> T.StructType:
    """The frame's schema with further fields."""
    return T.StructType([*frame.schema.fields, *(T.StructField(n, t) for n, t in added.items())])


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn labels from: checksum of the id's text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def free_name(frame: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores, so that no column of the frame is hidden."""
    taken = {name.lower() for name in frame.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
