"""The readings table: one directory per batch, visible once the batch is committed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from gaugeline.schemas import READING_COLUMNS
from gaugeline.session import empty, path_exists


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or no rows while nothing has been written."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else empty(spark, schema)


def write_batch(readings: DataFrame, table: str, ingest_id: str, mode: str = "overwrite") -> int:
    """Write readings of one batch and return their number, counted by the same job.

    The batch directory is addressed directly: a ``partitionBy`` on the constant id would sort all rows for nothing.
    """
    seen = Observation()
    counted = readings.select(*READING_COLUMNS).observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.mode(mode).parquet(f"{table}/ingest_id={ingest_id}")
    return seen.get["n"]


def rows_per_file(readings: DataFrame) -> DataFrame:
    return readings.groupBy("source_file", "source_zip").agg(F.count(F.lit(1)).alias("n_rows"))
