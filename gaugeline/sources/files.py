"""Loose files: listing without reading bytes, and the bytes of named paths."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeline.functions.text import basename
from gaugeline.schemas import LISTING
from gaugeline.sources import opened


def find_csv_files(spark: SparkSession, folder: str, pattern: str, work: str | None = None) -> DataFrame:
    """CSV files anywhere below a folder whose basename contains a match of the (Python) regular expression."""
    if not pattern:
        raise ValueError("a search pattern is required")
    return as_listing(opened.walk(spark, folder, opened.named((".csv",), pattern), work))


def listing_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A listing from paths the caller names. A path that is not there is kept, with an error."""
    named = spark.createDataFrame([(opened.qualified(spark, p),) for p in paths], "path string")
    return opened.stat(named).select(*LISTING.fieldNames())


def match_names(files: DataFrame, pattern: str, column: str = "path") -> DataFrame:
    return files.where(F.rlike(basename(F.col(column)), F.lit(pattern)))


def as_listing(files: DataFrame) -> DataFrame:
    error = F.col("error") if "error" in files.columns else F.lit(None).cast("string")
    return files.select("path", F.lit("").alias("source_zip"), "length", error.alias("error"))


def find_files_with_extension(spark: SparkSession, folder: str, extension: str) -> DataFrame:
    dotted = extension if extension.startswith(".") else "." + extension
    return opened.walk(spark, folder, opened.named((dotted,))).where(F.col("error").isNull()).select("path", "length")


def escape_glob(path: str) -> str:
    """Paths are taken literally by Spark's readers once their glob characters are escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def loose_work(files: DataFrame) -> DataFrame:
    """A work list of loose files (``path, length``)."""
    none = {"offset": "bigint", "packed": "bigint", "method": "int", "crc": "bigint"}
    return files.select("path", F.lit("").alias("source_zip"), "length", *[F.lit(None).cast(kind).alias(name) for name, kind in none.items()])


def read_contents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, source_zip, length, content, error`` of named files."""
    return opened.contents(loose_work(listing_of(spark, paths)))


def union_listings(loose: DataFrame, archived: DataFrame) -> DataFrame:
    return loose.select(*LISTING.fieldNames()).unionByName(archived.select(*LISTING.fieldNames()))
