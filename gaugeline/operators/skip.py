"""Which files are new: joins of a file list with the ledger, in-batch duplicates, and run statistics.

Nothing here is broadcast by hint. Both sides are one narrow row per file, the ledger side is reduced to one row per
key first, and a key shared by very many files (one basename, one content) is split by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugeline.functions.text import basename
from gaugeline.schemas import COMPLETED, STAT_COLUMNS, TIMEOUT

BY_NAME = "already_processed_by_path"
BY_HASH = "already_processed_by_hash"
PROCESS = "newly_processed"
FAILED_OUTCOME = "failed"
TIMEOUT_OUTCOME = "timeout"


def completed_names(processed: DataFrame) -> DataFrame:
    return processed.where(F.col("status") == COMPLETED).select("file_path", "source_zip").distinct()


def completed_hashes(processed: DataFrame) -> DataFrame:
    return processed.where(F.col("status") == COMPLETED).select("file_hash").distinct()


def _named(files: DataFrame, ledger_key: str = "name") -> DataFrame:
    return files.withColumn("file_path", F.col("path") if ledger_key == "path" else basename(F.col("path")))


def skip_by_name(files: DataFrame, processed: DataFrame, ledger_key: str = "name") -> DataFrame:
    """Files whose ``(basename, source_zip)`` is not completed yet."""
    return (
        _named(files, ledger_key)
        .join(completed_names(processed), ["file_path", "source_zip"], "left_anti")
        .select(*files.columns)
    )


def skip_by_hash(files: DataFrame, processed: DataFrame) -> DataFrame:
    """Files whose content hash is not completed yet."""
    return files.join(completed_hashes(processed), "file_hash", "left_anti").select(*files.columns)


def flag_by_name(files: DataFrame, processed: DataFrame, ledger_key: str = "name") -> DataFrame:
    done = completed_names(processed).withColumn("by_name", F.lit(True))
    return (
        _named(files, ledger_key)
        .join(done, ["file_path", "source_zip"], "left")
        .select(*files.columns, F.coalesce("by_name", F.lit(False)).alias("by_name"))
    )


def flag_by_hash(files: DataFrame, processed: DataFrame) -> DataFrame:
    done = completed_hashes(processed).withColumn("by_hash", F.lit(True))
    return files.join(done, "file_hash", "left").select(
        *files.columns, F.coalesce("by_hash", F.lit(False)).alias("by_hash")
    )


def batch_winners(files: DataFrame) -> DataFrame:
    """The first file by path (then archive) of every content hash.

    A minimum with map-side partial results: copies of one content are never gathered in a window or a list.
    """
    first = files.groupBy("file_hash").agg(F.min(F.struct("path", "source_zip")).alias("first"))
    return first.select("file_hash", "first.path", "first.source_zip")


def batch_dedup(files: DataFrame) -> DataFrame:
    """Keep one file per content hash. The join back is on the file itself, so many copies make no hot key."""
    return files.join(batch_winners(files).select("path", "source_zip"), ["path", "source_zip"], "left_semi").select(
        *files.columns
    )


def classify_files(files: DataFrame, processed: DataFrame, ledger_key: str = "name") -> DataFrame:
    """``outcome`` of every file: known by name, else known by content, else to be processed."""
    flagged = flag_by_hash(flag_by_name(files, processed, ledger_key), processed)
    return flagged.select(
        *files.columns,
        F.when(F.col("by_name"), BY_NAME).when(F.col("by_hash"), BY_HASH).otherwise(PROCESS).alias("outcome"),
    )


def run_stats(classified: DataFrame) -> DataFrame:
    """One row of counts over a table with an ``outcome`` per file."""
    outcome = F.col("outcome")
    return classified.agg(
        F.count(F.lit(1)).alias(STAT_COLUMNS[0]),
        *[
            F.count_if(outcome == name).alias(column)
            for column, name in zip(STAT_COLUMNS[1:], (BY_NAME, BY_HASH, PROCESS, FAILED_OUTCOME, TIMEOUT_OUTCOME))
        ],
    )


def timed_out(files: DataFrame, processed: DataFrame, ledger_key: str = "name") -> DataFrame:
    """Files whose current state is TIMEOUT; they are taken up again by the next run."""
    keys = processed.where(F.col("status") == TIMEOUT).select("file_path", "source_zip")
    return (
        _named(files, ledger_key).join(keys, ["file_path", "source_zip"], "left_semi").select(*files.columns)
    )
