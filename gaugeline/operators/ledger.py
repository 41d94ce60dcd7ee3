"""File states as an append-only event log, and the tables derived from it.

There is no update in place: an upsert is one more event, a deletion is a tombstone, and the current state of a file
is its latest event. All functions take and return whole DataFrames.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from gaugeline.functions.text import basename
from gaugeline.schemas import COMPLETED, LEDGER_EVENT, PROCESSED_FILES, STATUSES, check_status

KEY = ["file_path", "source_zip"]
_ORDER = ["event_ts", "seq", "full_path", "file_hash"]


def status_events(
    files: DataFrame,
    status: str,
    event_ts: dt.datetime | Column | None = None,
    ingest_id: str | None = None,
    seq: int = 0,
    ledger_key: str = "name",
) -> DataFrame:
    """Events that put every file of ``files`` (``path, source_zip, file_hash`` and optionally ``reason``) in a state."""
    check_status(status)
    return _events(files, F.lit(status), event_ts, ingest_id, seq, ledger_key, tombstone=False)


def removal_events(
    files: DataFrame, event_ts: dt.datetime | Column | None = None, seq: int = 0, ledger_key: str = "name"
) -> DataFrame:
    """Tombstones: the files leave the ledger."""
    return _events(files, F.lit(COMPLETED), event_ts, None, seq, ledger_key, tombstone=True)


def _events(files, status, event_ts, ingest_id, seq, ledger_key, tombstone) -> DataFrame:
    when = F.current_timestamp() if event_ts is None else event_ts if isinstance(event_ts, Column) else F.lit(event_ts)
    path = F.col("path")
    return files.select(
        (path if ledger_key == "path" else basename(path)).alias("file_path"),
        F.coalesce("source_zip", F.lit("")).alias("source_zip"),
        (F.coalesce("file_hash", F.lit("")) if "file_hash" in files.columns else F.lit("")).alias("file_hash"),
        status.alias("status"),
        (F.col("reason") if "reason" in files.columns else F.lit(None)).cast("string").alias("reason"),
        F.lit(ingest_id).cast("string").alias("ingest_id"),
        path.alias("full_path"),
        when.cast("timestamp").alias("event_ts"),
        F.lit(seq).cast("long").alias("seq"),
        F.lit(tombstone).alias("is_tombstone"),
    ).select(*LEDGER_EVENT.fieldNames())


def latest_events(events: DataFrame) -> DataFrame:
    """The last event of every key. Partial maxima are taken before the shuffle, so a busy key stays cheap."""
    rest = [c for c in events.columns if c not in KEY]
    order = [c for c in _ORDER if c in rest]
    return (
        events.groupBy(*KEY)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("last"))
        .select(*KEY, *[F.col(f"last.{c}").alias(c) for c in rest])
    )


def processed_files(events: DataFrame) -> DataFrame:
    """Current state per file, removed files left out."""
    return (
        latest_events(events)
        .where(~F.col("is_tombstone"))
        .withColumns({"processed_date": F.col("event_ts"), "status_updated_at": F.col("event_ts")})
        .select(*PROCESSED_FILES.fieldNames())
    )


def file_status(files: DataFrame, processed: DataFrame, ledger_key: str = "name") -> DataFrame:
    """State of each given file; null when the ledger does not know it or holds an unknown value."""
    known = processed.where(F.col("status").isin(*STATUSES)).select(*KEY, "status")
    asked = files.withColumn("file_path", F.col("path") if ledger_key == "path" else basename(F.col("path")))
    return asked.join(known, KEY, "left").select(*files.columns, "status")


def ledger_counts(processed: DataFrame) -> DataFrame:
    return processed.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"))


def merge_ledgers(main: DataFrame, other: DataFrame) -> DataFrame:
    """Insert-or-replace of ``other`` into ``main``, both in the six-column form: ``other`` wins on equal keys."""
    columns = PROCESSED_FILES.fieldNames()
    rest = [c for c in columns if c not in KEY]
    both = main.select(*columns, F.lit(0).alias("side")).unionByName(other.select(*columns, F.lit(1).alias("side")))
    return (
        both.groupBy(*KEY)
        .agg(F.max_by(F.struct(*rest), F.struct("side", "status_updated_at", "file_hash")).alias("last"))
        .select(*KEY, *[F.col(f"last.{c}").alias(c) for c in rest])
        .select(*columns)
    )
