"""Table schemas, status values and job defaults."""

from __future__ import annotations

from pyspark.sql import types as T

# File states kept in the ledger.
PENDING = "PENDING"
IN_PROGRESS = "IN_PROGRESS"
COMPLETED = "COMPLETED"
FAILED = "FAILED"
TIMEOUT = "TIMEOUT"
STATUSES = (PENDING, IN_PROGRESS, COMPLETED, FAILED, TIMEOUT)

# Job defaults.
DEFAULTS = {
    "folder": "data",
    "pattern": "(Cond|User|test)",
    "encoding": "shift-jis",
    "factory": "AAA",
    "machine_id": "No.1",
    "data_label": "２０２４年点検",
}
META_KEYS = ("factory", "machine_id", "data_label")


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, nullable) for name, dtype, nullable in fields])


_S, _L, _B = T.StringType(), T.LongType(), T.BooleanType()

#: One long-format reading. The column order is part of the contract.
READINGS = _schema(
    ("Time", T.TimestampNTZType(), True),
    ("value", _S, True),
    ("sensor_id", _S, True),
    ("sensor_name", _S, True),
    ("unit", _S, True),
    ("source_file", _S, True),
    ("source_zip", _S, True),
    ("factory", _S, True),
    ("machine_id", _S, True),
    ("data_label", _S, True),
)
READING_COLUMNS = READINGS.fieldNames()

#: What the readings table holds on disk: the contract plus the batch directory.
STORED_READINGS = T.StructType(READINGS.fields + [T.StructField("ingest_id", _S, True)])

#: A discovered file. ``source_zip`` is '' for a loose file, never null.
LISTING = _schema(
    ("path", _S, False),
    ("source_zip", _S, False),
    ("length", _L, True),
    ("error", _S, True),
)

#: What the first pass over a file's bytes learns about it.
PROFILE = _schema(
    ("path", _S, False),
    ("source_zip", _S, False),
    ("length", _L, True),
    ("file_hash", _S, True),
    ("error", _S, True),
    ("repeats", _S, True),
    ("mode", _S, False),
)

#: Append-only ledger: one row per status change (or removal) of a file.
LEDGER_EVENT = _schema(
    ("file_path", _S, False),
    ("source_zip", _S, False),
    ("file_hash", _S, False),
    ("status", _S, False),
    ("reason", _S, True),
    ("ingest_id", _S, True),
    ("full_path", _S, True),
    ("event_ts", T.TimestampType(), False),
    ("seq", _L, False),
    ("is_tombstone", _B, False),
)

#: The six-column table derived from the events.
PROCESSED_FILES = _schema(
    ("file_path", _S, False),
    ("file_hash", _S, False),
    ("source_zip", _S, True),
    ("processed_date", T.TimestampType(), True),
    ("status", _S, False),
    ("status_updated_at", T.TimestampType(), True),
)

STAT_COLUMNS = (
    "total_found",
    "already_processed_by_path",
    "already_processed_by_hash",
    "newly_processed",
    "failed",
    "timeout",
)

#: One row per published batch; its presence is what makes the batch visible. ``listing`` is a hash of the files that the
#: batch was given, the rest its statistics.
COMMITS = _schema(
    ("ingest_id", _S, False),
    ("committed_at", T.TimestampType(), False),
    ("listing", _S, True),
    *[(name, _L, True) for name in STAT_COLUMNS],
)


def check_status(status: str) -> str:
    if status not in STATUSES:
        raise ValueError(f"unknown status {status!r}; expected one of {STATUSES}")
    return status
