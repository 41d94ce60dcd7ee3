"""A lake: the folder that holds readings, ledger and commits, and the operations on them."""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from gaugeline.functions.text import scrub_control_chars, scrub_text
from gaugeline.operators import ledger as ledger_ops
from gaugeline.operators.sinks import read_or_empty, write_batch
from gaugeline.operators.skip import completed_hashes
from gaugeline.schemas import (
    COMMITS,
    COMPLETED,
    FAILED,
    IN_PROGRESS,
    LEDGER_EVENT,
    READING_COLUMNS,
    STAT_COLUMNS,
    STORED_READINGS,
    TIMEOUT,
)
from gaugeline.session import configure, delete_path, list_names, path_exists, put_if_absent, read_text


class CommitConflict(RuntimeError):
    """Another batch was committed since this one read the ledger: what it decided may no longer hold."""


#: Log entries as Spark reads them.
_LOG = "version bigint, kind string, ledger string, before string, ingest_id string, committed_us bigint, listing string, " + ", ".join(f"{c} bigint" for c in STAT_COLUMNS)


class Lake:
    """Readings, ledger and log below ``root``.

    The log is a folder of numbered entries, each put under a number that wasn't taken. Every change takes the next number, so
    changes have one order, whoever makes them:

    * ``commit`` makes a batch visible. Readings of a batch without one are not read and its COMPLETED events do not count, so a
      run that dies half-way leaves nothing behind that a later run sees. A commit is refused if another batch was committed
      since this one read the ledger; ``ingest_files`` then decides anew.
    * ``events`` tells that events were added to the ledger.
    * ``compact`` puts a rewritten ledger and list of commits in the place of the old ones. Until its entry stands the old ones
      count. Events that were added to a ledger while it was replaced are added again to the new one.
    """

    def __init__(self, spark: SparkSession, root: str, ledger_key: str = "name") -> None:
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.ledger_key = ledger_key

    @property
    def readings_path(self) -> str:
        return f"{self.root}/readings"

    @property
    def log_path(self) -> str:
        return f"{self.root}/log"

    def ledger_path(self, ledger: str) -> str:
        return f"{self.root}/ledger/{ledger}"

    # --- log -------------------------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in list_names(self.spark, self.log_path) if n.endswith(".json") and not n.startswith("."))

    def entry(self, version: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.log_path}/{version:020d}.json"))

    def state(self) -> tuple[int, str, str | None]:
        """The last version, the ledger that counts, and the one before it."""
        versions = self.versions()
        last = self.entry(versions[-1]) if versions else {"ledger": "0", "before": None}
        return (versions[-1] if versions else 0), last["ledger"], last["before"]

    def _put(self, version: int, kind: str, ledger: str, before: str | None, **values) -> bool:
        text = json.dumps({"version": version, "kind": kind, "ledger": ledger, "before": before, **values})
        return put_if_absent(self.spark, f"{self.log_path}/{version:020d}.json", text)

    def work_path(self, ingest_id: str, name: str) -> str:
        return f"{self.root}/work/{ingest_id}/{name}"

    # --- reading ---------------------------------------------------------------------------------------------

    def commits(self) -> DataFrame:
        """Commits of the last compaction, and the log's entries since."""
        _, ledger, _ = self.state()
        old = read_or_empty(self.spark, f"{self.log_path}/{ledger}", COMMITS)
        if not path_exists(self.spark, self.log_path):
            return old
        entries = self.spark.read.schema(_LOG).json(f"{self.log_path}/*.json")
        new = entries.where((F.col("kind") == "commit") & (F.col("ledger") == ledger)).withColumn("committed_at", F.timestamp_micros("committed_us"))
        return old.unionByName(new.select(*COMMITS.fieldNames()))

    def commit_of(self, ingest_id: str) -> Row | None:
        return self.commits().where(F.col("ingest_id") == ingest_id).first()

    def _published(self) -> DataFrame:
        return self.commits().select("ingest_id").distinct()

    def readings(self, latest_only: bool = False) -> DataFrame:
        """Readings of committed batches, by a join with the commits: no list of batches is held on the driver.

        ``latest_only`` keeps, per file, only its newest completed batch, for files ingested again on purpose.
        """
        stored = read_or_empty(self.spark, self.readings_path, STORED_READINGS)
        visible = stored.join(self._published(), "ingest_id", "left_semi")
        if latest_only:
            done = self.events().where((F.col("status") == COMPLETED) & ~F.col("is_tombstone"))
            newest = (
                done.groupBy(scrub_text(F.col("full_path")).alias("source_file"), scrub_text(F.col("source_zip")).alias("source_zip"))
                .agg(F.max_by("ingest_id", F.struct("event_ts", "seq")).alias("ingest_id"))
            )
            visible = visible.join(newest, ["source_file", "source_zip", "ingest_id"], "left_semi")
        return visible.select(*READING_COLUMNS)

    def events(self, settled: bool = False) -> DataFrame:
        """Ledger events that count: all but the completions of batches that were not committed.

        ``settled`` leaves out everything that such batches wrote, so that a run which died changes no decision.
        """
        events = read_or_empty(self.spark, self.ledger_path(self.state()[1]), LEDGER_EVENT)
        flagged = events.join(self._published().withColumn("published", F.lit(True)), "ingest_id", "left")
        counts = F.col("ingest_id").isNull() | F.col("published").isNotNull()
        if not settled:
            counts = counts | (F.col("status") != COMPLETED)
        return flagged.where(counts).select(*LEDGER_EVENT.fieldNames())

    def processed_files(self, settled: bool = False) -> DataFrame:
        return ledger_ops.processed_files(self.events(settled))

    def execute(self, query: str, params: list | dict | None = None) -> DataFrame:
        """Run SQL over the views ``sensor_data`` and ``processed_files``; ``?`` or ``:name`` mark parameters."""
        self.readings().createOrReplaceTempView("sensor_data")
        self.processed_files().createOrReplaceTempView("processed_files")
        return self.spark.sql(query, args=params) if params else self.spark.sql(query)

    # --- ledger ----------------------------------------------------------------------------------------------

    def append_events(self, events: DataFrame) -> None:
        """Add events to the ledger that counts. If it is replaced meanwhile they are added to the next one, too."""
        _, written, _ = self.state()
        events.write.mode("append").parquet(self.ledger_path(written))
        while True:
            version, ledger, before = self.state()
            if ledger != written:
                events.write.mode("append").parquet(self.ledger_path(ledger))
                written = ledger
            elif self._put(version + 1, "events", ledger, before):
                return

    def append_status(self, files: DataFrame, status: str, ingest_id: str | None = None, seq: int = 0) -> None:
        """Put all files of a DataFrame in a state with one write."""
        now = dt.datetime.now(dt.timezone.utc)
        self.append_events(ledger_ops.status_events(files, status, now, ingest_id, seq, self.ledger_key))

    def remove(self, files: DataFrame) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        self.append_events(ledger_ops.removal_events(files, now, ledger_key=self.ledger_key))

    def commit(self, ingest_id: str, listing: str | None = None, stats: Mapping[str, int] | None = None, since: int | None = None) -> None:
        """Make a batch visible. ``since`` is the version at which it read the ledger: later commits of others are a conflict."""
        counts = {name: (stats or {}).get(name) for name in STAT_COLUMNS}
        checked = since
        while True:
            version, ledger, before = self.state()
            if since is not None:
                for number in self.versions():
                    if number > checked and self.entry(number)["kind"] == "commit":
                        raise CommitConflict(f"batch {ingest_id}: version {number} was committed after version {since}")
                checked = version
            now = time.time_ns() // 1000
            if self._put(version + 1, "commit", ledger, before, ingest_id=ingest_id, committed_us=now, listing=listing, **counts):
                return

    def clear_batch(self, ingest_id: str) -> None:
        """Empty the readings of a batch that was not committed."""
        delete_path(self.spark, f"{self.readings_path}/ingest_id={ingest_id}")

    def clear_work(self, ingest_id: str) -> None:
        delete_path(self.spark, f"{self.root}/work/{ingest_id}")

    def compact(self) -> None:
        """Rewrite ledger and commits, which grow by a few small files with every batch, as few files under a new version.

        Others may read and write meanwhile. Whatever happens before the last step leaves the lake as it was. Of what was
        replaced, the last ledger stays for those who still read it; older ones and their log entries go.
        """
        while True:
            version, ledger, before = self.state()
            if not version:
                return
            new = uuid.uuid4().hex
            for rows, path in (
                (read_or_empty(self.spark, self.ledger_path(ledger), LEDGER_EVENT), self.ledger_path(new)),
                (self.commits(), f"{self.log_path}/{new}"),
            ):
                rows.coalesce(max(1, len(rows._jdf.inputFiles()) // 1000)).write.mode("overwrite").parquet(path)
            if self._put(version + 1, "compact", new, ledger):
                break
            delete_path(self.spark, self.ledger_path(new))
            delete_path(self.spark, f"{self.log_path}/{new}")
        for old in set(list_names(self.spark, f"{self.root}/ledger")) - {new, ledger}:
            if old == before:
                delete_path(self.spark, self.ledger_path(old))
                delete_path(self.spark, f"{self.log_path}/{old}")
        for number in self.versions():
            if number <= version and self.entry(number)["ledger"] == before:
                delete_path(self.spark, f"{self.log_path}/{number:020d}.json")

    def rollback(self, ingest_id: str) -> None:
        """Give up a batch. Nothing of it is visible before ``commit``; its folders are emptied."""
        if self.commit_of(ingest_id) is not None:
            raise ValueError(f"batch {ingest_id} is committed")
        self.clear_batch(ingest_id)
        self.clear_work(ingest_id)

    # --- one file at a time, for interactive use ---------------------------------------------------------------

    def _one(self, path: str, source_zip: str | None, file_hash: str = "") -> DataFrame:
        values = {"path": str(path), "source_zip": str(source_zip or ""), "file_hash": file_hash}
        return self.spark.range(1).select(*[F.lit(value).alias(name) for name, value in values.items()])

    def update_file_status(self, path: str, file_hash: str, source_zip: str | None, status: str) -> bool:
        self.append_status(self._one(path, source_zip, file_hash), status)
        return True

    def mark_file_as_in_progress(self, path: str, file_hash: str, source_zip: str | None = None) -> bool:
        return self.update_file_status(path, file_hash, source_zip, IN_PROGRESS)

    def mark_file_as_completed(self, path: str, file_hash: str, source_zip: str | None = None) -> bool:
        return self.update_file_status(path, file_hash, source_zip, COMPLETED)

    def mark_file_as_failed(self, path: str, file_hash: str, source_zip: str | None = None) -> bool:
        return self.update_file_status(path, file_hash, source_zip, FAILED)

    def mark_file_as_timeout(self, path: str, file_hash: str, source_zip: str | None = None) -> bool:
        return self.update_file_status(path, file_hash, source_zip, TIMEOUT)

    def mark_file_as_processed(self, path: str, file_hash: str, source_zip: str | None = None) -> bool:
        """Older name of ``mark_file_as_completed``."""
        return self.mark_file_as_completed(path, file_hash, source_zip)

    def unmark_file_as_processed(self, path: str, source_zip: str | None = None) -> bool:
        self.remove(self._one(path, source_zip))
        return True

    def get_file_status(self, path: str, source_zip: str | None = None) -> str | None:
        asked = self._one(path, source_zip)
        return ledger_ops.file_status(asked, self.processed_files(), self.ledger_key).first()["status"]

    def is_file_processed_by_path(self, path: str, source_zip: str | None = None) -> bool:
        return self.get_file_status(path, source_zip) == COMPLETED

    def is_file_processed_by_hash(self, file_hash: str) -> bool:
        return not completed_hashes(self.processed_files(settled=True)).where(F.col("file_hash") == file_hash).isEmpty()

    def insert_sensor_data(self, readings: DataFrame | None, ingest_id: str | None = None) -> int:
        """Scrub and append readings in table form as a batch of their own, committed at once. Returns the row count."""
        if readings is None:
            return 0
        batch = ingest_id or f"insert-{uuid.uuid4().hex}"
        rows = write_batch(scrub_control_chars(readings), self.readings_path, batch)
        self.commit(batch)
        return rows
