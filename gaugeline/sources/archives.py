"""ZIP archives: listed by their directories, entries read from their places; and archives that are columns of bytes already."""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeline.functions.text import basename
from gaugeline.session import shared_dir
from gaugeline.sources import opened

# The functions below travel to the executors with the job, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ENTRY_SCHEMA = "source_zip string, path string, entry_index long, length long, content binary, error string"
_ARROW = pa.schema(
    [
        ("source_zip", pa.string()),
        ("path", pa.string()),
        ("entry_index", pa.int64()),
        ("length", pa.int64()),
        ("content", pa.binary()),
        ("error", pa.string()),
    ]
)
_BATCH_BYTES = 8 << 20


def _to_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _walk(archive: str, data: bytes, wanted, with_content: bool) -> Iterator[tuple]:
    try:
        opened = zipfile.ZipFile(io.BytesIO(data))
    except Exception as e:
        yield archive, None, None, None, None, f"invalid archive: {e}"
        return
    with opened:
        last = {info.filename: i for i, info in enumerate(opened.infolist())}
        for i, info in enumerate(opened.infolist()):
            if info.is_dir() or last[info.filename] != i or not wanted(info.filename):
                continue
            content, error = None, None
            if with_content:
                try:
                    content = opened.read(info)
                except Exception as e:
                    error = f"unreadable archive entry: {e}"
            yield archive, info.filename, i, info.file_size, content, error


def explode_archives(
    archives: DataFrame, pattern: str | None = None, suffix: str = ".csv", with_content: bool = True
) -> DataFrame:
    """Entries of archives given as ``(path, content)``.

    Entry names must end with ``suffix`` and, if given, their basename must contain a match of ``pattern``. An
    invalid archive is one row with ``error`` and no path; an unreadable entry keeps its name and has ``error``.
    """
    regex = re.compile(pattern) if pattern else None

    def wanted(name: str) -> bool:
        return name.endswith(suffix) and (regex is None or regex.search(name.rsplit("/", 1)[-1]) is not None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for archive, data in zip(batch["path"].to_pylist(), batch["content"]):
                for row in _walk(archive, data.as_py(), wanted, with_content):
                    rows.append(row)
                    held += len(row[4] or b"") + 256
                    if held >= _BATCH_BYTES:
                        yield _to_batch(rows)
                        rows, held = [], 0
        if rows:
            yield _to_batch(rows)

    return archives.select("path", "content").mapInArrow(run, ENTRY_SCHEMA)


def find_csv_in_archives(spark: SparkSession, folder: str, pattern: str, work: str | None = None) -> DataFrame:
    """Matching entries of all archives below a folder, from the archives' directories. An archive that can't be opened is a row
    with ``error`` and no ``path``."""
    found = opened.walk(spark, folder, opened.named((".zip",)), work)
    return directories(found.where(F.col("error").isNull()), pattern)


def directories(archives: DataFrame, pattern: str | None = None, suffix: str = ".csv") -> DataFrame:
    """``read_directories`` of many archives, dealt out to as many tasks as they are worth."""
    n = archives.count()
    tasks = max(1, min(n, 4 * archives.sparkSession.sparkContext.defaultParallelism, 100_000))
    return opened.read_directories(archives.repartition(tasks, "path"), pattern, suffix)


def as_listing(entries: DataFrame) -> DataFrame:
    """Entries in the form of a listing. A bad archive stands for itself, with its reason."""
    bad = F.col("path").isNull()
    return entries.select(
        F.when(bad, F.col("source_zip")).otherwise(F.col("path")).alias("path"),
        F.when(bad, "").otherwise(F.col("source_zip")).alias("source_zip"),
        "length",
        "error",
    )


def resolve_entries(requests: DataFrame, entries: DataFrame) -> DataFrame:
    """Find requested ``(source_zip, path)`` among listed entries.

    First by exact path (a backslash counts as a slash), else the first entry with the same basename, else ``error``.
    """
    asked = requests.select("source_zip", F.col("path").alias("requested")).withColumn(
        "path", F.replace("requested", F.lit("\\"), F.lit("/"))
    )
    listed = entries.where(F.col("path").isNotNull()).select(
        "source_zip", F.col("path").alias("entry_path"), "entry_index"
    )
    by_path = listed.select("source_zip", F.col("entry_path").alias("path"), F.col("entry_path").alias("exact"))
    by_name = (
        listed.groupBy("source_zip", basename(F.replace("entry_path", F.lit("\\"), F.lit("/"))).alias("name"))
        .agg(F.min_by("entry_path", "entry_index").alias("same_name"))
    )
    found = (
        asked.join(by_path, ["source_zip", "path"], "left")
        .withColumn("name", basename(F.col("path")))
        .join(by_name, ["source_zip", "name"], "left")
    )
    entry = F.coalesce("exact", "same_name")
    return found.select(
        "source_zip",
        "requested",
        entry.alias("entry_path"),
        F.when(entry.isNull(), F.concat(F.lit("not found in archive: "), F.col("requested"))).alias("error"),
    )


def work_of(entries: DataFrame) -> DataFrame:
    """A work list of listed entries."""
    return entries.where(F.col("path").isNotNull()).select(*opened.WORK_COLUMNS)


def extract_entries(requests: DataFrame) -> DataFrame:
    """Bytes of requested ``(source_zip, path)``, one row per request: ``source_zip, requested, entry_path, content, error``.

    The archives' directories say where the entries stand; each is then read from its place by one task, whatever else its
    archive holds. Several requests for one entry read it once. Requests are joined with places, never with contents, so contents
    are neither shuffled nor broadcast; the directories are written first, so that their size is known to the joins.
    """
    spark, at = requests.sparkSession, shared_dir(requests.sparkSession, "directories")
    directories(requests.select(F.col("source_zip").alias("path")).distinct(), suffix="").write.parquet(at)
    listed = spark.read.schema(opened.ENTRIES).parquet(at)
    broken = listed.where(F.col("path").isNull()).select("source_zip", F.col("error").alias("archive_error"))
    resolved = resolve_entries(requests, listed).join(broken, "source_zip", "left")
    asked = resolved.select("source_zip", "requested", F.col("entry_path").alias("path"), F.coalesce("archive_error", "error").alias("error"))
    work = asked.join(work_of(listed), ["source_zip", "path"], "left")
    facts = work.agg(F.sum("length"), F.count("*")).first()
    found = opened.contents(opened.dealt(work, facts[0] or 0, facts[1]).sortWithinPartitions("source_zip", "path"), "requested")
    return found.select("source_zip", "requested", F.col("path").alias("entry_path"), "content", "error")
