"""Incremental ingestion: a stream of new files that hands every one to the batch job exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeline.plans.ingest import Options, ingest_files
from gaugeline.plans.lake import Lake
from gaugeline.schemas import DEFAULTS
from gaugeline.sources import archives, opened
from gaugeline.sources.files import as_listing, union_listings
from gaugeline.streaming.folder_source import FORMAT, FolderSource


def stream_ingest(
    lake: Lake,
    folder: str,
    checkpoint: str,
    pattern: str = DEFAULTS["pattern"],
    name: str = "files",
    max_files_per_trigger: int = 10_000,
    options: Options | None = None,
    **trigger,
) -> StreamingQuery:
    """Start a stream over the CSV files below a folder, loose and in archives.

    The source writes snapshots of at most ``max_files_per_trigger`` new files; each snapshot becomes one batch, whose fixed ingest
    id is made from the query's own id and the snapshot's number. So a batch that is repeated after a failure is started over or, if
    it was committed, left alone; a stream with another checkpoint has other ids. By default everything available is processed
    and the query ends; pass e.g. ``processingTime="1 minute"`` to keep it running. Readings and ledger are those of ``ingest_folder``.
    """
    spark = lake.spark
    spark.dataSource.register(FolderSource)
    fits = F.udf(opened.named((".csv",), pattern), "boolean")
    source = (
        spark.readStream.format(FORMAT)
        .option("path", opened.qualified(spark, folder))
        .option("snapshots", f"{opened.qualified(spark, checkpoint)}/snapshots")
        .option("suffixes", ".csv,.zip")
        .option("maxFiles", max_files_per_trigger)
        .load()
    )

    def ingest(files: DataFrame, ingest_id: str) -> None:
        zipped = F.col("path").endswith(".zip")
        loose = as_listing(files.where(~zipped & fits(F.regexp_extract("path", "[^/]*$", 0))))
        packed = archives.as_listing(archives.directories(files.where(zipped), pattern))
        ingest_files(lake, union_listings(loose, packed), ingest_id, options)

    def run(batch: DataFrame, batch_id: int) -> None:
        # Kept in the checkpoint from before the first batch on; another checkpoint is another query.
        query_id = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        batch.persist()
        for (number,) in sorted(batch.select("snapshot").distinct().collect()):
            ingest(batch.where(F.col("snapshot") == number).drop("snapshot"), f"stream-{name}-{query_id}-{number}")
        batch.unpersist()

    return source.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
