"""Wide sensor CSV files to long readings, as Spark jobs."""

from gaugeline.operators.skip import run_stats
from gaugeline.operators.wide import wide_to_long
from gaugeline.plans.ingest import Options, find_files, ingest_files, ingest_folder
from gaugeline.plans.lake import Lake
from gaugeline.session import build_session, configure
from gaugeline.streaming.incremental import stream_ingest

__all__ = [
    "Lake",
    "Options",
    "build_session",
    "configure",
    "find_files",
    "ingest_files",
    "ingest_folder",
    "run_stats",
    "stream_ingest",
    "wide_to_long",
]
