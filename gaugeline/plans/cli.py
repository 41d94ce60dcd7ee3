"""Command line of the folder job, for ``spark-submit`` or ``python -m gaugeline``."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from gaugeline.operators.wide import DROP_IF_BLANK, DROP_LAST
from gaugeline.plans.ingest import Options, ingest_folder
from gaugeline.plans.lake import Lake
from gaugeline.schemas import DEFAULTS, META_KEYS
from gaugeline.session import build_session

log = logging.getLogger("gaugeline")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gaugeline", description="Bring sensor CSV files below a folder into a lake.")
    p.add_argument("--folder", default=DEFAULTS["folder"])
    p.add_argument("--pattern", default=DEFAULTS["pattern"], help="regular expression searched in file names")
    p.add_argument("--lake", default="lake", help="folder of readings and ledger")
    p.add_argument("--process-all", action="store_true", help="take up known files again")
    p.add_argument("--encoding", default=DEFAULTS["encoding"], help="a charset, or 'auto'")
    p.add_argument("--trailing", choices=[DROP_IF_BLANK, DROP_LAST], default=DROP_IF_BLANK)
    p.add_argument("--ingest-id", help="repeat an id to resume a batch that died")
    p.add_argument("--master", help="Spark master; left to spark-submit if not given")
    p.add_argument("--log-level", default="INFO", choices=["DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"])
    p.add_argument("--log-file")
    for key in META_KEYS:
        p.add_argument("--" + key.replace("_", "-"), default=DEFAULTS[key])
    return p


def main(argv: Sequence[str] | None = None) -> dict[str, int]:
    args = parser().parse_args(argv)
    logging.basicConfig(level=args.log_level, filename=args.log_file, format="%(asctime)s %(levelname)s %(message)s")
    spark = build_session(master=args.master)
    options = Options(
        encoding=args.encoding,
        meta={key: getattr(args, key) for key in META_KEYS},
        process_all=args.process_all,
        trailing=args.trailing,
    )
    stats = ingest_folder(Lake(spark, args.lake), args.folder, args.pattern, args.ingest_id, options).first().asDict()
    for name, count in stats.items():
        log.info("%s: %d", name, count)
    return stats
