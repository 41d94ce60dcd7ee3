"""Provenance and plant columns."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from gaugeline.functions.text import CONTROL_CHARACTERS, scrub_control_chars, scrub_text
from gaugeline.schemas import DEFAULTS, META_KEYS, READING_COLUMNS


def default_meta() -> dict[str, str]:
    return {key: DEFAULTS[key] for key in META_KEYS}


def add_meta(
    readings: DataFrame,
    meta: Mapping[str, str] | None = None,
    source_file: str = "path",
    source_zip: str = "source_zip",
) -> DataFrame:
    """Append source and plant columns and put everything in table order.

    A missing archive is '' rather than null, and so is a plant value that ``meta`` does not name. The plant values
    are literals, so they cost nothing per row.
    """
    values = default_meta() if meta is None else meta
    return readings.withColumns(
        {
            "source_file": F.col(source_file),
            "source_zip": F.coalesce(F.col(source_zip), F.lit("")),
            **{key: F.lit(values.get(key, "")) for key in META_KEYS},
        }
    ).select(*READING_COLUMNS)


def for_storage(readings: DataFrame, meta: Mapping[str, str] | None = None, named: bool = False) -> DataFrame:
    """Table rows without control characters. ``named`` says that file and sensor names are clean already."""
    if not named:
        return scrub_control_chars(add_meta(readings, meta))
    values = {k: re.sub(CONTROL_CHARACTERS, "", v) for k, v in (default_meta() if meta is None else meta).items()}
    return add_meta(readings.withColumn("value", scrub_text(F.col("value"))), values)
