"""From raw documents to packed training sequences: five stages, each one operator over all that its predecessor kept.

Between stages the documents are written as Parquet to the shared folder and read back, so a lost executor costs one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gaugeline.llm import lines, minhash, packing, pii, quality_rules
from gaugeline.llm.common import saved, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base limits nor the learned list reject."""
    return quality_rules.keep_good(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occurred before are cut out; documents of which nothing is left go."""
    return lines.remove(docs, drop_emptied=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of smallest id."""
    return minhash.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by tags."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with the sequence and offset of each."""
    return packing.sequences(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("personal data", personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = saved(docs, name.replace(" ", "-"))
    return docs


#: The learned list and the packing heuristic have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None
