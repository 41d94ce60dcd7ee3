"""Helpers shared by the corpus operators."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeline.session import shared_dir

#: Spaces that separate words: U+0020 and U+0009 to U+000D.
BLANK = r"\x20\x09-\x0D"
WORD = f"[^{BLANK}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts lineage (a lost executor costs no recomputation behind it) and leaves the next join with plain exchanges, which
    the adaptive planner can split where a key is hot.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where ``body`` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold(id_column: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``. Null ids are in no fold."""
    return F.crc32(id_column.cast("string").cast("binary")) % parts


def fold_of(doc_id: int, parts: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % parts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, fit_rows: int) -> DataFrame:
    """About ``fit_rows`` labelled documents (all, if there are fewer): ``doc_id, text, label``.

    ``allowed`` is a condition on ``doc_id``. The sample is chosen by a hash of the id, so it doesn't depend on file
    layout. Only its ids, whose number ``fit_rows`` bounds, are broadcast. Several labels of one id count as the largest; of several
    texts of one id the one with the smallest hash is taken, so the sample has one row per id.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & allowed).groupBy("doc_id").agg(F.max("label").alias("label"))
    share = min(1.0, fit_rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < F.lit(round(share * 1_000_003)))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one"))
    return one.select("doc_id", F.col("one.text").alias("text"), "label")


#: Bits of the map that ``split_by_key`` uses: 512 rows of 4 KiB at most.
_MAP_BITS = 24


def split_by_key(rows: DataFrame, key: list[str], wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` that may have their ``key`` in ``wanted``, and those that surely don't, so that only the first need a shuffle.

    The test is a bitmap of fixed size over a hash of the key, broadcast whatever the input's size. Where it fills up, more
    rows are taken for possible matches; the result of a join of those with ``wanted`` is the same.
    """
    place = lambda: F.pmod(F.xxhash64(*key), F.lit(1 << _MAP_BITS)) + 1
    bits = wanted.select(place().alias("n")).groupBy(F.bitmap_bucket_number("n").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("__bits"))
    found = [(r["__bucket"], r["__bits"]) for r in bits.collect()]
    known = F.broadcast(rows.sparkSession.createDataFrame(found, "__bucket bigint, __bits binary"))
    at = F.bitmap_bit_position(F.col("__place"))
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.coalesce(F.floor(byte / F.pow(F.lit(2), at % 8)).cast("int") % 2 == 1, F.lit(False))
    marked = rows.withColumn("__place", place()).withColumn("__bucket", F.bitmap_bucket_number("__place")).join(known, "__bucket", "left")
    columns = [F.col(f"`{c}`") for c in rows.columns]
    return marked.where(bit).select(*columns), marked.where(~bit).select(*columns)


def slices(batches: Iterator, rows: int = 512) -> Iterator:
    """Arrow batches cut into small ones, so that Python objects of few rows exist at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
