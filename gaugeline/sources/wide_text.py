"""Large files as lines: each is cut into splits that tasks read on their own, quoted line ends and two-byte charsets included.

1. ``charsets``: how a file's lines are found and decoded, from its first bytes and, where these don't say, from all its splits.
2. ``place``: every split is read once for what it does to the state of quotes; a scan over one row per split gives the state in
   which each begins. Where the header rows begin is read from the file's head, however long they are.
3. ``opened.read_records``: every split gives the records that begin in it.

An archive entry is one split, because it can only be inflated from its beginning.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gaugeline.functions.decode import AUTO, charset_of, decode_by, decode_text, java_charset, marked_charset, merged_facts
from gaugeline.functions.text import chomp
from gaugeline.session import configure, sized
from gaugeline.sources import opened

KEYS = ["path", "source_zip"]
SPLIT_BYTES = 128 << 20
TRANSCODED = re.compile("(?i)^(UTF-(16|32)|ISO-2022-JP)")


def form_of(charset: Column, head: Column) -> Column:
    """How lines are found. A charset that leaves the byte order open follows the mark, and is big-endian without one."""
    little = F.coalesce(F.startswith(head, F.unhex(F.lit("FFFE"))), F.lit(False))
    name = F.upper(charset)
    return (
        F.when(name == "UTF-16LE", opened.UTF16_LE)
        .when(name == "UTF-16BE", opened.UTF16_BE)
        .when(name == "UTF-16", F.when(little, opened.UTF16_LE).otherwise(opened.UTF16_BE))
        .when(name == "UTF-32LE", opened.UTF32_LE)
        .when(name == "UTF-32BE", opened.UTF32_BE)
        .when(name == "UTF-32", F.when(little, opened.UTF32_LE).otherwise(opened.UTF32_BE))
        .when(name == "ISO-2022-JP", opened.ISO_2022_JP)
        .otherwise(opened.BYTES)
    )


def charsets(spark: SparkSession, work: DataFrame, encoding: str, split_bytes: int, total_bytes: int, rows: int) -> DataFrame:
    """``work`` (with ``head``, the first bytes) and its ``charset, form, bom``."""
    if encoding.lower() != AUTO:
        known = work.withColumn("charset", F.lit(java_charset(spark, encoding)))
    else:
        configure(spark)
        marked = work.withColumn("charset", marked_charset(F.col("head")))
        plain = marked.where(F.col("charset").isNull()).withColumns({"form": F.lit(opened.BYTES), "bom": F.lit(False)})
        cut = opened.dealt(opened.splits(plain, split_bytes), total_bytes, rows, "split")
        facts = opened.read_blocks(cut).groupBy(*KEYS).agg(*merged_facts(F.col("raw")))
        voted = facts.select(*KEYS, charset_of({c: F.col(c) for c in ("escapes", "jis", "utf8", "sjis", "euc")}).alias("voted"))
        known = marked.join(sized(voted, rows), KEYS, "left").withColumn("charset", F.coalesce("charset", "voted", F.lit("UTF-8"))).drop("voted")
    bom = F.startswith(F.upper("charset"), F.lit("UTF-"))
    return known.withColumns({"form": form_of(F.col("charset"), F.col("head")), "bom": bom})


def scans(work: DataFrame, split_bytes: int, total_bytes: int, rows: int) -> DataFrame:
    """What each split of ``work`` (with ``form, bom``) does, see ``opened.scan_splits``."""
    return opened.scan_splits(opened.dealt(opened.splits(work, split_bytes), total_bytes, rows, "split"))


def states(scanned: DataFrame) -> DataFrame:
    """``scanned`` with ``state`` (before the split) and ``after``.

    A split keeps the state, flips it, or sets it whatever it was. So the state is what was set last, flipped as often as flips
    follow: two running aggregates over one narrow row per split.
    """
    order = Window.partitionBy(*KEYS).orderBy("split")
    before, until = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    flips = ((F.col("if_none") == opened.OPEN) & (F.col("if_open") == opened.NONE)).cast("int")
    counted = scanned.withColumn("flips", F.sum(flips).over(until))
    odd = F.pmod("flips", F.lit(2)).cast("int")
    counted = counted.withColumn("mark", F.when(F.col("if_none") == F.col("if_open"), F.col("if_none").bitwiseXOR(odd)))
    last = F.coalesce(F.last("mark", ignorenulls=True).over(before), F.lit(opened.NONE))
    flipped = F.coalesce(F.pmod(F.last("flips").over(before), F.lit(2)).cast("int"), F.lit(0))
    placed = counted.withColumn("state", last.bitwiseXOR(flipped)).drop("flips", "mark")
    return placed.withColumn("after", F.when(F.col("state") == opened.NONE, F.col("if_none")).otherwise(F.col("if_open")))


def scan_errors(placed: DataFrame) -> DataFrame:
    """``path, source_zip, scan_error, heads`` of every file of ``states``."""
    open_at_end = F.max_by("after", "split") == opened.OPEN
    error = F.coalesce(F.max("error"), F.when(open_at_end, "unbalanced quotes"))
    return placed.groupBy(*KEYS).agg(error.alias("scan_error"), F.max_by("heads", F.when(F.col("split") == 0, 1)).alias("heads"))


def place(work: DataFrame, placed: DataFrame, heads: DataFrame, split_bytes: int, n_files: int, n_splits: int) -> DataFrame:
    """Splits ready for ``opened.read_records``: those of ``work`` (with ``form, bom, charset``) with their states and header places."""
    cut = opened.splits(work, split_bytes, "charset")
    stated = cut.join(sized(placed.select(*KEYS, "split", "state"), n_splits), [*KEYS, "split"])
    return stated.join(sized(heads.select(*KEYS, "heads"), n_files), KEYS)


def decoded(spark: SparkSession, lines: DataFrame, encoding: str) -> DataFrame:
    """``line`` of records. What had to be decoded to find its lines is in UTF-8 already."""
    if encoding.lower() != AUTO:
        name = java_charset(spark, encoding)
        text = decode_text(spark, F.col("raw"), "UTF-8" if TRANSCODED.match(name) else name)
    else:
        configure(spark)
        # a step of its own, so that the pattern runs once and not for every charset
        lines = lines.withColumn("text_as", F.when(F.rlike("charset", F.lit(TRANSCODED.pattern)), "UTF-8").otherwise(F.col("charset")))
        text = decode_by(F.col("raw"), F.col("text_as"))
    return lines.withColumn("line", text).withColumn("line", F.expr(chomp("line"))).drop("text_as")


def read_lines(spark: SparkSession, paths: list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Non-blank records of named files in a charset of single bytes: ``path, source_zip, length, chunk, header_no, raw, charset, error``."""
    from gaugeline.sources.files import listing_of, loose_work

    files = loose_work(listing_of(spark, paths))
    work = files.withColumns({"charset": F.lit("UTF-8"), "form": F.lit(opened.BYTES), "bom": F.lit(False)})
    total = files.agg(F.sum("length")).first()[0] or 0
    rows = total // split_bytes + len(paths)
    placed = states(scans(work, split_bytes, total, rows))
    cut = place(work, placed, scan_errors(placed), split_bytes, len(paths), rows)
    return opened.read_records(opened.dealt(cut, total, rows, "split"), split_bytes)
