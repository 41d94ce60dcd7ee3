"""Ingestion: a file listing in, readings and ledger events out.

The bytes of a new file are read twice, as they must be when a content hash decides whether to parse at all:

1. ``profile``: hash, parse errors and whether the file can hold equal rows, one small row per file;
2. ``emit``: readings of the files that remain. Files that cannot hold equal rows are written without a shuffle.

Between the two everything is one row per file, kept in small tables below the lake's work folder, which also cut the
lineage: a lost executor never re-reads source files for a decision already taken. Both passes hand work lists to tasks that
open the files themselves (``sources.opened``), so no names pass through the driver and a file that can't be read, in either
pass, fails alone. Files up to ``whole_file_bytes`` are one row while they are parsed, larger ones are lines of many tasks; hashes,
charsets, quoted line ends and all results are the same on both ways, for loose files and for archive entries.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from gaugeline.functions.text import content_hash
from gaugeline.operators import skip, wide
from gaugeline.operators.enrich import for_storage
from gaugeline.operators.ledger import status_events
from gaugeline.operators.sinks import write_batch
from gaugeline.plans.lake import CommitConflict, Lake
from gaugeline.schemas import COMPLETED, DEFAULTS, FAILED, IN_PROGRESS, LISTING, PROFILE, STAT_COLUMNS
from gaugeline.session import sized
from gaugeline.sources import archives, files as loose, opened, wide_text

#: Files above this size are read as lines, loose ones over many tasks.
WHOLE_FILE_BYTES = 32 << 20
#: Repeated times (a file and a time each) that are broadcast; more of them meet their lines in a shuffle.
REPEATED_TIMES = 200_000
#: How often the readings of a batch are written anew without files that failed meanwhile.
ATTEMPTS = 4

_WHOLE, _LINES, _KNOWN = "whole", "lines", "known"
_EMPTY_HASH = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


@dataclass(frozen=True)
class Options:
    encoding: str = DEFAULTS["encoding"]
    meta: Mapping[str, str] | None = None
    process_all: bool = False
    dedup_within_batch: bool = True
    trailing: str = wide.DROP_IF_BLANK
    whole_file_bytes: int = WHOLE_FILE_BYTES
    split_bytes: int = wide_text.SPLIT_BYTES
    cells_at_once: int = wide.CELLS_AT_ONCE


# --- work lists -----------------------------------------------------------------------------------------------


def work_list(lake: Lake, listed: DataFrame, ingest_id: str, opt: Options) -> DataFrame:
    """Listed files with the place of their bytes, their error if they have none, and ``kind``, the way they are read.

    Places of archive entries come from the archives' directories, one read of each archive's end.
    """
    spark, at = lake.spark, lake.work_path(ingest_id, "files")
    here = listed.where(F.col("source_zip") == "")
    packed = listed.where(F.col("source_zip") != "")
    work = loose.loose_work(here).join(sized(here.select("path", "error"), listed.count()), "path")
    zips = packed.select(F.col("source_zip").alias("path")).distinct()
    if not zips.isEmpty():
        directories_at = lake.work_path(ingest_id, "directories")
        archives.directories(zips).write.mode("overwrite").parquet(directories_at)
        entries = spark.read.schema(opened.ENTRIES).parquet(directories_at)
        entries = sized(entries, entries.count())
        places = entries.where(F.col("path").isNotNull()).drop("entry_index", "length").withColumnRenamed("error", "entry_error")
        places = places.withColumn("found", F.lit(True))
        sizes = entries.where(F.col("path").isNotNull()).select(*wide.FILE_KEYS, "length")
        broken = entries.where(F.col("path").isNull()).select("source_zip", F.col("error").alias("zip_error"))
        found = packed.drop("length").join(places, wide.FILE_KEYS, "left").join(sizes, wide.FILE_KEYS, "left").join(broken, "source_zip", "left")
        lost = F.when(F.col("found").isNull(), "missing archive entry")
        found = found.withColumn("error", F.coalesce("error", "zip_error", "entry_error", lost))
        work = work.unionByName(found.select(*opened.WORK_COLUMNS, "error"))
    readable = F.coalesce(F.col("error").isNull() & (F.col("length") > 0), F.lit(False))
    kind = F.when(~readable, _KNOWN).when(F.col("length") <= opt.whole_file_bytes, _WHOLE).otherwise(_LINES)
    work.withColumn("kind", kind).write.mode("overwrite").parquet(at)
    return spark.read.parquet(at)


def _amounts(work: DataFrame, *keys: str) -> dict[tuple, tuple[int, int]]:
    """Bytes and rows of a work list by a few keys."""
    counted = work.groupBy(*keys).agg(F.sum("length").alias("bytes"), F.count("*").alias("rows")).collect()
    return {tuple(r[k] for k in keys): (r["bytes"] or 0, r["rows"]) for r in counted}


# --- pass 1 ---------------------------------------------------------------------------------------------------


def profile(lake: Lake, new_files: DataFrame, ingest_id: str, opt: Options) -> DataFrame:
    """Write and return one profile row per new file."""
    spark, at = lake.spark, lake.work_path(ingest_id, "profile")
    work = work_list(lake, new_files, ingest_id, opt)
    amounts = _amounts(work, "kind")
    columns = PROFILE.fieldNames()

    def of_kind(name: str) -> DataFrame:
        return work.where(F.col("kind") == name).drop("kind")

    known = of_kind(_KNOWN).withColumns({
        "file_hash": F.when(F.col("length") == 0, _EMPTY_HASH),
        "error": F.coalesce("error", F.lit("empty file")),
        "repeats": F.lit(wide.NOWHERE),
        "mode": F.lit(_WHOLE),
    })
    known.select(*columns).write.mode("overwrite").parquet(at)

    if (_WHOLE,) in amounts:
        read = opened.contents(opened.dealt(of_kind(_WHOLE), *amounts[_WHOLE,]))
        parsed = wide.parse_files(spark, read.withColumn("file_hash", content_hash(F.col("content"))), opt.encoding, opt.trailing)
        parsed.withColumn("mode", F.lit(_WHOLE)).select(*columns).write.mode("append").parquet(at)
    if (_LINES,) in amounts:
        _profile_lines(lake, of_kind(_LINES), ingest_id, opt, *amounts[_LINES,]).select(*columns).write.mode("append").parquet(at)
    return spark.read.schema(PROFILE).parquet(at)


def _profile_lines(lake: Lake, work: DataFrame, ingest_id: str, opt: Options, total: int, rows: int) -> DataFrame:
    """Profiles of files that are read as lines. What pass 2 needs again (splits, sensors) stays in the work folder."""
    spark = lake.spark

    def kept(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(lake.work_path(ingest_id, name))
        return spark.read.parquet(lake.work_path(ingest_id, name))

    def per_file(df: DataFrame, *columns: str) -> DataFrame:
        return sized(df.select(*wide.FILE_KEYS, *columns), rows)

    n_splits = rows + total // opt.split_bytes
    digested = kept("digests", opened.digests(opened.dealt(work, total, rows)))
    readable = work.drop("error").join(per_file(digested.where(F.col("error").isNull()), "head"), wide.FILE_KEYS)
    coded = kept("charsets", wide_text.charsets(spark, readable, opt.encoding, opt.split_bytes, total, n_splits))
    placed = wide_text.states(kept("scans", wide_text.scans(coded, opt.split_bytes, total, n_splits)))
    scanned = kept("scanned", wide_text.scan_errors(placed))
    sound = coded.join(per_file(scanned.where(F.col("scan_error").isNull())), wide.FILE_KEYS)
    kept("splits", wide_text.place(sound, placed, scanned, opt.split_bytes, rows, n_splits))
    lines = wide_text.decoded(spark, _records(lake, ingest_id, opt, total, n_splits), opt.encoding)
    first = kept("runs", wide.profile_runs(lines, opt.trailing))
    doubtful = first.where("doubtful AND error IS NULL").select(*wide.FILE_KEYS)
    if doubtful.isEmpty():
        profiled = kept("lines", first.drop("doubtful"))
    else:
        # Only lines of files that aren't plainly in order are grouped by their times; the times that do repeat are kept.
        again = wide_text.decoded(spark, _records(lake, ingest_id, opt, total, n_splits, sized(doubtful, rows)), opt.encoding)
        times = kept("repeated", wide.repeated_times(again)).select(*wide.FILE_KEYS).distinct().withColumn("again", F.lit(True))
        marked = first.drop("doubtful").join(per_file(times, "again"), wide.FILE_KEYS, "left")
        same_time = F.when((F.col("repeats") == wide.NOWHERE) & F.col("again"), wide.SAME_TIME).otherwise(F.col("repeats"))
        profiled = kept("lines", marked.withColumn("repeats", same_time).drop("again"))
    joined = (
        work.select(*wide.FILE_KEYS, "length")
        .join(per_file(digested, "file_hash", F.col("error").alias("read_error")), wide.FILE_KEYS)
        .join(per_file(scanned, "scan_error"), wide.FILE_KEYS, "left")
        .join(per_file(profiled, "error", "repeats", F.lit(True).alias("has_lines")), wide.FILE_KEYS, "left")
    )
    blank = F.when(F.col("has_lines").isNull(), "fewer than 3 header rows")
    return joined.withColumns({
        "error": F.coalesce("read_error", "scan_error", "error", blank),
        "repeats": F.coalesce("repeats", F.lit(wide.NOWHERE)),
        "mode": F.lit(_LINES),
    })


def _records(lake: Lake, ingest_id: str, opt: Options, total: int, n_splits: int, wanted: DataFrame | None = None) -> DataFrame:
    cut = lake.spark.read.parquet(lake.work_path(ingest_id, "splits"))
    if wanted is not None:
        cut = cut.join(wanted.select(*wide.FILE_KEYS), wide.FILE_KEYS, "left_semi")
    return opened.read_records(opened.dealt(cut, total, n_splits, "split"), opt.split_bytes)


# --- decisions ------------------------------------------------------------------------------------------------


def decide(profiles: DataFrame, processed: DataFrame, opt: Options) -> DataFrame:
    """``outcome`` per profiled file: known content, failed, or to be processed.

    Of several new files with one content the first by path is processed; the others count as known content.
    """
    flagged = profiles.withColumn("by_hash", F.lit(False)) if opt.process_all else skip.flag_by_hash(profiles, processed)
    outcome = (
        F.when(F.col("by_hash"), skip.BY_HASH)
        .when(F.col("error").isNotNull(), skip.FAILED_OUTCOME)
        .otherwise(skip.PROCESS)
    )
    decided = flagged.withColumn("outcome", outcome).drop("by_hash")
    if opt.process_all or not opt.dedup_within_batch:
        return decided
    first = (
        skip.batch_winners(decided.where(F.col("outcome") == skip.PROCESS))
        .select("path", "source_zip")
        .withColumn("wins", F.lit(True))
    )
    copy = (F.col("outcome") == skip.PROCESS) & F.col("wins").isNull()
    return decided.join(first, wide.FILE_KEYS, "left").withColumn(
        "outcome", F.when(copy, skip.BY_HASH).otherwise(F.col("outcome"))
    ).drop("wins")


# --- pass 2 ---------------------------------------------------------------------------------------------------


def emit(lake: Lake, todo: DataFrame, ingest_id: str, opt: Options) -> DataFrame | None:
    """Write the readings of all files to be processed. Files that failed on the way come back with their errors; then the
    batch is to be written anew without them.

    A file is parsed only if its bytes still have the hash that the decision was made on (in lines: the length).
    """
    spark = lake.spark
    work = spark.read.parquet(lake.work_path(ingest_id, "files")).drop("kind", "error")
    n_files = work.count()
    chosen = work.join(sized(todo.select(*wide.FILE_KEYS, "file_hash", "mode", "repeats"), n_files), wide.FILE_KEYS)
    mode, failures = "overwrite", []

    def put(stored: DataFrame) -> None:
        nonlocal mode
        write_batch(stored, lake.readings_path, ingest_id, mode)
        mode = "append"

    def watched(rows: DataFrame) -> tuple[DataFrame, Observation]:
        seen = Observation()
        return rows.observe(seen, F.count_if(F.col("error").isNotNull()).alias("errors")), seen

    def clear(cells: DataFrame) -> DataFrame:
        return for_storage(cells, opt.meta, named=True)

    def doubtful(cells: DataFrame) -> DataFrame:
        return for_storage(wide.distinct_readings(cells), opt.meta)

    for (mode_of, repeats), (total, rows) in sorted(_amounts(chosen, "mode", "repeats").items()):
        group = chosen.where((F.col("mode") == mode_of) & (F.col("repeats") == repeats))
        if mode_of == _LINES:
            wanted = sized(group.select(*wide.FILE_KEYS), n_files)
            profiles = spark.read.parquet(lake.work_path(ingest_id, "lines")).join(wanted, wide.FILE_KEYS, "left_semi")
            raw = _records(lake, ingest_id, opt, total, rows + total // opt.split_bytes, wanted)
            read, seen = watched(raw)
            lines, fits = wide_text.decoded(spark, read, opt.encoding), wide.lookup_fits(profiles)
            profiles = profiles if fits else profiles.hint("merge")
            if repeats == wide.NOWHERE:
                put(clear(wide.readings_from_lines(lines, profiles, fits, scrub=True)))
            elif repeats == wide.ANYWHERE:
                put(doubtful(wide.readings_from_lines(lines, profiles, fits)))
            else:
                # Only lines whose time repeats can be equal; the others go past the distinct.
                times = spark.read.parquet(lake.work_path(ingest_id, "repeated")).withColumn("again", F.lit(True))
                few = times.limit(REPEATED_TIMES + 1).count() <= REPEATED_TIMES
                timed = wide.timed_lines(lines, profiles, fits)
                same = F.col("l.Time").eqNullSafe(F.col("t.Time")) & (F.col("l.path") == F.col("t.path")) & (F.col("l.source_zip") == F.col("t.source_zip"))
                split = timed.alias("l").join((F.broadcast(times) if few else times.hint("merge")).alias("t"), same, "left").select("l.*", "again")
                unique = clear(wide.cells(wide.scrub_names(split.where(F.col("again").isNull()).drop("again"))))
                put(unique.unionByName(doubtful(wide.cells(split.where("again").drop("again")))))
        else:
            raw = opened.contents(opened.dealt(group, total, rows))
            read, seen = watched(raw)
            parsed = wide.parse_files(spark, read, opt.encoding, opt.trailing)
            if repeats == wide.NOWHERE:
                put(clear(wide.cells(wide.explode_lines(wide.scrub_names(parsed)))))
            elif repeats == wide.ANYWHERE:
                put(doubtful(wide.cells(wide.explode_lines(parsed, wide.DOUBTFUL))))
            else:
                # Equal readings share file and time, so they meet in one row; only times with very many cells are left to a shuffle.
                left = Observation()
                times = wide.explode_times(wide.scrub_names(parsed), opt.cells_at_once).observe(left, F.count_if(F.col("many")).alias("errors"))
                put(clear(wide.distinct_cells(times)))
                if _count(left) != 0:
                    put(doubtful(wide.cells(wide.explode_many(parsed, opt.cells_at_once))))
        if _count(seen) != 0:
            failures.append(raw.where(F.col("error").isNotNull()).select(*wide.FILE_KEYS, "error"))
    if not failures:
        return None
    at = lake.work_path(ingest_id, f"failures-{uuid.uuid4().hex}")
    for i, rows in enumerate(failures):
        rows.groupBy(*wide.FILE_KEYS).agg(F.max("error").alias("error")).write.mode("append" if i else "overwrite").parquet(at)
    failed = spark.read.parquet(at)
    return None if failed.isEmpty() else failed


def _count(seen: Observation) -> int | None:
    """Errors (or what else was counted under that name) that a finished write has seen. None: the planner found the reading superfluous (no file has a sensor) and left it out."""
    try:
        return seen.get["errors"]
    except Py4JJavaError:
        return None


# --- the job --------------------------------------------------------------------------------------------------


def ingest_files(
    lake: Lake, listing: DataFrame, ingest_id: str | None = None, options: Options | None = None, **changes
) -> DataFrame:
    """Bring all files of a listing into the lake; returns the one-row run statistics.

    Running again with the same ``ingest_id`` after a crash starts the batch over, from empty folders. A committed id is not
    run again and gives its statistics; with another listing it is refused, because its files would be lost.
    """
    opt = options or Options(**changes)
    spark = lake.spark
    ingest_id = ingest_id or f"run-{uuid.uuid4().hex}"
    lake.clear_work(ingest_id)
    given = lake.work_path(ingest_id, "given")
    listing.select(*LISTING.fieldNames()).write.mode("overwrite").parquet(given)
    for attempt in range(ATTEMPTS):
        try:
            stats = _attempt(lake, spark.read.schema(LISTING).parquet(given), ingest_id, opt)
            break
        except CommitConflict:
            if attempt == ATTEMPTS - 1:
                raise
    lake.clear_work(ingest_id)
    return spark.createDataFrame([tuple(stats.values())], ", ".join(f"{name} bigint" for name in stats))


def _attempt(lake: Lake, named: DataFrame, ingest_id: str, opt: Options) -> dict[str, int]:
    """Decide on the ledger as it is now, write, and commit; the statistics."""
    spark = lake.spark
    listed_at, plan_at = lake.work_path(ingest_id, "listing"), lake.work_path(ingest_id, "plan")
    since = lake.state()[0]
    processed = lake.processed_files(settled=True)
    if opt.process_all:
        named = named.withColumn("by_name", F.lit(False))
    else:
        named = skip.flag_by_name(named, processed, lake.ledger_key)
    named.write.mode("overwrite").parquet(listed_at)
    listed = spark.read.parquet(listed_at)
    file = F.xxhash64("path", "source_zip", "length")
    mark = listed.agg(F.concat_ws(":", F.count(F.lit(1)), F.bit_xor(file), F.bit_xor(F.xxhash64(file)))).first()[0]

    done = lake.commit_of(ingest_id)
    if done is not None:
        if done["listing"] not in (None, mark):
            raise ValueError(f"batch {ingest_id} is committed with other files")
        return {name: done[name] for name in STAT_COLUMNS}
    lake.clear_batch(ingest_id)
    stats = _run(lake, listed, processed, ingest_id, opt, plan_at)
    lake.commit(ingest_id, mark, stats, since)
    return stats


def _run(lake: Lake, listed: DataFrame, processed: DataFrame, ingest_id: str, opt: Options, plan_at: str) -> dict[str, int]:
    """One batch up to its commit; the statistics."""
    spark = lake.spark
    profiles = profile(lake, listed.where(~F.col("by_name")).drop("by_name"), ingest_id, opt)
    decide(profiles, processed, opt).write.mode("overwrite").parquet(plan_at)
    plan = spark.read.parquet(plan_at)

    todo = plan.where(F.col("outcome") == skip.PROCESS)
    started = dt.datetime.now(dt.timezone.utc)
    lake.append_events(status_events(todo, IN_PROGRESS, started, ingest_id, 0, lake.ledger_key))
    for attempt in range(ATTEMPTS):
        lake.clear_batch(ingest_id)
        failed = emit(lake, todo, ingest_id, opt)
        if failed is None:
            break
        lost = sized(failed.withColumnRenamed("error", "lost"), failed.count())
        late = plan.join(lost, wide.FILE_KEYS, "left").withColumns(
            {"outcome": F.when(F.col("lost").isNotNull(), skip.FAILED_OUTCOME).otherwise(F.col("outcome")), "error": F.coalesce("error", "lost")}
        )
        late.drop("lost").write.mode("overwrite").parquet(f"{plan_at}-{attempt}")
        plan = spark.read.parquet(f"{plan_at}-{attempt}")
        todo = plan.where(F.col("outcome") == skip.PROCESS)
    else:
        raise RuntimeError(f"files of batch {ingest_id} failed in each of {ATTEMPTS} attempts to write it")

    now = dt.datetime.now(dt.timezone.utc)
    failed = plan.where(F.col("outcome") == skip.FAILED_OUTCOME).withColumn("reason", F.col("error"))
    lake.append_events(
        status_events(todo, COMPLETED, now, ingest_id, 1, lake.ledger_key).unionByName(
            status_events(failed, FAILED, now, ingest_id, 1, lake.ledger_key)
        )
    )
    by_name = listed.where("by_name").select(F.lit(skip.BY_NAME).alias("outcome"))
    return skip.run_stats(plan.select("outcome").unionByName(by_name)).first().asDict()


def find_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Loose and archived CSV files below a folder. An archive that can't be opened is a row of its own, with the reason."""
    entries = archives.as_listing(archives.find_csv_in_archives(spark, folder, pattern))
    return loose.union_listings(loose.find_csv_files(spark, folder, pattern), entries)


def ingest_folder(
    lake: Lake,
    folder: str | None = None,
    pattern: str | None = None,
    ingest_id: str | None = None,
    options: Options | None = None,
    **changes,
) -> DataFrame:
    listing = find_files(lake.spark, folder or DEFAULTS["folder"], pattern or DEFAULTS["pattern"])
    return ingest_files(lake, listing, ingest_id, options, **changes)
