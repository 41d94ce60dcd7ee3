import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import ledger as led, skip
from gaugeline.schemas import LEDGER_EVENT, PROCESSED_FILES

T0 = dt.datetime(2024, 1, 1)


def events(spark, *rows):
    """(file, zip, hash, status, minute, removed)"""
    full = [(f, z, h, s, None, None, f, T0 + dt.timedelta(minutes=m), m, gone) for f, z, h, s, m, gone in rows]
    return spark.createDataFrame(full, LEDGER_EVENT)


def states(df):
    return sorted((r.file_path, r.source_zip, r.file_hash, r.status) for r in df.collect())


def test_upsert_keeps_the_last_event(spark):
    log = events(
        spark,
        ("a", "", "1", "IN_PROGRESS", 1, False),
        ("a", "", "2", "COMPLETED", 3, False),
        ("a", "", "3", "FAILED", 2, False),
        ("a", "z", "4", "TIMEOUT", 1, False),
    )
    table = led.processed_files(log)
    assert states(table) == [("a", "", "2", "COMPLETED"), ("a", "z", "4", "TIMEOUT")]
    assert table.columns == PROCESSED_FILES.fieldNames()


def test_removal_and_return(spark):
    log = events(
        spark,
        ("a", "", "1", "COMPLETED", 1, False),
        ("a", "", "", "COMPLETED", 2, True),
        ("b", "", "1", "COMPLETED", 1, True),
        ("b", "", "2", "FAILED", 2, False),
    )
    assert states(led.processed_files(log)) == [("b", "", "2", "FAILED")]


def test_status_of_unknown_and_odd_values(spark):
    table = led.processed_files(
        events(spark, ("a", "", "1", "COMPLETED", 1, False), ("b", "", "1", "NO SUCH STATE", 1, False))
    )
    asked = spark.createDataFrame([("/x/a", ""), ("/x/b", ""), ("/x/c", ""), ("/x/a", "z")], "path string, source_zip string")
    got = {(r.path, r.source_zip): r.status for r in led.file_status(asked, table).collect()}
    assert got == {("/x/a", ""): "COMPLETED", ("/x/b", ""): None, ("/x/c", ""): None, ("/x/a", "z"): None}


def test_unknown_status_is_refused(spark):
    files = spark.createDataFrame([("/a", "", "1")], "path string, source_zip string, file_hash string")
    with pytest.raises(ValueError):
        led.status_events(files, "DONE")


def test_merge_prefers_the_second(spark):
    main = led.processed_files(events(spark, ("a", "", "1", "COMPLETED", 9, False), ("b", "", "2", "COMPLETED", 1, False)))
    other = led.processed_files(events(spark, ("a", "", "3", "FAILED", 1, False), ("c", "", "4", "COMPLETED", 1, False)))
    assert states(led.merge_ledgers(main, other)) == [
        ("a", "", "3", "FAILED"),
        ("b", "", "2", "COMPLETED"),
        ("c", "", "4", "COMPLETED"),
    ]


def test_skips_look_at_completed_only(spark):
    table = led.processed_files(
        events(spark, ("a.csv", "", "h1", "COMPLETED", 1, False), ("b.csv", "", "h2", "FAILED", 1, False), ("c.csv", "z", "h3", "COMPLETED", 1, False))
    )
    files = spark.createDataFrame(
        [("/x/a.csv", "", "h9"), ("/y/a.csv", "", "h8"), ("/x/b.csv", "", "h2"), ("/x/c.csv", "", "h3"), ("/x/d.csv", "", "h1")],
        "path string, source_zip string, file_hash string",
    )
    assert sorted(r.path for r in skip.skip_by_name(files, table).collect()) == ["/x/b.csv", "/x/c.csv", "/x/d.csv"]
    assert sorted(r.path for r in skip.skip_by_hash(files, table).collect()) == ["/x/a.csv", "/x/b.csv", "/y/a.csv"]
    got = {r.path: r.outcome for r in skip.classify_files(files, table).collect()}
    assert got == {
        "/x/a.csv": skip.BY_NAME,
        "/y/a.csv": skip.BY_NAME,
        "/x/b.csv": skip.PROCESS,
        "/x/c.csv": skip.BY_HASH,
        "/x/d.csv": skip.BY_HASH,
    }
    assert skip.run_stats(skip.classify_files(files, table)).first().asDict() == {
        "total_found": 5,
        "already_processed_by_path": 2,
        "already_processed_by_hash": 2,
        "newly_processed": 1,
        "failed": 0,
        "timeout": 0,
    }


def test_batch_dedup_with_a_third_of_copies(spark):
    n = 3000
    files = spark.range(n).select(
        F.format_string("/f/%05d.csv", F.lit(n) - F.col("id")).alias("path"),
        F.lit("").alias("source_zip"),
        F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("file_hash"),
    )
    kept = skip.batch_dedup(files)
    assert kept.count() == 2001
    assert kept.where("file_hash = 'copy'").first().path == "/f/00003.csv"
    plan = skip.batch_winners(files)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "collect" not in plan


def test_timed_out_files_come_back(spark):
    table = led.processed_files(events(spark, ("a.csv", "", "1", "TIMEOUT", 1, False), ("b.csv", "", "1", "COMPLETED", 1, False)))
    files = spark.createDataFrame([("/x/a.csv", ""), ("/x/b.csv", "")], "path string, source_zip string")
    assert [r.path for r in skip.timed_out(files, table).collect()] == ["/x/a.csv"]
    assert [r.path for r in skip.skip_by_name(files, table).collect()] == ["/x/a.csv"]


def test_single_file_interface(spark, lake):
    assert lake.get_file_status("/in/a.csv") is None
    assert not lake.is_file_processed_by_path("/in/a.csv")
    lake.mark_file_as_in_progress("/in/a.csv", "h1")
    assert lake.get_file_status("/other/a.csv") == "IN_PROGRESS"
    lake.mark_file_as_completed("/in/a.csv", "h1")
    assert lake.is_file_processed_by_path("/in/a.csv") and lake.is_file_processed_by_hash("h1")
    assert not lake.is_file_processed_by_path("/in/a.csv", "/z.zip")
    lake.mark_file_as_failed("/in/a.csv", "h1", "/z.zip")
    lake.mark_file_as_timeout("/in/b.csv", "h2")
    assert lake.get_file_status("a.csv", "/z.zip") == "FAILED" and lake.get_file_status("b.csv") == "TIMEOUT"
    assert not lake.is_file_processed_by_hash("h2")
    assert lake.unmark_file_as_processed("/in/a.csv")
    assert lake.get_file_status("/in/a.csv") is None and not lake.is_file_processed_by_hash("h1")
    lake.mark_file_as_processed("/in/a.csv", "h3")
    assert lake.is_file_processed_by_hash("h3")
    row = lake.execute("SELECT count(*) AS n FROM processed_files WHERE status = ?", ["COMPLETED"]).first()
    assert row.n == 1


def test_ledger_key_by_path(spark, tmp_path):
    from gaugeline import Lake

    by_path = Lake(spark, str(tmp_path / "by_path"), ledger_key="path")
    by_path.mark_file_as_completed("/in/a.csv", "h1")
    assert by_path.is_file_processed_by_path("/in/a.csv") and not by_path.is_file_processed_by_path("/other/a.csv")
