import io
import zipfile

import pyarrow as pa
import pytest
from conftest import HEAD, ROWS
from pyspark.sql import functions as F

from gaugeline.plans.ingest import find_files
from gaugeline.plans.table_queries import _zip_up
from gaugeline.sources import archives, files


def zipped(**entries):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, text in entries.items():
            z.writestr(name.replace("__", "/"), text)
    return buffer.getvalue()


def names(df, root):
    return sorted(r.path.removeprefix(root + "/") for r in df.select("path").collect())


def test_discovery(spark, folder):
    for name in ("test.csv", "test2.csv", "Cond_x.csv", "a/b/User 1.csv", "a/[x]/test+3%.csv", "日本test.csv"):
        folder.put(name, HEAD + ROWS)
    for name in ("other.csv", "test.txt", "test.CSV", "testdir/other2.csv", "cond.csv"):
        folder.put(name, "x")
    folder.put("test_empty.csv", b"")
    got = files.find_csv_files(spark, folder.path, "(Cond|User|test)")
    assert names(got, folder.path) == sorted(
        ["test.csv", "test2.csv", "Cond_x.csv", "a/b/User 1.csv", "a/[x]/test+3%.csv", "日本test.csv", "test_empty.csv"]
    )
    assert {r.source_zip for r in got.collect()} == {""}
    assert got.where("length = 0").count() == 1


def test_listing_reads_no_bytes(spark, folder, monkeypatch):
    """Not even of files that may not be read."""
    import os

    os.chmod(folder.put("test.csv", HEAD), 0)
    assert files.find_csv_files(spark, folder.path, "test").first().length == len(HEAD)


def test_pattern_is_required(spark, folder):
    with pytest.raises(ValueError):
        files.find_csv_files(spark, folder.path, "")


def test_missing_folder_is_empty(spark, folder):
    assert files.find_csv_files(spark, folder.path + "/nothing", "x").count() == 0


def test_extension(spark, folder):
    folder.put("a.csv", "1"), folder.put("s/b.txt", "1"), folder.put("c.txt", "")
    for extension in ("txt", ".txt"):
        assert names(files.find_files_with_extension(spark, folder.path, extension), folder.path) == ["c.txt", "s/b.txt"]


def test_contents_and_hash(spark, folder):
    import hashlib

    odd = folder.put("a [1]{b}*.csv", HEAD)
    other = folder.put("b.csv", "different content")
    got = {r.path: r.h for r in files.read_contents(spark, [odd, other]).select("path", F.sha2("content", 256).alias("h")).collect()}
    assert got == {p: hashlib.sha256(open(p, "rb").read()).hexdigest() for p in (odd, other)}


def test_archives(spark, folder):
    folder.put("a.zip", zipped(d__User_1="", **{"d/User_1.csv": HEAD, "x.txt": "t", "User.CSV": "t", "skip.csv": "t"}))
    folder.put("s/b.zip", zipped(**{"d/User_1.csv": HEAD + ROWS}))
    folder.put("bad.zip", "this is no archive")
    folder.put("test.csv", HEAD)
    found = find_files(spark, folder.path, "(Cond|User|test)")
    got = sorted((r.path.removeprefix(folder.path), r.source_zip.removeprefix(folder.path), r.length) for r in found.collect())
    assert [g for g in got if g[0] != "/bad.zip"] == [
        ("/test.csv", "", len(HEAD)),
        ("d/User_1.csv", "/a.zip", len(HEAD)),
        ("d/User_1.csv", "/s/b.zip", len(HEAD + ROWS)),
    ]
    bad = found.where("error IS NOT NULL").collect()
    assert len(bad) == 1 and bad[0].path.endswith("bad.zip") and bad[0].source_zip == "" and "invalid archive" in bad[0].error


def test_unreadable_entry_is_reported(spark):
    data = zipped(**{"test_1.csv": HEAD * 50, "test_2.csv": "fine"})
    broken = data.replace(HEAD.encode()[:30], b"?" * 30, 1)
    df = spark.createDataFrame([("/z", broken)], "path string, content binary")
    got = {r.path: (r.error is None, r.content is None) for r in archives.explode_archives(df).collect()}
    assert got == {"test_1.csv": (False, True), "test_2.csv": (True, False)}


def test_last_of_equal_entry_names_counts(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z, pytest.warns(UserWarning):
        z.writestr("t.csv", "old"), z.writestr("t.csv", "new")
    df = spark.createDataFrame([("/z", buffer.getvalue())], "path string, content binary")
    assert [bytes(r.content) for r in archives.explode_archives(df).collect()] == [b"new"]


def test_extraction(spark, folder):
    at = folder.put("z.zip", zipped(**{"a/t.csv": "1", "b/t.csv": "2", "u.csv": "3"}))
    asked = spark.createDataFrame(
        [(at, p) for p in ("b\\t.csv", "a/t.csv", "other/t.csv", "t.csv", "u.csv", "gone.csv")] + [(folder.path + "/no.zip", "a.csv")], "source_zip string, path string"
    )
    got = {r.requested: (r.entry_path, r.content and bytes(r.content), r.error) for r in archives.extract_entries(asked).collect()}
    assert got == {
        "b\\t.csv": ("b/t.csv", b"2", None),
        "a/t.csv": ("a/t.csv", b"1", None),
        "other/t.csv": ("a/t.csv", b"1", None),
        "t.csv": ("a/t.csv", b"1", None),
        "u.csv": ("u.csv", b"3", None),
        "gone.csv": (None, None, "not found in archive: gone.csv"),
        "a.csv": (None, None, "missing file"),
    }


def test_extracted_contents_are_not_joined(spark, folder):
    """Requests for one entry read it once and get a row each; no join, exchange or broadcast holds contents."""
    at = folder.put("z.zip", zipped(**{"a/t.csv": "1" * 5000, "u.csv": "3"}))
    names = ["a/t.csv", "a\\t.csv", "t.csv", "t.csv", "gone.csv", None]
    found = archives.extract_entries(spark.createDataFrame([(at, p) for p in names], "source_zip string, path string"))
    rows = sorted((r.requested or "", r.entry_path, r.content and len(r.content), r.error) for r in found.collect())
    assert rows == [
        ("", None, None, None),
        ("a/t.csv", "a/t.csv", 5000, None),
        ("a\\t.csv", "a/t.csv", 5000, None),
        ("gone.csv", None, None, "not found in archive: gone.csv"),
        ("t.csv", "a/t.csv", 5000, None),
        ("t.csv", "a/t.csv", 5000, None),
    ]
    left = [found._jdf.queryExecution().optimizedPlan()]
    while left:
        node = left.pop()
        assert node.nodeName() != "Join" or "content#" not in node.output().mkString(",")
        left += [node.children().apply(i) for i in range(node.children().size())]


def test_many_large_entries_stream_out(spark):
    data = zipped(**{f"t{i}.csv": "x" * (3 << 20) for i in range(12)})
    df = spark.createDataFrame([("/z", data)], "path string, content binary")
    got = archives.explode_archives(df).select(F.length("content").alias("n")).collect()
    assert [r.n for r in got] == [3 << 20] * 12


def test_archives_are_made_a_few_at_a_time():
    text = "".join(chr(33 + i * i * i % 90) + hex(i) for i in range(4000))
    docs = pa.RecordBatch.from_pydict({"doc_id": list(range(700)), "text": [f"{i}{text}" for i in range(700)]})
    made = list(_zip_up(iter([docs, docs.slice(0, 5)])))
    assert [p for b in made for p in b["path"].to_pylist()] == [f"/zip/{i}.zip" for i in [*range(700), *range(5)]]
    assert len(made) > 2 and max(b.nbytes for b in made) < 6 << 20
