import io
import shutil
import zipfile

import pytest
from conftest import HEAD, ROWS
from pyspark.sql import functions as F

from gaugeline import Lake, Options, ingest_files, ingest_folder, stream_ingest
from gaugeline.plans import ingest as plan
from gaugeline.plans.cli import main
from gaugeline.schemas import LISTING, READINGS, READING_COLUMNS
from gaugeline.sources.files import listing_of

META = {"factory": "F1", "machine_id": "M7", "data_label": "２０２４年点検"}


def run(lake, folder, **kw):
    ingest_id = kw.pop("ingest_id", None)
    options = Options(encoding="utf-8", meta=META, **kw)
    return tuple(ingest_folder(lake, folder.path, "(Cond|User|test)", ingest_id, options).first())


def table(lake):
    return sorted(map(str, lake.readings().collect()))


def statuses(lake):
    return {(r.file_path, r.source_zip.rsplit("/", 1)[-1]): r.status for r in lake.processed_files().collect()}


def test_ingest_then_skip_by_name_then_by_content_then_all(spark, lake, folder):
    folder.put("test.csv", HEAD + ROWS)
    assert run(lake, folder) == (1, 0, 0, 1, 0, 0)
    first = table(lake)
    assert len(first) == 8
    df = lake.readings()
    assert df.columns == READING_COLUMNS and df.schema == READINGS
    row = df.where("value = 'a'").first()
    assert (row.source_file, row.source_zip, row.factory, row.machine_id, row.data_label) == (
        folder.path + "/test.csv", "", "F1", "M7", "２０２４年点検",
    )
    assert run(lake, folder) == (1, 1, 0, 0, 0, 0)
    folder.put("test_renamed.csv", HEAD + ROWS)
    assert run(lake, folder) == (2, 1, 1, 0, 0, 0)
    assert table(lake) == first
    assert run(lake, folder, process_all=True) == (2, 0, 0, 2, 0, 0)
    assert lake.readings().count() == 24
    assert lake.readings(latest_only=True).count() == 16


def test_failures_are_recorded_and_isolated(spark, lake, folder):
    folder.put("test_ok.csv", HEAD + ROWS)
    folder.put("test_time.csv", HEAD + "xx,1,2,3,4,\n")
    folder.put("test_empty.csv", "")
    folder.put("test_head.csv", HEAD)
    assert run(lake, folder) == (4, 0, 0, 2, 2, 0)
    assert statuses(lake) == {
        ("test_ok.csv", ""): "COMPLETED",
        ("test_head.csv", ""): "COMPLETED",
        ("test_time.csv", ""): "FAILED",
        ("test_empty.csv", ""): "FAILED",
    }
    reasons = {r.file_path: r.reason for r in lake.events().where("status = 'FAILED'").collect()}
    assert reasons == {"test_time.csv": "unparsable Time", "test_empty.csv": "empty file"}
    assert lake.readings().count() == 8
    folder.put("test_time.csv", HEAD + ROWS.replace("2024", "2025"))
    assert run(lake, folder) == (4, 2, 0, 1, 1, 0)
    assert statuses(lake)[("test_time.csv", "")] == "COMPLETED"


def test_copies_in_one_batch(spark, lake, folder, tmp_path):
    for name in ("a/test.csv", "b/test_1.csv", "c/test_2.csv"):
        folder.put(name, HEAD + ROWS)
    assert run(lake, folder) == (3, 0, 2, 1, 0, 0)
    assert {r.source_file for r in lake.readings().collect()} == {folder.path + "/a/test.csv"}
    literal = Lake(spark, str(tmp_path / "literal"))
    assert run(literal, folder, dedup_within_batch=False) == (3, 0, 0, 3, 0, 0)
    assert literal.readings().count() == 24


def test_archives_next_to_loose_files(spark, lake, folder):
    for name, day in (("a.zip", 2), ("s/b.zip", 3)):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as z:
            z.writestr("d/User_1.csv", HEAD + ROWS.replace("3/5 ", f"3/{day} "))
            z.writestr("d/bad_test.csv", HEAD + "never,1,2,3,4,\n")
            z.writestr("notes.txt", "x")
        folder.put(name, buffer.getvalue())
    folder.put("broken_test.zip", "x")
    folder.put("test.csv", HEAD + ROWS)
    assert run(lake, folder) == (6, 0, 0, 3, 3, 0)  # the broken archive is a failure of its own
    got = lake.readings().groupBy("source_file", "source_zip").count().collect()
    assert sorted((r.source_file.removeprefix(folder.path), r.source_zip.removeprefix(folder.path), r["count"]) for r in got) == [
        ("/test.csv", "", 8),
        ("d/User_1.csv", "/a.zip", 8),
        ("d/User_1.csv", "/s/b.zip", 8),
    ]
    assert statuses(lake)[("User_1.csv", "b.zip")] == "COMPLETED" and statuses(lake)[("broken_test.zip", "")] == "FAILED"
    reasons = {r.file_path: r.reason for r in lake.events().where("status = 'FAILED'").collect()}
    assert "invalid archive" in reasons["broken_test.zip"]
    assert run(lake, folder) == (6, 3, 0, 0, 3, 0)


def test_large_files_give_the_same_rows(spark, folder, tmp_path):
    body = "".join(f"2024/1/{1 + i // 1440} {i // 60 % 24}:{i % 60}:00,{i},{i % 5},{i},x,\n" for i in range(3000))
    folder.put("test_a.csv", HEAD + body)
    folder.put("test_b.csv", HEAD + body + body)
    folder.put("test_c.csv", HEAD + body + "xx,1,2,3,4,\n")
    whole, lines = Lake(spark, str(tmp_path / "whole")), Lake(spark, str(tmp_path / "lines"))
    assert run(whole, folder) == (3, 0, 0, 2, 1, 0)
    assert run(lines, folder, whole_file_bytes=1000, split_bytes=20_000) == (3, 0, 0, 2, 1, 0)
    assert table(whole) == table(lines) and len(table(whole)) == 18_000
    assert run(lines, folder, whole_file_bytes=1000, split_bytes=50_000, process_all=False)[1] == 2
    folder.put("test_d.csv", HEAD + body)
    assert run(lines, folder, whole_file_bytes=1000) == (4, 2, 1, 0, 1, 0)


CHARSETS = {
    "auto": ["shift_jis", "euc_jp", "utf-8", "utf-8-sig", "utf-16", "iso2022_jp"],
    "shift-jis": ["shift_jis"], "utf-16": ["utf-16", "utf-16-be"], "utf-32": ["utf-32"], "iso-2022-jp": ["iso2022_jp"],
}


@pytest.mark.parametrize("encoding", CHARSETS)
def test_charsets_give_the_same_at_every_size(spark, folder, tmp_path, encoding):
    """Quoted line ends, commas and quotes, and bad bytes where the charset allows them; whole and in splits."""
    head = ",1,2\n,温度ソ,表\n,℃,-\n"
    for codec in CHARSETS[encoding]:
        body = "".join(f'2024/1/1 {i // 60}:{i % 60}:00,"能{i},""\n能 {codec}",2,\r\n' for i in range(200))
        folder.put(f"test_{codec}.csv", (head + body).encode(codec))
        if codec in ("shift_jis", "utf-8-sig"):
            folder.put(f"test_bad_{codec}.csv", (head + body).encode(codec) + b"2024/1/2 0:0:0,\x81\xff,2,\n")
    got = []
    for name, sizes in (("whole", {}), ("lines", {"whole_file_bytes": 1000, "split_bytes": 2000})):
        lake = Lake(spark, str(tmp_path / name))
        stats = ingest_folder(lake, folder.path, "test", options=Options(encoding=encoding, **sizes))
        hashes = sorted((r.file_path, r.file_hash, r.status) for r in lake.processed_files().collect())
        got.append((tuple(stats.first()), hashes, table(lake)))
    assert got[0][0][4] == 0 and got[0] == got[1]
    values = [r.value for r in lake.readings().where("sensor_name = '温度ソ'").collect()]
    for codec in CHARSETS[encoding]:
        assert f'能199,"\n能 {codec}' in values


@pytest.mark.parametrize("split_bytes", [64, 1 << 20])
def test_one_content_whole_large_and_archived(spark, folder, tmp_path, split_bytes):
    """Hashes agree, so of three copies on the three ways one is ingested, and a later one on another way is known."""
    body = HEAD + "".join(f'2024/3/{1 + i // 24} {i % 24}:00:00,{i},"a\n{i}",x,{i},\n' for i in range(100))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("d/test_in.csv", body)
        z.writestr("d/test_other.csv", body.replace("2024", "2025"))
    folder.put("a.zip", data.getvalue())
    folder.put("test_loose.csv", body)
    tables = []
    for name, limit in (("whole", 1 << 20), ("large", 100)):
        lake = Lake(spark, str(tmp_path / name))
        assert run(lake, folder, whole_file_bytes=limit, split_bytes=split_bytes) == (3, 0, 1, 2, 0, 0)
        tables.append(table(lake))
        assert len(tables[-1]) == 800
    assert tables[0] == tables[1]
    folder.put("test_again.csv", body)
    assert run(lake, folder, whole_file_bytes=1 << 20)[1:4] == (2, 2, 0)


@pytest.mark.parametrize("few", [True, False])
def test_only_repeated_times_reach_the_distinct(spark, folder, tmp_path, monkeypatch, few):
    """Equal rows collapse in large files, wherever they lie; with many repeated times as with few."""
    monkeypatch.setattr(plan, "REPEATED_TIMES", 10 if few else 0)
    lines = [f"2024/3/{1 + i // 24} {i % 24}:00:00,{i},{i % 3},x,{i},\n" for i in range(200)]
    folder.put("test_a.csv", HEAD + "".join(lines) + lines[7] + lines[7].replace(",7,", ",8,") + lines[150])
    folder.put("test_b.csv", HEAD + "".join(lines[::-1]))
    folder.put("test_c.csv", HEAD.replace("fan", "fan\x01") + "".join(lines) + ",1,2,3,4,\n" * 2)
    got = []
    for limit in (1 << 20, 100):
        lake = Lake(spark, str(tmp_path / str(limit)))
        assert run(lake, folder, whole_file_bytes=limit, split_bytes=700) == (3, 0, 0, 3, 0, 0)
        got.append(table(lake))
    assert got[0] == got[1] and len(got[0]) > 2000


@pytest.mark.parametrize("at_once", [100_000, 4])
def test_files_with_repeated_times_are_read_once_in_the_second_pass(spark, lake, folder, monkeypatch, at_once):
    """Neither a second parse nor a shuffle, unless a time has more cells than a row is to hold."""
    lines = [f"2024/3/{1 + i // 24} {i % 24}:00:00,{i},{i % 3},x,{i},\n" for i in range(50)]
    folder.put("test_a.csv", HEAD + "".join(lines) + lines[7] + lines[7].replace(",7,", ",8,"))
    folder.put("test_b.csv", HEAD.replace("fan", "fan\x01") + "".join(lines[::-1]) + ",1,2,3,4,\n" * 2)
    plans, write = [], plan.write_batch
    monkeypatch.setattr(plan, "write_batch", lambda df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, *a))
    assert run(lake, folder, cells_at_once=at_once) == (2, 0, 0, 2, 0, 0)
    assert len(table(lake)) == len(set(table(lake))) == 2 * 50 * 4 + 2 + 4
    assert [p.count("MapInArrow") for p in plans] == ([1] if at_once > 4 else [1, 1])
    assert "StringDecode" in plans[0] and plans[0].count("Exchange hashpartitioning") == plans[0].count("REPARTITION_BY_NUM") == 1


@pytest.mark.parametrize("encoding", ["utf-8", "auto"])
def test_tables_of_names_are_broadcast_by_their_rows_only(spark, folder, tmp_path, monkeypatch, encoding):
    """The files of such tables are small, however much their names take in memory."""
    from pyspark.sql.readwriter import DataFrameWriter

    body = "".join(f'2024/1/1 0:00:{i:02d},{i},"x\ny",{i % 3},4,\n' for i in range(50))
    folder.put("test_0.csv", HEAD + ROWS)
    folder.put("test_1.csv", HEAD + body)
    folder.put("test_2.csv", HEAD + body.replace(":07,", ":08,"))  # a time that repeats
    folder.put("sub/test_3.csv", HEAD + body.replace("x", "日本"))
    with zipfile.ZipFile(f"{folder.path}/a.zip", "w") as z:
        z.writestr("d/test_4.csv", HEAD + body.replace("x", "z"))
        z.writestr("d/test_5.csv", HEAD + ROWS.replace("2,", "9,"))
    plain, plans = DataFrameWriter.parquet, {}

    def parquet(self, path, *args, **kw):
        if "/work/" in path or "/readings/" in path:
            plans.setdefault(path.split("/work/")[-1].split("/")[-1], []).append(self._df._jdf.queryExecution().executedPlan().toString())
        return plain(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)

    def ingested(name):
        plans.clear()
        lake = Lake(spark, str(tmp_path / name))
        options = Options(encoding=encoding, meta=META, whole_file_bytes=600, split_bytes=300)
        assert tuple(ingest_folder(lake, folder.path, "test", "one", options).first()) == (6, 0, 0, 6, 0, 0)
        return table(lake)

    want = ingested("few")
    monkeypatch.setattr("gaugeline.session.FEW_ROWS", 0, raising=False)
    monkeypatch.setattr(plan.wide, "lookup_fits", lambda profiles: False)
    monkeypatch.setattr(plan, "REPEATED_TIMES", 0)
    assert ingested("many") == want
    # what the others join (hashes of the ledger, first files of a content) comes out of a shuffle, whose size in memory is known
    joined = {name: texts for name, texts in plans.items() if name in ("files", "charsets", "scanned", "splits", "runs", "repeated", "lines", "ingest_id=one")}
    assert len(joined) == 8 and len(joined["ingest_id=one"]) > 1
    assert not {name for name, texts in joined.items() if any("Broadcast" in t for t in texts)}


def test_headers_longer_than_a_split(spark, folder, tmp_path):
    wide_head = "".join("," + ",".join(f'"{n} {i}\nx"' for i in range(40)) + "\n" for n in ("id", "name", "unit"))
    folder.put("test.csv", wide_head + "2024/3/5 7:30:0," + ",".join(map(str, range(40))) + ",\n")
    got = []
    for limit in (1 << 20, 1):
        lake = Lake(spark, str(tmp_path / str(limit)))
        assert run(lake, folder, whole_file_bytes=limit, split_bytes=50) == (1, 0, 0, 1, 0, 0)
        got.append(table(lake))
    assert got[0] == got[1] and len(got[0]) == 40


def test_open_quotes_fail_on_both_ways(spark, folder, tmp_path):
    folder.put("test_a.csv", HEAD + ROWS + '2024/3/6 0:0:0,"1,2,3,4,\n' + ROWS.replace('"', ""))
    folder.put("test_b.csv", HEAD + ROWS + '2024/3/6 0:0:0,"a ""b" c,2,3,4,\n')  # never quoted: its quotes are text
    for limit in (1 << 20, 1):
        lake = Lake(spark, str(tmp_path / str(limit)))
        assert run(lake, folder, whole_file_bytes=limit, split_bytes=64) == (2, 0, 0, 1, 1, 0)
        assert {r.reason for r in lake.events().where("status = 'FAILED'").collect()} == {"unbalanced quotes"}
        assert lake.readings().where("value = '\"a \"\"b\" c'").count() == 1


def test_many_files(spark, lake, folder):
    for i in range(12):
        folder.put(f"test_{i}.csv", HEAD + ROWS.replace(",1,", f",{i},"))
    assert run(lake, folder) == (12, 0, 0, 12, 0, 0)
    assert lake.readings().count() == 12 * 8


def test_control_characters(spark, lake, folder):
    folder.put("test.csv", ",A\n,a\x0b,\n,x\n2024/3/5 7:30:0,1\x00\x7f\t2,\n")
    run(lake, folder)
    row = lake.readings().first()
    assert (row.value, row.sensor_name) == ("1\t2", "a")


def test_missing_files_of_a_given_list(spark, lake, folder):
    here = folder.put("test.csv", HEAD + ROWS)
    listing = listing_of(spark, [here, folder.path + "/gone.csv"])
    assert tuple(ingest_files(lake, listing, encoding="utf-8").first()) == (2, 0, 0, 1, 1, 0)
    assert statuses(lake)[("gone.csv", "")] == "FAILED"


def test_crash_between_data_and_ledger(spark, lake, folder, monkeypatch):
    folder.put("test.csv", HEAD + ROWS)

    def die(*_):
        raise RuntimeError("executor lost for good")

    with monkeypatch.context() as m:
        m.setattr(Lake, "commit", die)
        with pytest.raises(RuntimeError):
            run(lake, folder, ingest_id="batch")
    assert lake.readings().count() == 0
    assert statuses(lake) == {("test.csv", ""): "IN_PROGRESS"}
    assert run(lake, folder, ingest_id="batch") == (1, 0, 0, 1, 0, 0)
    assert lake.readings().count() == 8 and statuses(lake) == {("test.csv", ""): "COMPLETED"}
    assert run(lake, folder, ingest_id="batch") == (1, 0, 0, 1, 0, 0)  # committed: not run again
    assert lake.readings().count() == 8


def test_crash_is_also_mended_by_a_new_batch(spark, lake, folder, monkeypatch):
    folder.put("test.csv", HEAD + ROWS)
    with monkeypatch.context() as m:
        m.setattr(plan, "emit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(lake, folder)
    assert run(lake, folder) == (1, 0, 0, 1, 0, 0)
    assert lake.readings().count() == 8


def test_rollback(spark, lake):
    from gaugeline.operators.sinks import write_batch

    df = spark.createDataFrame([(None, "1", "a", "b", "c", "f", "", "x", "y", "z")], READINGS)
    assert write_batch(df, lake.readings_path, "open") == 1
    lake.rollback("open")
    assert lake.readings().count() == 0
    lake.commit("open")
    assert lake.readings().count() == 0
    with pytest.raises(ValueError):
        lake.rollback("open")


def test_insert(spark, lake):
    df = spark.createDataFrame([(None, "1\x01", "a", "b", "c", "f", "", "x", "y", "z")] * 2, READINGS)
    assert lake.insert_sensor_data(None) == 0
    assert lake.insert_sensor_data(df.limit(0)) == 0
    assert lake.insert_sensor_data(df) == 2
    assert [r.value for r in lake.readings().collect()] == ["1", "1"]
    assert lake.execute("SELECT count(*) AS n FROM sensor_data").first().n == 2


class Dying(Lake):
    """A lake whose batches die before their commit."""

    def commit(self, *args, **kwargs):
        raise RuntimeError("dead")


def test_retries_publish_nothing_twice(spark, lake, folder):
    folder.put("test_1.csv", HEAD + ROWS)
    folder.put("test_2.csv", HEAD + ROWS.replace(",1,", ",9,"))
    dying = Dying(spark, lake.root)
    for process_all in (False, True):
        with pytest.raises(RuntimeError):
            run(dying, folder, ingest_id="one", process_all=process_all, whole_file_bytes=1)
    assert lake.readings().count() == 0
    run(lake, folder, ingest_id="two")
    rows = table(lake)
    with pytest.raises(RuntimeError):
        run(dying, folder, ingest_id="three", process_all=True)
    assert run(lake, folder, ingest_id="one")[1] == 2 and table(lake) == rows
    assert run(lake, folder)[1] == 2 and table(lake) == rows


def test_a_committed_id_takes_no_other_files(lake, folder):
    folder.put("test_1.csv", HEAD + ROWS)
    first = run(lake, folder, ingest_id="one")
    assert run(lake, folder, ingest_id="one") == first
    folder.put("test_2.csv", HEAD + ROWS)
    with pytest.raises(ValueError):
        run(lake, folder, ingest_id="one")


def test_compaction_changes_nothing(lake, folder):
    for i in range(3):
        folder.put(f"test_{i}.csv", HEAD + ROWS.replace(",1,", f",{i},"))
        run(lake, folder)
    before = table(lake), sorted(map(tuple, lake.processed_files().collect()))
    lake.compact()
    assert (table(lake), sorted(map(tuple, lake.processed_files().collect()))) == before


def test_a_crash_in_compaction_leaves_everything(spark, lake, folder, monkeypatch):
    """It may die after each of its writes; the lake stays as it was and takes up no file again."""
    from gaugeline.plans import lake as lake_module

    for i in range(2):
        folder.put(f"test_{i}.csv", HEAD + ROWS.replace(",1,", f",{i},"))
        run(lake, folder)
    before = table(lake), sorted(map(tuple, lake.processed_files().collect()))
    written = lake_module.read_or_empty

    def dying(after):
        left = [after]

        def read(*args):
            left[0] -= 1
            if left[0] < 0:
                raise InterruptedError
            return written(*args)

        return read

    for after in (0, 1, 2):
        with monkeypatch.context() as m:
            m.setattr(lake_module, "read_or_empty", dying(after))
            try:
                lake.compact()
            except InterruptedError:
                pass
        assert (table(lake), sorted(map(tuple, lake.processed_files().collect()))) == before
    with monkeypatch.context() as m:
        m.setattr(Lake, "_put", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lake.compact()
    assert (table(lake), sorted(map(tuple, lake.processed_files().collect()))) == before
    for _ in range(3):
        lake.compact()
        assert (table(lake), sorted(map(tuple, lake.processed_files().collect()))) == before
    assert run(lake, folder) == (2, 2, 0, 0, 0, 0)
    assert len(lake.versions()) < 8


def test_two_writers_take_no_file_twice(spark, lake, folder, monkeypatch):
    """A second writer commits, compacts and marks files while a batch is written: the batch decides anew."""
    folder.put("test_1.csv", HEAD + ROWS)
    folder.put("test_2.csv", HEAD + ROWS.replace(",1,", ",2,"))
    other, emit, calls = Lake(spark, lake.root), plan.emit, []

    def while_another_writes(*args):
        calls.append(1)
        if len(calls) == 1:
            with monkeypatch.context() as m:
                m.setattr(plan, "emit", emit)
                one = listing_of(spark, [folder.path + "/test_1.csv"])
                assert tuple(ingest_files(other, one, "other", Options(encoding="utf-8", meta=META)).first()) == (1, 0, 0, 1, 0, 0)
            other.compact()
            other.mark_file_as_timeout("later.csv", "h")
        return emit(*args)

    monkeypatch.setattr(plan, "emit", while_another_writes)
    assert run(lake, folder, ingest_id="one") == (2, 1, 0, 1, 0, 0)
    assert len(calls) == 2 and lake.readings().count() == 16
    assert statuses(lake) == {("test_1.csv", ""): "COMPLETED", ("test_2.csv", ""): "COMPLETED", ("later.csv", ""): "TIMEOUT"}


def test_a_number_is_taken_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from gaugeline.session import list_names, put_if_absent, read_text

    path = str(tmp_path / "log" / "1.json")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: put_if_absent(spark, path, f"text {i}"), range(8)))
    assert won.count(True) == 1 and read_text(spark, path) == f"text {won.index(True)}"
    assert list_names(spark, str(tmp_path / "log")) == ["1.json"] and list_names(spark, str(tmp_path / "no")) == []


def test_events_of_a_replaced_ledger_are_kept(spark, lake, monkeypatch):
    lake.mark_file_as_completed("a.csv", "h1")
    state, other, calls = lake.state, Lake(spark, lake.root), []

    def then_compact():
        found = state()
        if not calls:
            calls.append(1)
            other.compact()
        return found

    monkeypatch.setattr(lake, "state", then_compact)
    lake.mark_file_as_failed("b.csv", "h2")
    assert other.get_file_status("a.csv") == "COMPLETED" and other.get_file_status("b.csv") == "FAILED"


def test_streams_with_other_checkpoints_and_archives(spark, lake, folder, tmp_path):
    options = Options(encoding="utf-8", meta=META)
    folder.put("x[1]/test_1.csv", HEAD + ROWS)
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("User_2.csv", HEAD + ROWS.replace(",1,", ",2,"))
    folder.put("x[1]/a.zip", data.getvalue())
    folder.put("y/test_3.csv", HEAD + ROWS.replace(",1,", ",3,"))
    for name in ("x[1]", "y"):
        stream_ingest(lake, f"{folder.path}/{name}", str(tmp_path / f"checkpoint-{name[0]}"), "(test|User)", options=options).awaitTermination()
    assert len(table(lake)) == 24


def test_a_vanished_file_fails_alone(spark, lake, folder):
    import os

    here, gone = folder.put("test_1.csv", HEAD + ROWS), folder.put("test_2.csv", HEAD + ROWS + ROWS.replace("2024", "2025"))
    from gaugeline.plans.ingest import find_files

    listing = spark.createDataFrame(find_files(spark, folder.path, "test").collect(), LISTING)
    os.remove(gone)
    assert tuple(ingest_files(lake, listing, options=Options(encoding="utf-8", meta=META)).first())[3:5] == (1, 1)
    assert os.path.exists(here) and len(table(lake)) == 8


@pytest.mark.parametrize("limit", [1 << 20, 10])
def test_what_vanishes_between_the_passes_fails_alone(spark, lake, folder, monkeypatch, limit):
    """A loose file, a changed file and an archive go after they were profiled; the rest of the batch is published."""
    import os

    for i in range(3):
        folder.put(f"test_{i}.csv", HEAD + ROWS.replace(",1,", f",{i},"))
    for name in ("a", "b"):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            z.writestr(f"User_{name}.csv", HEAD + ROWS.replace("2024", "2025" if name == "a" else "2026"))
        folder.put(f"{name}.zip", data.getvalue())
    decide = plan.decide

    def and_then_go(*args):
        os.path.exists(folder.path + "/a.zip") and os.remove(folder.path + "/a.zip")
        os.path.exists(folder.path + "/test_1.csv") and os.remove(folder.path + "/test_1.csv")
        folder.put("test_2.csv", HEAD + ROWS + ROWS)
        return decide(*args)

    monkeypatch.setattr(plan, "decide", and_then_go)
    assert run(lake, folder, whole_file_bytes=limit, split_bytes=64) == (5, 0, 0, 2, 3, 0)
    assert statuses(lake) == {
        ("test_0.csv", ""): "COMPLETED", ("test_1.csv", ""): "FAILED", ("test_2.csv", ""): "FAILED",
        ("User_a.csv", "a.zip"): "FAILED", ("User_b.csv", "b.zip"): "COMPLETED",
    }
    assert sorted({r.source_file.rsplit("/", 1)[-1] for r in lake.readings().collect()}) == ["User_b.csv", "test_0.csv"]
    assert lake.readings().count() == 16


def test_files_without_a_sensor(spark, lake, folder):
    folder.put("test_1.csv", ",a\n,-\n,-\n2024/3/5 7:30:0,1,\n")
    folder.put("test_2.csv", ",a\n,-\n,-\n" + "2024/3/5 7:30:0,1,\n" * 50)
    assert run(lake, folder, whole_file_bytes=100) == (2, 0, 0, 2, 0, 0) and table(lake) == []


def test_hidden_names_and_python_patterns(spark, lake, folder):
    for i, name in enumerate(("_test.csv", ".test.csv", "_d/.e/test_x.csv")):
        folder.put(name, HEAD + ROWS.replace(",1,", f",{i + 7},"))
    stats = ingest_folder(lake, folder.path, "(?P<kind>test)", options=Options(encoding="utf-8", meta=META))
    assert tuple(stats.first()) == (3, 0, 0, 3, 0, 0) and lake.readings().count() == 24


def test_stream_equals_batch(spark, folder, tmp_path):
    streamed, batch = Lake(spark, str(tmp_path / "streamed")), Lake(spark, str(tmp_path / "batch"))
    options = Options(encoding="utf-8", meta=META)

    def trickle():
        stream_ingest(streamed, folder.path, str(tmp_path / "checkpoint"), "test", max_files_per_trigger=2, options=options).awaitTermination()

    for i in range(3):
        folder.put(f"test_{i}.csv", HEAD + ROWS.replace(",1,", f",{i},"))
    folder.put("other.csv", HEAD + ROWS)
    trickle()
    assert len(streamed.commits().collect()) == 2
    trickle()
    assert len(streamed.commits().collect()) == 2
    folder.put("test_3.csv", HEAD + ROWS.replace(",1,", ",33,"))
    trickle()
    ingest_folder(batch, folder.path, "test", options=options)
    assert table(streamed) == table(batch) and len(table(batch)) == 32


def test_stream_over_a_mixed_folder_equals_the_batch(spark, folder, tmp_path):
    """Empty and hidden files, archives good and bad, an odd name; readings, states and reasons."""
    folder.put("test_1.csv", HEAD + ROWS)
    folder.put("test_empty.csv", "")
    folder.put("_test_2.csv", HEAD + ROWS.replace(",1,", ",2,"))
    folder.put("x/.test_3.csv", HEAD + "never,1,2,3,4,\n")
    folder.put("x/other.csv", HEAD + ROWS)
    folder.put("x/bad.zip", "no archive")
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("d/User_1.csv", HEAD + ROWS.replace("2024", "2025"))
        z.writestr("d/User_none.csv", "")
    folder.put("a.zip", data.getvalue())
    options, got = Options(encoding="utf-8", meta=META), []
    streamed, batch = Lake(spark, str(tmp_path / "streamed")), Lake(spark, str(tmp_path / "batch"))
    stream_ingest(streamed, folder.path, str(tmp_path / "checkpoint"), "(?P<k>test|User)", max_files_per_trigger=3, options=options).awaitTermination()
    ingest_folder(batch, folder.path, "(?P<k>test|User)", options=options)
    for lake in (streamed, batch):
        events = lake.events().where("status IN ('COMPLETED', 'FAILED')").select("file_path", "source_zip", "file_hash", "status", "reason", "full_path")
        got.append((table(lake), sorted(map(str, events.collect()))))
    assert got[0] == got[1] and len(got[0][0]) == 24 and len(got[0][1]) == 7
    assert len(streamed.commits().collect()) == 3  # seven files, three at a time


def test_command_line(spark, folder, tmp_path):
    folder.put("Cond_1.csv", (HEAD + ROWS).encode("shift_jis"))
    stats = main(["--folder", folder.path, "--lake", str(tmp_path / "cli"), "--factory", "X", "--machine-id", "No.9"])
    assert stats == {
        "total_found": 1, "already_processed_by_path": 0, "already_processed_by_hash": 0,
        "newly_processed": 1, "failed": 0, "timeout": 0,
    }
    row = Lake(spark, str(tmp_path / "cli")).readings().first()
    assert (row.factory, row.machine_id, row.data_label) == ("X", "No.9", "２０２４年点検")
    assert main(["--folder", folder.path, "--lake", str(tmp_path / "cli")])["already_processed_by_path"] == 1


def test_shared_dir_follows_the_session(spark):
    from gaugeline.session import shared_dir

    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(base) and shared_dir(spark, "x") != shared_dir(spark, "x")
