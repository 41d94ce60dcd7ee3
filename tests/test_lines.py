import random

import pytest
from conftest import HEAD, readings

from gaugeline.operators import wide
from gaugeline.sources import files, opened, wide_text


def body(n, start=0):
    return "".join(f"2024/1/{1 + i // 1440} {i // 60 % 24}:{i % 60}:00,{i},{i % 7},\"x,{i}\",y,\n" for i in range(start, start + n))


def lines_of(spark, paths, encoding="utf-8", split=20_000):
    return wide.decode_lines(spark, wide_text.read_lines(spark, paths, split), encoding)


def test_lines_mode_equals_whole_file_mode(spark, folder):
    path = folder.put("sub dir/test+100%.csv", HEAD + body(4000))
    lines = lines_of(spark, [path]).persist()
    assert lines.select("chunk").distinct().count() > 3
    assert {r.header_no for r in lines.select("header_no").distinct().collect()} == {None, 0, 1, 2}
    assert lines.select("path").distinct().collect()[0].path == path
    profiles = wide.profile_lines(lines).persist()
    assert profiles.first().error is None and profiles.first().repeats == wide.NOWHERE
    small = spark.createDataFrame([(path, "", open(path, "rb").read())], "path string, source_zip string, content binary")
    want = readings(wide.wide_to_long(spark, small, "utf-8"))
    assert len(want) == 4 * 4000
    for broadcastable in (True, False):
        assert readings(wide.readings_from_lines(lines, profiles, broadcastable)) == want


def test_shift_jis_survives_the_split(spark, folder):
    head = ",1,2\n,温度ソ,表\n,℃,-\n"
    text = head + "".join(f"2024/1/1 {i // 3600}:{i // 60 % 60}:{i % 60},能{i},ソ{i},\n" for i in range(3000))
    path = folder.put("test.csv", text.encode("shift_jis"))
    lines = lines_of(spark, [path], "shift-jis", 10_000)
    got = readings(wide.readings_from_lines(lines, wide.profile_lines(lines), True))
    assert len(got) == 6000
    assert got[0][1:] == ("ソ0", "2", "表", "-") and ("能5", "1", "温度ソ", "℃") in {r[1:] for r in got}


def test_profile_flags(spark, folder):
    paths = {
        "repeat": HEAD + body(50) + body(1, 7),
        "bad": HEAD + body(50) + "oops,1,2,3,4,\n",
        "short": ",1\n,a\n",
        "open": HEAD + body(5) + '2024/1/9 0:0:0,"1\n2",3,4,5,\n',
        "fine": HEAD + body(50),
    }
    at = {folder.put(f"{name}.csv", text): name for name, text in paths.items()}
    got = {at[r.path]: (r.error, r.repeats == wide.SAME_TIME) for r in wide.profile_lines(lines_of(spark, list(at))).collect()}
    assert got == {
        "repeat": (None, True),
        "bad": ("unparsable Time", False),
        "short": ("fewer than 3 header rows", False),
        "open": (None, False),
        "fine": (None, False),
    }


def test_digests_are_those_of_the_bytes(spark, folder):
    """Of any length, in any order of lines, and whatever the splits: SHA-256."""
    import hashlib

    texts = {"a": HEAD + body(500), "b": HEAD + body(500), "c": HEAD + body(250, 250) + body(250)}
    paths = {folder.put(f"{name}.csv", text): text for name, text in texts.items()}
    work = files.loose_work(files.listing_of(spark, list(paths)))
    got = {r.path: r.file_hash for r in opened.digests(work).collect()}
    assert got == {p: hashlib.sha256(t.encode()).hexdigest() for p, t in paths.items()} and len(set(got.values())) == 2


def test_drop_last_in_lines_mode(spark, folder):
    path = folder.put("t.csv", ",A,B\n,a,b\n,x,y\n2024/3/5 7:30:0,1,2\n")
    lines = lines_of(spark, [path])
    profiles = wide.profile_lines(lines, "drop_last")
    assert [r[1] for r in readings(wide.readings_from_lines(lines, profiles, True))] == ["1"]


def test_broadcast_only_below_the_limit(spark, folder):
    path = folder.put("t.csv", HEAD + body(10))
    profiles = wide.profile_lines(lines_of(spark, [path]))
    assert wide.lookup_fits(profiles)
    assert not wide.lookup_fits(profiles, limit=100)
    lines = lines_of(spark, [path])
    salted = wide.attach_sensors(lines, profiles, False)._jdf.queryExecution().optimizedPlan().toString()
    assert "chunk" in salted and "broadcast" not in salted


def test_runs_tell_what_grouping_by_time_tells(spark, folder):
    """Ordered files are told apart without a shuffle of lines; doubtful ones are those that repeat or aren't in order."""
    shuffled = body(60).splitlines(keepends=True)
    random.Random(1).shuffle(shuffled)
    texts = {
        "ordered": HEAD + body(4000),
        "repeats": HEAD + body(50) + body(1, 49),
        "far": HEAD + body(3000) + body(1),
        "shuffled": HEAD + "".join(shuffled),
        "parts": HEAD + body(100, 100) + body(100),
        "blank": HEAD + body(3) + ",1,2,3,4,\n" * 2,
        "one_blank": HEAD + body(3) + ",1,2,3,4,\n",
        "bad": HEAD + body(50) + "oops,1,2,3,4,\n",
        "short": ",1\n,a\n",
    }
    at = {folder.put(f"{name}.csv", text): name for name, text in texts.items()}
    lines = lines_of(spark, list(at), split=4000).persist()
    found = {at[r.path]: r for r in wide.profile_runs(lines).collect()}
    exact = {at[r.path]: r for r in wide.profile_lines(lines).collect()}
    again = {at[r.path] for r in wide.repeated_times(lines).collect()}
    assert again == {"repeats", "far", "blank"} == {n for n, r in exact.items() if r.repeats == wide.SAME_TIME}
    for name, r in exact.items():
        assert (found[name].error, found[name].sensors, found[name].last_chunk) == (r.error, r.sensors, r.last_chunk), name
        assert found[name].doubtful or r.repeats == wide.NOWHERE
    assert {n for n, r in found.items() if not r.doubtful} >= {"ordered", "one_blank", "bad", "short"}
    plan = wide.profile_runs(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInArrow") > plan.index("Window")  # what is shuffled comes after the runs are made


def test_profiles_hash_data_lines_and_gather_nothing(spark, folder):
    """Texts among the aggregates of data lines would have them all sorted, and gathered header rows would sort every file."""
    head = [(0, ", A, B, A"), (1, ", a, b, a"), (2, ", u,, u")]
    rows = [("f", "", 0, n, x) for n, x in head * 2] + [("f", "", c, None, f"2024/1/1 00:00:0{c % 2},1,2,3") for c in range(3)]
    rows += [("g", "", 0, n, x) for n, x in head[:2]] + [(None, "", 0, n, x) for n, x in head] + [(None, "", 4, None, "x,1")] + [("h", "", 1, None, "2024/1/1 00:00:00,1")]
    lines = spark.createDataFrame(rows, "path string, source_zip string, chunk bigint, header_no int, line string")
    profiles = wide.profile_lines(lines)
    got = {r.path: (r.error, r.repeats, r.last_chunk, [(s.sensor_id, s.twin_idx) for s in r.sensors or []]) for r in profiles.collect()}
    sensors = [(" A", None), (" B", None), (" A", 1)]
    assert got["f"] == (None, wide.SAME_TIME, 2, sensors) and got[None] == ("unparsable Time", wide.NOWHERE, 4, sensors)
    assert {got["g"][0], got["h"][0]} == {"fewer than 3 header rows"} and len(got) == 4
    assert "ObjectHashAggregate" not in profiles._jdf.queryExecution().sparkPlan().toString()


def test_names_are_scrubbed_once_per_file(spark, folder):
    """Lines take cleaned names from the join with their file's profile; no expression over a path runs for every line."""
    path = folder.put("a\x01b.csv", HEAD.replace("fan", "f\x02an") + body(300))
    lines = lines_of(spark, [path])
    profiles = wide.profile_lines(lines).persist()
    for broadcastable in (True, False):
        got = wide.readings_from_lines(lines, profiles, broadcastable, scrub=True)
        assert {r.path for r in got.select("path").collect()} == {path.replace("\x01", "")} and got.where("sensor_name = ' fan'").count() == 300
        above = got._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
        assert "regexp_replace(path" not in above and "regexp_replace(source_zip" not in above
