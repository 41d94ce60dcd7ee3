import datetime as dt

import pytest
from conftest import HEAD, ROWS, contents, readings
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from gaugeline.operators import wide


def long(spark, body, encoding="utf-8", **kw):
    return readings(wide.wide_to_long(spark, contents(spark, ("/x/test.csv", body)), encoding, **kw))


def errors(spark, *files, encoding="utf-8"):
    parsed = wide.parse_files(spark, contents(spark, *files), encoding)
    return {r.path: r.error for r in parsed.select("path", "error").collect()}


def test_basic_file(spark):
    got = long(spark, HEAD + ROWS)
    assert len(got) == 8
    assert ("2024-03-05 07:30:00", "1", " T10", " boiler", " degC") in got
    assert ("2024-03-05 07:30:01", "a", " T10", " boiler", " degC") in got
    assert ("2024-03-05 07:30:00", "4", " F30", " fan", " rpm") in got


def test_schema(spark):
    df = wide.wide_to_long(spark, contents(spark, ("/x/test.csv", HEAD + ROWS)), "utf-8")
    assert dict(df.dtypes) == {
        "path": "string",
        "source_zip": "string",
        "Time": "timestamp_ntz",
        "value": "string",
        "sensor_id": "string",
        "sensor_name": "string",
        "unit": "string",
    }


def test_trailing_column_rules(spark):
    with_comma = ",A,B\n,a,b\n,x,y\n2024/3/5 7:30:0,1,2,\n"
    without = ",A,B\n,a,b\n,x,y\n2024/3/5 7:30:0,1,2\n"
    assert [r[1] for r in long(spark, with_comma)] == ["1", "2"]
    assert [r[1] for r in long(spark, without)] == ["1", "2"]
    assert [r[1] for r in long(spark, with_comma, trailing="drop_last")] == ["1", "2"]
    assert [r[1] for r in long(spark, without, trailing="drop_last")] == ["1"]


def test_short_rows_give_null_readings(spark):
    got = long(spark, ",A,B\n,a,b\n,x,y\n2024/3/5 7:30:0,1\n2024/3/5 7:30:1,,2\n")
    assert [r[:3] for r in got] == [
        ("2024-03-05 07:30:00", None, "B"),
        ("2024-03-05 07:30:00", "1", "A"),
        ("2024-03-05 07:30:01", None, "A"),
        ("2024-03-05 07:30:01", "2", "B"),
    ]


def test_placeholders(spark):
    head = ",1,2,3,4,5,6,7\n,-, -　,-,,,,pH\n,-,-,,-,,kg,\n"
    got = long(spark, head + "2024/3/5 7:30:0,a,b,c,d,e,f,g,\n")
    assert [(r[1], r[3], r[4]) for r in got] == [("f", None, "kg"), ("g", "pH", None)]


def test_duplicates_collapse_within_a_file_only(spark):
    body = ",A,A,A\n,a,a,a\n,x,x,x\n2024/3/5 7:30:0,1,1,1,\n2024/3/5 7:30:0,1,2,1,\n"
    df = wide.wide_to_long(spark, contents(spark, ("/1.csv", body), ("/2.csv", body)), "utf-8")
    assert sorted((r.path, r.value) for r in df.collect()) == [("/1.csv", "1"), ("/1.csv", "2"), ("/2.csv", "1"), ("/2.csv", "2")]


def test_where_rows_can_repeat(spark):
    twins = ",A,A\n,a,a\n,x,x\n"
    triples = ",A,A,A\n,a,a,a\n,x,x,x\n"
    row, later = "2024/3/5 7:30:0,1,1,1\n", "2024/03/05 07:30:00,1,1,1\n"
    df = contents(
        spark, ("once", twins + row), ("again", twins + row + later), ("triple", triples + row), ("none", twins)
    )
    got = {r.path: r.repeats for r in wide.parse_files(spark, df, "utf-8").select("path", "repeats").collect()}
    assert got == {"once": wide.NOWHERE, "again": wide.SAME_TIME, "triple": wide.ANYWHERE, "none": wide.NOWHERE}


def test_no_distinct_where_nothing_repeats(spark):
    body = ",A,B,A\n,a,b,a\n,x,y,x\n2024/3/5 7:30:0,1,2,1,\n2024/3/5 7:30:1,,2,,\n2024/3/5 7:30:2,1,2,\"1\",\n2024/3/5 7:30:3,1,2,3,\n"
    parsed = wide.parse_files(spark, contents(spark, ("/f", body)), "utf-8")
    assert parsed.first().repeats == wide.NOWHERE
    cells = wide.cells(wide.explode_lines(parsed))
    assert readings(cells) == readings(wide.distinct_readings(cells))
    assert cells.count() == 9


def test_shares_make_up_the_whole(spark):
    """Repeated times in any order, null times and three columns of one sensor."""
    head = ",A,B,A\n,a,b,a\n,x,y,x\n"
    mixed = "".join(f"2024/1/1 0:{i % 40 if i % 3 else 50}:0,{i % 4},{i % 2},{i % 4}\n" for i in range(90)) + ",1,2,1\n,1,2,1\n,1,3,1\n"
    df = contents(spark, ("/mixed", head + mixed), ("/triple", head.replace("B", "A").replace("b", "a").replace("y", "x") + mixed), ("/once", HEAD + ROWS))
    parsed = wide.parse_files(spark, df, "utf-8").persist()
    every = wide.explode_lines(parsed)
    clear, doubtful = wide.explode_lines(parsed, wide.CLEAR), wide.explode_lines(parsed, wide.DOUBTFUL)
    count = lambda d: {r.path: r["count"] for r in d.groupBy("path").count().collect()}
    assert count(every) == {"/mixed": 93, "/triple": 93, "/once": 2}
    assert count(clear.unionByName(doubtful)) == count(every)
    assert 0 < count(clear)["/mixed"] < 93 and "/triple" not in count(clear) and "/once" not in count(doubtful)
    want = wide.distinct_readings(wide.cells(every))
    got = wide.readings_of(parsed)
    assert readings(got) == readings(want) and got.exceptAll(want).isEmpty() and got.count() == want.count()


@pytest.mark.parametrize("at_once", [0, 12, 100_000])
def test_repeated_times_are_compared_within_a_row(spark, at_once):
    """Null times and values, twin columns, quotes and short lines; only times of more cells than allowed are left to the distinct."""
    head = ",A,B,A\n,a,b,a\n,x,y,x\n"
    cells = ["1", "2", "", '"1"', '"a,""\nb"']
    mixed = "".join(f"{f'2024/1/1 0:{i % 9}:0' if i % 5 else ''},{cells[i % 5]},{cells[i % 2]},{cells[(i + i // 7) % 5]}\n" for i in range(200))
    df = contents(spark, ("/mixed", head + mixed + "2024/1/1 0:0:0\n" * 2 + "2024/1/2 0:0:0,1,1,1\n"), ("/again", head + "2024/1/1 0:0:0,3,,3\n" * 3), ("/bad", head + "x,1,1,1\n" * 2))
    parsed = wide.parse_files(spark, df, "utf-8")
    assert {r.repeats for r in parsed.select("repeats").collect()} == {wide.SAME_TIME}
    want = wide.distinct_readings(wide.cells(wide.explode_lines(parsed)))
    times = wide.explode_times(parsed, at_once)
    few, many = wide.distinct_cells(times), wide.distinct_readings(wide.cells(wide.explode_many(parsed, at_once)))
    got = few.unionByName(many)
    assert readings(got) == readings(want) and got.exceptAll(want).isEmpty() and got.count() == want.count()
    assert many.isEmpty() == (times.where("many").isEmpty()) == (at_once == 100_000)
    executed = few._jdf.queryExecution().executedPlan().toString()
    assert sum("StringDecode" in line for line in executed.split("\n")) == 1 and "Exchange" not in executed and "Join" not in executed


def test_quoted_newline_and_crlf(spark):
    body = ',A,B\r\n,"na,me",b\r\n,x,y\r\n2024/3/5 7:30:0,"1,\n""2""",e,\r\n\r\n\n2024/3/5 7:30:1,"",z,\r\n'
    assert long(spark, body) == [
        ("2024-03-05 07:30:00", '1,\n"2"', "A", "na,me", "x"),
        ("2024-03-05 07:30:00", "e", "B", "b", "y"),
        ("2024-03-05 07:30:01", None, "A", "na,me", "x"),
        ("2024-03-05 07:30:01", "z", "B", "b", "y"),
    ]


@pytest.mark.parametrize(
    "text, parsed",
    [
        ("2024/3/5 7:30:0", dt.datetime(2024, 3, 5, 7, 30)),
        ("2024/01/01 00:00:00", dt.datetime(2024, 1, 1)),
        (" 　2024/12/31 23:59:59\t", dt.datetime(2024, 12, 31, 23, 59, 59)),
        ("2024/2/30 00:00:00", None),
        ("2024-03-05 07:30:00", None),
        ("2024/1/1", None),
        ("2024/3/5 7:30:0.5", None),
        ("2024/1/1 24:00:00", None),
        ("24/1/1 0:0:0", None),
        ("", None),
    ],
)
def test_parse_time(spark, text, parsed):
    from gaugeline.functions.text import parse_time

    assert spark.createDataFrame([(text,)], "t string").select(F.expr(parse_time("t"))).first()[0] == parsed


def test_time_is_zone_free(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:  # 02:30 does not exist there on that day
        assert long(spark, ",A\n,a\n,x\n2024/3/10 2:30:00,1,\n")[0][0] == "2024-03-10 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_file_errors(spark):
    got = errors(
        spark,
        ("ok", HEAD + ROWS),
        ("time", HEAD + ROWS + "xx,1,2,3,4,\n"),
        ("null time", HEAD + ",1,2,3,4,\n"),
        ("empty", ""),
        ("head", HEAD),
        ("short", ",1\n,a\n"),
        ("quote", HEAD + '2024/3/5 7:30:0,"1,2\n'),
        ("all placeholders", ",1\n,-\n,-\nxx,1,\n"),
    )
    assert got == {
        "ok": None,
        "time": "unparsable Time",
        "null time": None,
        "empty": "empty file",
        "head": None,
        "short": "fewer than 3 header rows",
        "quote": "unbalanced quotes",
        "all placeholders": None,
    }


def test_bad_file_does_not_touch_others(spark):
    df = contents(spark, ("/ok", HEAD + ROWS), ("/bad", HEAD + ROWS + "xx,1,2,3,4,\n"))
    got = wide.wide_to_long(spark, df, "utf-8").groupBy("path").count().collect()
    assert [(r.path, r["count"]) for r in got] == [("/ok", 8)]


def test_plan_of_the_parse_is_not_repeated(spark):
    """One decode and no shuffle for the clear lines; the doubtful ones add a second parse and one shuffle, no join."""
    files = contents(spark, ("/f", HEAD + ROWS))
    parsed = wide.parse_files(spark, files, "shift-jis")
    clear = wide.cells(wide.explode_lines(parsed))._jdf.queryExecution().executedPlan().toString()
    assert clear.count("StringDecode") == 1 and "Exchange" not in clear and "Join" not in clear
    both = wide.wide_to_long(spark, files, "shift-jis")._jdf.queryExecution().executedPlan().toString()
    assert both.count("StringDecode") == 2 and both.count("Exchange hashpartitioning") == 1 and "Join" not in both


CELL = st.one_of(st.none(), st.text(st.characters(codec="utf-8", exclude_categories=["Cc", "Cs", "Cn"]), min_size=1, max_size=6), st.sampled_from(['a,b', 'q"q', "l\nm", '"', "表"]))


def csv_field(value):
    if value is None:
        return ""
    return '"' + value.replace('"', '""') + '"' if any(c in value for c in ',"\n') else value


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(table=st.integers(1, 4).flatmap(lambda n: st.lists(st.lists(CELL, min_size=n, max_size=n), min_size=1, max_size=5)))
def test_pivot_of_the_result_restores_the_input(spark, table):
    n = len(table[0])
    head = "," + ",".join(f"S{i}" for i in range(n)) + "\n" + "," + ",".join(f"n{i}" for i in range(n)) + "\n" + ",u" * n + "\n"
    lines = [f"2024/3/5 7:30:{i}," + ",".join(csv_field(c) for c in row) + ",\n" for i, row in enumerate(table)]
    got = {(r[0][-2:], r[2]): r[1] for r in long(spark, head + "".join(lines))}
    assert got == {(f"{i:02d}", f"S{j}"): c for i, row in enumerate(table) for j, c in enumerate(row)}
