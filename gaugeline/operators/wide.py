"""Wide sensor files to long readings.

Two input shapes share one core:

* whole files ``(path, source_zip, content)``: everything about a file is worked out in its own row, so parsing,
  the sensor lookup, the placeholder filter and the per-file time check need no shuffle and no join;
* lines ``(path, source_zip, chunk, header_no, line)`` of files too large for one row: the header is gathered by a
  small aggregate and joined back to the lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gaugeline.functions.decode import decode_text
from gaugeline.functions.text import (
    CONTROL_CHARACTERS,
    chomp,
    field_value,
    first_field,
    has_open_quote,
    parse_time,
    placeholder,
    split_fields,
    split_lines,
)
from gaugeline.operators import order

FILE_KEYS = ["path", "source_zip"]
READING_KEYS = ["Time", "value", "sensor_id", "sensor_name", "unit"]

DROP_IF_BLANK = "drop_if_blank"
DROP_LAST = "drop_last"

#: A header lookup up to this many bytes may be broadcast; above it the salted join is used.
BROADCAST_BYTES = 64 << 20


# --- header (SQL fragments) -----------------------------------------------------------------------------------


def header_cells(line: str) -> str:
    """Texts of a header row's cells; without quotes in it only empty cells are looked for."""
    plain = f"transform(split({line}, ','), cell -> nullif(cell, ''))"
    return f"CASE WHEN contains({line}, '\"') THEN transform({split_fields(line)}, cell -> {field_value('cell')}) ELSE {plain} END"


def kept_sensors(ids: str, names: str, units: str, width: str | None = None) -> str:
    """Sensors of one file, placeholders left out, as ``array<struct>``.

    A column that has neither name nor unit makes the placeholder test null and is left out as well. That covers
    the blank trailing column, so the width of the file matters only when ``width`` is given: then the last column
    goes whatever it holds.
    """
    last = f"greatest(size({ids}), size({names}), size({units})) - 1"
    if width is not None:
        last = f"least({last}, {width} - 2)"
    sensor = (
        f"named_struct('col_idx', i, 'sensor_id', get({ids}, i), 'sensor_name', get({names}, i), 'unit', get({units}, i))"
    )
    return (
        f"filter(transform(sequence(1, greatest({last}, 1)), i -> {sensor}),"
        f" s -> s.col_idx <= {last} AND NOT {placeholder('s.sensor_name', 's.unit')})"
    )


def sensor_keys(sensors: str) -> str:
    """One text per sensor, equal where id, name and unit are (nulls equal)."""
    parts = ", ".join(f"coalesce(concat(length(s.{k}), ':', s.{k}), '-')" for k in ("sensor_id", "sensor_name", "unit"))
    return f"transform({sensors}, s -> concat_ws(' ', {parts}))"


def mark_twins(sensors: str, keys: str) -> str:
    """Add ``twin_idx`` (first earlier column of the same sensor) and ``copies`` (how many columns come earlier).

    ``keys`` is the column of ``sensor_keys``. Where two are equal, each sensor looks for its first equal; only those that have one
    count them.
    """
    texts = "'sensor_id', s.sensor_id, 'sensor_name', s.sensor_name, 'unit', s.unit"
    alone = f"transform({sensors}, s -> named_struct('col_idx', s.col_idx, 'twin_idx', CAST(NULL AS int), 'copies', 0, {texts}))"
    first = f"cast(array_position({keys}, get({keys}, i)) AS int)"
    return (
        f"CASE WHEN size(array_distinct({keys})) = size({keys}) THEN {alone} ELSE"
        f" transform({sensors}, (s, i) -> named_struct('col_idx', s.col_idx,"
        f" 'twin_idx', CASE WHEN {first} <= i THEN get({sensors}, {first} - 1).col_idx END,"
        f" 'copies', CASE WHEN {first} <= i THEN size(filter(slice({keys}, 1, i), k -> k = get({keys}, i))) ELSE 0 END,"
        f" {texts})) END"
    )


_MANY_COPIES = "coalesce(exists(sensors, s -> s.copies > 1), false)"

# Where equal rows can occur in a file: nowhere, among lines that share their time, or anywhere.
NOWHERE, SAME_TIME, ANYWHERE = "nowhere", "same time", "anywhere"

# The two shares of a file's lines that ``explode_lines`` can give.
CLEAR, DOUBTFUL = "clear", "doubtful"


def _repeats(same_time: str) -> str:
    return f"CASE WHEN {_MANY_COPIES} THEN '{ANYWHERE}' WHEN {same_time} THEN '{SAME_TIME}' ELSE '{NOWHERE}' END"


# --- whole files ----------------------------------------------------------------------------------------------


def parse_files(
    spark: SparkSession, files: DataFrame, encoding: str = "shift-jis", trailing: str = DROP_IF_BLANK
) -> DataFrame:
    """Per file: ``sensors``, ``data`` (lines), ``times`` (of the lines), ``error`` and ``repeats``.

    Each step is a projection of its own, so that no step's text appears twice in the next one.

    ``files`` has ``path, source_zip, content`` and may carry more columns, among them an ``error`` from reading.
    ``repeats`` tells where equal rows can occur: nowhere if times do not repeat and a sensor fills at most two
    columns, whose values are compared while the cells are made.
    """
    carried = [c for c in files.columns if c not in ("content", "error")]
    known_error = F.col("error") if "error" in files.columns else F.lit(None).cast("string")
    text = files.select(
        *carried,
        known_error.alias("read_error"),
        F.length("content").alias("n_bytes"),
        decode_text(spark, F.col("content"), encoding).alias("text"),
    )
    facts = [*carried, "read_error", "n_bytes"]
    lines = text.selectExpr(*facts, f"{has_open_quote('text')} AS open_quote", f"{split_lines('text')} AS lines")
    facts.append("open_quote")
    heads = lines.selectExpr(*facts, "lines", *[f"get(lines, {i}) AS h{i}" for i in range(3)])
    width = f"array_max(transform(lines, x -> size({split_fields('x')})))" if trailing == DROP_LAST else "0"
    cut = heads.selectExpr(
        *facts,
        "size(lines) AS n_lines",
        f"{width} AS width",
        *[f"{header_cells(f'h{i}')} AS h{i}" for i in range(3)],
        "CASE WHEN size(lines) > 3 THEN slice(lines, 4, size(lines) - 3) END AS data",
    )
    facts.append("n_lines")
    sensors = kept_sensors("h0", "h1", "h2", "width" if trailing == DROP_LAST else None)
    known = cut.selectExpr(
        *facts, f"{sensors} AS sensors", "data", f"transform(data, line -> {first_field('line')}) AS first"
    )
    keyed = known.selectExpr(*facts, "sensors", f"{sensor_keys('sensors')} AS keys", "data", "first")
    named = keyed.selectExpr(
        *facts,
        f"{mark_twins('sensors', 'keys')} AS sensors",
        "data",
        f"transform(first, cell -> {field_value('cell')}) AS raw_times",
    )
    timed = named.selectExpr(*facts, "sensors", "data", "raw_times", f"transform(raw_times, t -> {parse_time('t')}) AS times")
    error = """
        CASE WHEN read_error IS NOT NULL THEN read_error
             WHEN n_bytes IS NULL THEN 'no content'
             WHEN n_bytes = 0 THEN 'empty file'
             WHEN open_quote THEN 'unbalanced quotes'
             WHEN n_lines < 3 THEN 'fewer than 3 header rows'
             WHEN size(sensors) > 0 AND size(array_compact(raw_times)) > size(array_compact(times))
             THEN 'unparsable Time' END"""
    repeats = _repeats("size(array_distinct(times)) < size(times)")
    return timed.selectExpr(*carried, f"{error} AS error", f"{repeats} AS repeats", "sensors", "times", "data")


def explode_lines(parsed: DataFrame, share: str | None = None) -> DataFrame:
    """One row per data line of the files without an error.

    ``share`` picks the lines whose cells are sure to be unique (``clear``) or the others (``doubtful``); the two make
    up the whole. In a file where only times repeat, lines are sorted by time and compared with their neighbours.

    Files with an error explode nothing. A filter on ``error`` would be pushed below the parse and make it run twice,
    and so would the size test that the optimizer adds below a plain ``explode``; hence the outer form.

    The lambda inside the explode keeps it out of generated code on purpose: generated code would hold all readings of
    a file in memory before passing on the first one, while the iterator form streams line by line.
    """
    rows = "transform(data, (line, i) -> named_struct('Time', get(times, i), 'line', line))"
    if share is not None:
        parsed = parsed.withColumn(
            "by_time", F.expr(f"CASE WHEN error IS NULL AND repeats = '{SAME_TIME}' THEN sort_array({rows}) END")
        )
        again = (
            "(i > 0 AND get(by_time, i - 1).Time <=> r.Time)"
            " OR (i < size(by_time) - 1 AND get(by_time, i + 1).Time <=> r.Time)"
        )
        mine = f"filter(by_time, (r, i) -> {'NOT' if share == CLEAR else ''} ({again}))"
        whole = NOWHERE if share == CLEAR else ANYWHERE
        rows = f"CASE WHEN repeats = '{SAME_TIME}' THEN {mine} WHEN repeats = '{whole}' THEN {rows} END"
    return (
        parsed.select(*FILE_KEYS, "sensors", F.explode_outer(F.expr(f"CASE WHEN error IS NULL THEN {rows} END")).alias("row"))
        .where(F.col("row").isNotNull())
        .select(*FILE_KEYS, "sensors", "row.Time", "row.line")
    )


#: Cells of lines with one time that are compared within a row; lines of times with more of them meet in a shuffle.
CELLS_AT_ONCE = 100_000


def _spans(parsed: DataFrame, at_once: int) -> DataFrame:
    """Lines of the files without an error in the order of their times, and ``spans``: where each time begins, its number of lines, and
    whether these hold more than ``at_once`` cells."""
    rows = "transform(data, (line, i) -> named_struct('Time', get(times, i), 'line', line))"
    kept = [*FILE_KEYS, "sensors"]
    ordered = parsed.selectExpr(*kept, f"CASE WHEN error IS NULL THEN sort_array({rows}) END AS by_time")
    first = "filter(transform(by_time, (r, i) -> i), i -> i = 0 OR NOT (get(by_time, i - 1).Time <=> get(by_time, i).Time))"
    cut = ordered.selectExpr(*kept, "by_time", f"{first} AS first")
    counted = cut.selectExpr(*kept, "by_time", "transform(first, (i, j) -> named_struct('at', i, 'n', coalesce(get(first, j + 1), size(by_time)) - i)) AS spans")
    many = f"p.n > 1 AND CAST(p.n AS long) * size(sensors) > {at_once}"
    return counted.selectExpr(*kept, "by_time", f"transform(spans, p -> named_struct('at', p.at, 'n', p.n, 'many', {many})) AS spans")


def explode_times(parsed: DataFrame, at_once: int = CELLS_AT_ONCE) -> DataFrame:
    """One row per time of the files without an error: ``line`` where the time stands once, else ``same``, all its lines, or neither and
    ``many``, if they hold more than ``at_once`` cells. Out of generated code for the reason that ``explode_lines`` gives."""
    row = (
        "named_struct('Time', get(by_time, p.at).Time, 'line', CASE WHEN p.n = 1 THEN get(by_time, p.at).line END,"
        " 'same', CASE WHEN p.n > 1 AND NOT p.many THEN transform(slice(by_time, p.at + 1, p.n), r -> r.line) END, 'many', p.many)"
    )
    rows = _each(_spans(parsed, at_once), [*FILE_KEYS, "sensors"], f"transform(spans, p -> {row})", "row")
    return rows.select(*FILE_KEYS, "sensors", "row.*")


def explode_many(parsed: DataFrame, at_once: int = CELLS_AT_ONCE) -> DataFrame:
    """The lines that ``explode_times`` leaves out, one row each as in ``explode_lines``."""
    rows = "flatten(transform(filter(spans, p -> p.many), p -> slice(by_time, p.at + 1, p.n)))"
    return _each(_spans(parsed, at_once), [*FILE_KEYS, "sensors"], rows, "row").select(*FILE_KEYS, "sensors", "row.*")


def distinct_cells(times: DataFrame) -> DataFrame:
    """Distinct readings of ``explode_times`` (but those of ``many``) of files whose sensors fill at most two columns, without a shuffle.

    Lines that share their time are compared sensor by sensor within their row: a second column of a sensor adds the values that its
    first one lacks, nulls being equal. Any other line goes the way of ``cells``.
    """
    wide = times.where("NOT many").selectExpr(
        *FILE_KEYS,
        "Time",
        "sensors",
        f"CASE WHEN line IS NOT NULL THEN {split_fields('line')} END AS fields",
        f"CASE WHEN same IS NOT NULL THEN transform(same, line -> {split_fields('line')}) END AS rows",
    )

    def column(at: str) -> str:
        return f"transform(transform(rows, fields -> get(fields, {at})), raw -> {field_value('raw')})"

    values = f"CASE WHEN s.twin_idx IS NULL THEN array_distinct({column('s.col_idx')}) ELSE array_except({column('s.col_idx')}, {column('s.twin_idx')}) END"
    found = f"flatten(transform(sensors, (s, k) -> transform({values}, v -> named_struct('k', k, 'found', true, 'value', v))))"
    alone = "transform(sensors, (s, k) -> named_struct('k', k, 'found', false, 'value', CAST(NULL AS string)))"
    picked = wide.selectExpr(*FILE_KEYS, "Time", "sensors", "fields", f"CASE WHEN rows IS NULL THEN {alone} ELSE {found} END AS picks")
    each = picked.select(*FILE_KEYS, "Time", "sensors", "fields", F.explode_outer("picks").alias("pick")).where(F.col("pick").isNotNull())
    each = each.selectExpr(*FILE_KEYS, "Time", "get(sensors, pick.k) AS s", "fields", "pick")
    each = each.selectExpr(*FILE_KEYS, "Time", "s", "pick", "get(fields, s.col_idx) AS raw", "get(fields, s.twin_idx) AS raw_twin")
    repeated = f"NOT pick.found AND s.twin_idx IS NOT NULL AND ({field_value('raw')}) <=> ({field_value('raw_twin')})"
    value = f"CASE WHEN pick.found THEN pick.value ELSE {field_value('raw')} END AS value"
    return each.where(f"NOT ({repeated})").selectExpr(*FILE_KEYS, "Time", value, "s.sensor_id", "s.sensor_name", "s.unit")


def cells(lines: DataFrame) -> DataFrame:
    """Unpivot: one row per data line and kept sensor. Null readings stay.

    The fields of a line are cut once; every sensor then picks its own. A cell that repeats the value of the
    sensor's first column in the same line is the same reading and is left out here.
    """
    wide = lines.selectExpr(*FILE_KEYS, "Time", "sensors", f"{split_fields('line')} AS fields")
    picked = (
        wide.select(*FILE_KEYS, "Time", "fields", F.explode_outer("sensors").alias("s"))
        .where(F.col("s").isNotNull())
        .selectExpr(
            *FILE_KEYS, "Time", "s", "get(fields, s.col_idx) AS raw", "get(fields, s.twin_idx) AS raw_twin"
        )
    )
    repeated = f"s.twin_idx IS NOT NULL AND ({field_value('raw')}) <=> ({field_value('raw_twin')})"
    return picked.where(f"NOT ({repeated})").selectExpr(
        *FILE_KEYS, "Time", f"{field_value('raw')} AS value", "s.sensor_id", "s.sensor_name", "s.unit"
    )


def distinct_readings(readings: DataFrame) -> DataFrame:
    """Full-row distinct within a file, nulls equal. Duplicates collapse before the shuffle, whose key is the row."""
    return readings.dropDuplicates([*FILE_KEYS, *READING_KEYS])


_CLEAN = "regexp_replace({0}, r'" + CONTROL_CHARACTERS + "', '')"


def scrub_keys(files: DataFrame) -> DataFrame:
    return files.withColumns({k: F.expr(_CLEAN.format(k)) for k in FILE_KEYS})


def scrub_sensors(files: DataFrame) -> DataFrame:
    texts = ", ".join(f"'{k}', {_CLEAN.format('s.' + k)}" for k in ("sensor_id", "sensor_name", "unit"))
    clean = f"transform(sensors, s -> named_struct('col_idx', s.col_idx, 'twin_idx', s.twin_idx, {texts}))"
    return files.withColumn("sensors", F.expr(clean))


def scrub_names(files: DataFrame) -> DataFrame:
    """Remove control characters from file keys and sensor texts, per file instead of per reading.

    Only for cells that are not made distinct afterwards: names that differ in such characters alone would meet there.
    """
    return scrub_sensors(scrub_keys(files))


def readings_of(parsed: DataFrame) -> DataFrame:
    """Readings of parsed files. Only lines whose cells may repeat are shuffled; the price is a second parse."""
    doubtful = distinct_readings(cells(explode_lines(parsed, DOUBTFUL)))
    return cells(explode_lines(parsed, CLEAR)).unionByName(doubtful)


def wide_to_long(
    spark: SparkSession, files: DataFrame, encoding: str = "shift-jis", trailing: str = DROP_IF_BLANK
) -> DataFrame:
    """All readings of the files that parse; see ``file_errors`` for the others."""
    return readings_of(parse_files(spark, files, encoding, trailing))


def _each(rows: DataFrame, keys: list[str], items: str, name: str) -> DataFrame:
    """One row per element of the array ``items`` (an expression), none for null or no elements.

    The only way to explode what a parse gave. A plain ``explode`` after the parse, or a filter on one of its columns, makes
    the optimizer copy the text of all its steps into a filter at the scan, where it is interpreted for every row.
    """
    return rows.select(*keys, F.explode_outer(F.expr(items)).alias(name)).where(F.col(name).isNotNull())


def sensors_of(parsed: DataFrame, *keys: str) -> DataFrame:
    """One row per kept sensor of every parsed or profiled file: ``keys``, then the struct ``s``."""
    return _each(parsed, list(keys) or FILE_KEYS, "sensors", "s")


def file_errors(parsed: DataFrame) -> DataFrame:
    return _each(parsed, FILE_KEYS, "CASE WHEN error IS NOT NULL THEN array(error) END", "error")


# --- lines of large files -------------------------------------------------------------------------------------


def decode_lines(spark: SparkSession, raw_lines: DataFrame, encoding: str) -> DataFrame:
    decoded = raw_lines.withColumn("line", decode_text(spark, F.col("raw"), encoding))
    return decoded.withColumn("line", F.expr(chomp("line")))


def _timed(lines: DataFrame, trailing: str) -> DataFrame:
    """What a profile needs of every line."""
    kept = [*FILE_KEYS, "chunk", "header_no", "error AS read_error" if "error" in lines.columns else "CAST(NULL AS string) AS read_error"]
    raw = lines.selectExpr(
        *kept,
        f"{has_open_quote('line')} AS open_quote",
        "CASE WHEN header_no IS NOT NULL THEN line END AS header",
        f"{f'size({split_fields('line')})' if trailing == DROP_LAST else '0'} AS width",
        f"CASE WHEN header_no IS NULL THEN {first_field('line')} END AS first",
    )
    valued = raw.withColumn("first", F.expr(field_value("first")))
    return valued.withColumns({"Time": F.expr(parse_time("first")), "has_time": F.col("first").isNotNull()}).drop("first")


def _with_sensors(per_file: DataFrame, trailing: str, *carried: str) -> DataFrame:
    """Profiles from per-file facts, among them the header rows ``h0, h1, h2``."""
    facts = [*FILE_KEYS, *carried, "read_error", "open_quote", "width", "bad_time", "repeats", "last_chunk"]
    missing = "h0 IS NULL OR h1 IS NULL OR h2 IS NULL AS missing"
    heads = per_file.selectExpr(*facts, missing, *[f"{header_cells(f'h{i}')} AS h{i}" for i in range(3)])
    facts.append("missing")
    sensors = heads.selectExpr(
        *facts, f"{kept_sensors('h0', 'h1', 'h2', 'width' if trailing == DROP_LAST else None)} AS sensors"
    )
    sensors = sensors.selectExpr("*", f"{sensor_keys('sensors')} AS keys").withColumn("sensors", F.expr(mark_twins("sensors", "keys")))
    return sensors.selectExpr(
        *FILE_KEYS,
        *carried,
        """CASE WHEN read_error IS NOT NULL THEN read_error
                WHEN open_quote THEN 'unbalanced quotes'
                WHEN missing THEN 'fewer than 3 header rows'
                WHEN size(sensors) > 0 AND bad_time THEN 'unparsable Time' END AS error""",
        f"{_repeats('repeats')} AS repeats",
        "last_chunk",
        "sensors",
    )


def _by_time(data: DataFrame) -> DataFrame:
    """Data lines (of ``_timed``) by file and time. All aggregates are of fixed width, so that rows are hashed and not sorted."""
    return data.groupBy(*FILE_KEYS, "Time", "has_time").agg(
        F.expr("count(1) AS n"),
        F.expr("max(open_quote) AS open_quote"),
        F.expr("max(width) AS width"),
        F.expr("max(chunk) AS chunk"),
    )


_IS_DATA = "header_no IS NULL AND read_error IS NULL"


def profile_lines(lines: DataFrame, trailing: str = DROP_IF_BLANK) -> DataFrame:
    """One row per file: sensors, error, repeats.

    Lines in any order: data lines are first grouped by file and time (partial sums on the map side), which tells whether times
    repeat; the second grouping is by file. No group is gathered: only maxima, and the header rows. Lines may carry an
    ``error`` from reading, which becomes the file's. Header rows and errors take a way of their own, because texts as aggregates
    would have all data lines sorted; the price is that ``lines`` are read twice.
    """
    timed = _timed(lines, trailing)
    per_file = _by_time(timed.where(_IS_DATA)).groupBy(*FILE_KEYS).agg(
        F.expr("max(open_quote) AS open_quote"),
        F.expr("max(width) AS width"),
        F.expr("max(has_time AND Time IS NULL) AS bad_time"),
        F.expr("max(n > 1) AS repeats"),
        F.expr("max(chunk) AS last_chunk"),
    )
    heads = [f"h{i}" for i in range(3)]
    texts = timed.where(f"NOT ({_IS_DATA})").selectExpr(
        *FILE_KEYS, "open_quote", "width", "header_no IS NULL AND has_time AND Time IS NULL AS bad_time", "false AS repeats", "chunk AS last_chunk",
        "read_error", *[f"CASE WHEN header_no = {i} THEN header END AS {h}" for i, h in enumerate(heads)],
    )
    both = per_file.selectExpr("*", *[f"CAST(NULL AS string) AS {c}" for c in ("read_error", *heads)]).unionByName(texts)
    facts = ("read_error", "open_quote", "width", "bad_time", "repeats", "last_chunk", *heads)
    return _with_sensors(both.groupBy(*FILE_KEYS).agg(*[F.max(c).alias(c) for c in facts]), trailing)


def profile_runs(lines: DataFrame, trailing: str = DROP_IF_BLANK) -> DataFrame:
    """``profile_lines`` of lines that mostly come in the order of their files, without shuffling lines, and ``doubtful``.

    Tasks sum up runs of lines (see ``order``), and only these, one row for thousands of lines, are compared. Times of a file that is
    ``doubtful`` may repeat, which ``profile_lines`` can tell; all others don't.
    """
    timed = _timed(lines, trailing).withColumn("micros", F.unix_micros(F.col("Time").cast("timestamp"))).drop("Time")
    found = timed.select(*FILE_KEYS, "chunk", "header_no", "header", "read_error", "open_quote", "width", "micros", "has_time").mapInArrow(order.runs, order.RUNS)
    before = F.lag("last_time").over(Window.partitionBy(*FILE_KEYS, F.col("first_time").isNull()).orderBy("first_time", "last_time"))
    found = found.withColumn("meets", F.coalesce(F.col("first_time") <= before, F.lit(False)))
    per_file = found.groupBy(*FILE_KEYS).agg(
        F.expr("max(read_error) AS read_error"),
        F.expr("max(open_quote) AS open_quote"),
        F.expr("max(width) AS width"),
        F.expr("max(bad_time) AS bad_time"),
        F.expr("max(meets) OR NOT min(rises) OR sum(without_time) > 1 AS doubtful"),
        F.expr("max(chunk) AS last_chunk"),
        F.expr("sort_array(flatten(collect_list(head))) AS head"),
    )
    texts = per_file.selectExpr("*", "false AS repeats", *[f"get(head, {i}).line AS h{i}" for i in range(3)])
    return _with_sensors(texts, trailing, "doubtful")


def repeated_times(lines: DataFrame) -> DataFrame:
    """``path, source_zip, Time`` of all times (null ones too) that several data lines of a file have."""
    return _by_time(_timed(lines, DROP_IF_BLANK).where(_IS_DATA)).groupBy(*FILE_KEYS, "Time").agg(F.sum("n").alias("n")).where("n > 1").drop("n")


def attach_sensors(lines: DataFrame, profiles: DataFrame, broadcastable: bool, *carried: str) -> DataFrame:
    """Join data lines to the sensors of their file (and ``carried`` columns of its profile).

    ``broadcastable`` is the answer of a size check on ``profiles`` (see ``lookup_fits``). Otherwise both sides are
    keyed by file and chunk, the profile repeated once per chunk of the file, so that even a file holding a third of
    all lines is spread over as many groups as it has chunks.
    """
    data = lines.where(F.col("header_no").isNull())
    if "error" in lines.columns:
        data = data.where(F.col("error").isNull()).drop("error")
    if broadcastable:
        good = _each(profiles, [*FILE_KEYS, *carried], "CASE WHEN error IS NULL THEN array(sensors) END", "sensors")
        return data.join(F.broadcast(good), FILE_KEYS)
    chunks = "CASE WHEN error IS NULL THEN sequence(0L, last_chunk) END"
    return data.join(_each(profiles, [*FILE_KEYS, *carried, "sensors"], chunks, "chunk"), [*FILE_KEYS, "chunk"])


def lookup_fits(profiles: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the sensor lookup is small enough to broadcast: counts its cells and text, one row back."""
    size = F.expr(
        "aggregate(sensors, 0L, (n, s) -> n + 64 + coalesce(length(s.sensor_id), 0) + coalesce(length(s.sensor_name), 0)"
        " + coalesce(length(s.unit), 0))"
    )
    total = profiles.agg(F.sum(size + F.length("path") + F.length("source_zip") + 64)).first()[0]
    return (total or 0) * 3 <= limit


def timed_lines(
    lines: DataFrame, profiles: DataFrame, broadcastable: bool, scrub: bool = False
) -> DataFrame:
    """Data lines of large files with their time and the sensors of their file."""
    if scrub:  # once per file: lines take the cleaned names from the join
        clean = {f"clean_{k}": F.expr(_CLEAN.format(k)) for k in FILE_KEYS}
        joined = attach_sensors(lines, scrub_sensors(profiles).withColumns(clean), broadcastable, *clean)
        joined = joined.withColumns({k: F.col(f"clean_{k}") for k in FILE_KEYS})
    else:
        joined = attach_sensors(lines, profiles, broadcastable)
    first = joined.selectExpr(*FILE_KEYS, "sensors", "line", f"{first_field('line')} AS first")
    valued = first.selectExpr(*FILE_KEYS, "sensors", "line", f"{field_value('first')} AS first")
    return valued.selectExpr(*FILE_KEYS, "sensors", f"{parse_time('first')} AS Time", "line")


def readings_from_lines(
    lines: DataFrame, profiles: DataFrame, broadcastable: bool, scrub: bool = False
) -> DataFrame:
    """Readings of large files, before the distinct. ``scrub`` cleans names as ``scrub_names`` does."""
    return cells(timed_lines(lines, profiles, broadcastable, scrub))
