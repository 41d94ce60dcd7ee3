"""Every operator as a query over the given tables, with the SQL that must give the same rows.

The tables hold no sensor files, so each query derives its input from whole tables: file names and contents from
``documents`` and ``pages``, readings and ledger events from ``events``, wide rows from ``lineitem``.
"""

from __future__ import annotations

import io
import itertools
import sys
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeline.functions.decode import decode_text
from gaugeline.functions.text import (
    basename,
    content_hash,
    field_value,
    parse_time,
    scrub_control_chars,
    split_fields,
    split_lines,
)
from gaugeline.operators import ledger as led, skip, wide
from gaugeline.operators.enrich import add_meta
from gaugeline.operators.sinks import rows_per_file
from gaugeline.plans.ingest import Options, ingest_folder
from gaugeline.plans.lake import Lake
from gaugeline.schemas import COMPLETED, FAILED, LEDGER_EVENT, PENDING, STATUSES
from gaugeline.session import configure, shared_dir
from gaugeline.sources import archives, files, opened
from gaugeline.streaming.incremental import stream_ingest

cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

META = {"factory": "F1", "machine_id": "M7", "data_label": "２０２４年点検"}
ROWS_PER_FILE = 5000


def query(name: str, oracle: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Input for files that a query makes: a table that lies in fewer Parquet files than there are cores is dealt out first,
    because one row group is one task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores, key)


# --- readings derived from events -----------------------------------------------------------------------------

TIME_FORMAT = "yyyy/MM/dd HH:mm:ss"


def decimal_text(column: str) -> Column:
    return F.col(column).cast("decimal(18,4)").cast("string")


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long readings with text times; one event type has a dash as its name, two have a dash as their unit."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.format_string("/plant/test_%d.csv", F.col("user_id")).alias("path"),
        F.lit("").alias("source_zip"),
        F.date_format("ts", TIME_FORMAT).alias("Time"),
        decimal_text("value").alias("value"),
        F.concat(F.lit(" "), F.col("user_id") % 10).alias("sensor_id"),
        F.when(kind == "error", " -　").otherwise(kind).alias("sensor_name"),
        F.when(kind == "view", "count").when(kind == "purchase", "yen").when(kind == "click", "-")
        .when(kind == "error", "　-").alias("unit"),
    )


_EVENT_READINGS = """
    SELECT event_id, '/plant/test_' || user_id || '.csv' AS path, '' AS source_zip,
           strftime(ts, '%Y/%m/%d %H:%M:%S') AS time_text, date_trunc('second', ts) AS "Time",
           CAST(CAST(value AS DECIMAL(18,4)) AS VARCHAR) AS value, ' ' || (user_id % 10) AS sensor_id,
           CASE WHEN event_type = 'error' THEN ' -' || chr(12288) ELSE event_type END AS sensor_name,
           CASE event_type WHEN 'view' THEN 'count' WHEN 'purchase' THEN 'yen' WHEN 'click' THEN '-'
                           WHEN 'error' THEN chr(12288) || '-' END AS unit
    FROM events"""

_STRIP = "regexp_replace({0}, '^[\\s' || chr(12288) || ']+|[\\s' || chr(12288) || ']+$', '', 'g')"
_KEPT = f"NOT ({_STRIP.format('sensor_name')} = '-' AND {_STRIP.format('unit')} = '-')"


@query(
    "placeholder_filter",
    f"SELECT event_id, sensor_id, sensor_name, unit FROM ({_EVENT_READINGS}) WHERE {_KEPT}",
)
def placeholder_filter(spark, sf_dir):
    """Every reading as a file of its own, so that each name and unit stands in a header."""
    cells = [F.coalesce(F.col(c), F.lit("")) for c in ("sensor_id", "sensor_name", "unit")]
    text = F.concat(*[part for cell in cells for part in (F.lit(","), cell, F.lit("\n"))], F.col("Time"), F.lit(","), F.col("value"))
    files_ = event_readings(spark, sf_dir).select("event_id", "path", "source_zip", F.encode(text, "UTF-8").alias("content"))
    kept = wide.sensors_of(wide.parse_files(spark, files_, "utf-8"), "event_id")
    return kept.select("event_id", "s.sensor_id", "s.sensor_name", "s.unit")


@query(
    "time_parse",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS "Time" FROM events""",
)
def time_parse(spark, sf_dir):
    """Padded, unpadded and space-wrapped times; those of one event type do not parse."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.date_format("ts", TIME_FORMAT))
        .when(kind == "click", F.concat(F.lit(" 　"), F.date_format("ts", TIME_FORMAT), F.lit("　\t")))
        .when(kind == "error", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy/M/d H:m:s"))
    )
    texts = table(spark, sf_dir, "events").select("event_id", text.alias("t"))
    return texts.select("event_id", F.expr(parse_time("t")).alias("Time"))


@query(
    "distinct_readings",
    f"""SELECT DISTINCT path, source_zip, date_trunc('day', "Time") AS "Time",
               CAST(length(value) AS VARCHAR) AS value, sensor_id, sensor_name, unit FROM ({_EVENT_READINGS})""",
)
def distinct_readings(spark, sf_dir):
    """Times cut to the day and values to their length, so that many rows repeat."""
    coarse = event_readings(spark, sf_dir).withColumns(
        {"Time": F.date_trunc("day", F.expr(parse_time("Time"))).cast("timestamp_ntz"), "value": F.length("value").cast("string")}
    )
    return wide.distinct_readings(coarse.drop("event_id"))


@query(
    "add_meta",
    f"""SELECT "Time", value, sensor_id, sensor_name, unit, path AS source_file, source_zip, 'F1' AS factory,
               'M7' AS machine_id, '２０２４年点検' AS data_label FROM ({_EVENT_READINGS})""",
)
def meta(spark, sf_dir):
    readings = event_readings(spark, sf_dir).withColumn("Time", F.expr(parse_time("Time")))
    return add_meta(readings, META)


# --- wide files derived from lineitem -------------------------------------------------------------------------

_ORDER_HEAD = [", L1, L2, L3, L4, L5", ", quantity, price, discount, -, spare", ", pcs, yen,, -, x"]
_ORDER_CELLS = """
    SELECT '/plant/order_' || l_orderkey || '.csv' AS path, l_shipdate + to_seconds(l_linenumber) AS "Time", v.*
    FROM lineitem, LATERAL (VALUES (CAST(CAST(l_quantity AS DECIMAL(18,4)) AS VARCHAR), ' L1', ' quantity', ' pcs'),
        (CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS VARCHAR), ' L2', ' price', ' yen'),
        (CAST(CAST(l_discount AS DECIMAL(18,4)) AS VARCHAR), ' L3', ' discount', NULL),
        (NULL, ' L5', ' spare', ' x')) AS v(value, sensor_id, sensor_name, unit)"""


def numbered(stem: str, number: str) -> Column:
    """File names, as ``format_string`` makes them."""
    return F.concat(F.lit(stem), F.coalesce(F.col(number).cast("string"), F.lit("null")), F.lit(".csv"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one wide file per order: three header rows, then a row per item; the fourth sensor is a dash.

    Orders without items are files with a header only.
    """
    items = table(spark, sf_dir, "lineitem")
    path = numbered("/plant/order_", "l_orderkey").alias("path")
    time = F.date_format(F.expr("timestampadd(SECOND, l_linenumber, l_shipdate)"), "yyyy/M/d H:mm:ss")
    cells = [decimal_text(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    data = items.select(path, F.lit(1).cast("long").alias("chunk"), F.lit(None).cast("int").alias("header_no"), F.concat_ws(",", time, *cells, F.lit("")).alias("line"))
    heads = F.posexplode(F.array(*[F.lit(h) for h in _ORDER_HEAD])).alias("header_no", "line")
    named = table(spark, sf_dir, "orders").select(numbered("/plant/order_", "o_orderkey").alias("path"))
    head = named.select("path", F.lit(0).cast("long").alias("chunk"), heads)
    return data.unionByName(head).withColumn("source_zip", F.lit(""))


def order_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = order_lines(spark, sf_dir)
    return wide.readings_from_lines(lines, wide.profile_lines(lines), broadcastable=False)


@query("wide_to_long", f'SELECT path, "Time", value, sensor_id FROM ({_ORDER_CELLS})')
def wide_to_long(spark, sf_dir):
    return order_readings(spark, sf_dir).select("path", "Time", "value", "sensor_id")


@query("sensor_join", f'SELECT path, "Time", sensor_id, sensor_name, unit FROM ({_ORDER_CELLS})')
def sensor_join(spark, sf_dir):
    """Lines joined with the sensors of their file, by file and chunk."""
    return order_readings(spark, sf_dir).select("path", "Time", "sensor_id", "sensor_name", "unit")


@query(
    "drop_trailing_col",
    """WITH f AS (SELECT l_orderkey, greatest(4, max(3 + CAST(l_linestatus = 'F' AS INT) + CAST(l_discount > 0.09 AS INT))) AS width
                  FROM lineitem GROUP BY l_orderkey)
       SELECT '/plant/order_' || l_orderkey || '.csv' AS path, v.col_idx, v.sensor_id
       FROM f, (VALUES (1, ' A'), (2, ' B'), (3, ' C')) AS v(col_idx, sensor_id) WHERE v.col_idx <= width - 2""",
)
def drop_trailing_col(spark, sf_dir):
    """Ragged files, one per order, whose last column goes whatever it holds: the longest line tells which it is."""
    tail = F.concat(F.when(F.col("l_linestatus") == "F", ",").otherwise(""), F.when(F.col("l_discount") > 0.09, ",x").otherwise(""))
    line = F.concat(F.date_format("l_shipdate", "yyyy/M/d H:mm:ss"), F.lit(",1,2"), tail)
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))
    text = F.concat(F.lit(", A, B, C\n, a, b, c\n, u, v, w\n"), F.array_join("lines", "\n"))
    files_ = orders.select(
        F.format_string("/plant/order_%d.csv", F.col("l_orderkey")).alias("path"), F.lit("").alias("source_zip"), F.encode(text, "UTF-8").alias("content")
    )
    sensors = wide.sensors_of(wide.parse_files(spark, files_, "utf-8", wide.DROP_LAST), "path")
    return sensors.select("path", "s.col_idx", "s.sensor_id")


# --- files derived from documents and pages -------------------------------------------------------------------


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per document: folder from its source, archive from its language, content from its text."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/"), "source", F.lit("/test_"), F.col("n_chars"), F.lit(".csv")).alias("path"),
        F.when(F.col("lang") == "en", "").otherwise(F.concat(F.lit("/zip/"), "lang", F.lit(".zip"))).alias("source_zip"),
        "doc_id",
        F.length("text").cast("long").alias("length"),
        content_hash(F.col("text").cast("binary")).alias("file_hash"),
    )


_FILES = """
    SELECT '/' || source || '/test_' || n_chars || '.csv' AS path, 'test_' || n_chars || '.csv' AS file_path,
           CASE WHEN lang = 'en' THEN '' ELSE '/zip/' || lang || '.zip' END AS source_zip, doc_id,
           sha256(text) AS file_hash FROM documents"""


def label_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger events of the labelled documents: good ones completed, toxic ones failed, the rest pending."""
    labels = table(spark, sf_dir, "labels")
    status = F.when(F.col("toxic") == 1, FAILED).when(F.col("quality") == 1, COMPLETED).otherwise(PENDING)
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id"))
    labelled = document_files(spark, sf_dir).join(labels, "doc_id")
    return labelled.select(
        basename(F.col("path")).alias("file_path"),
        "source_zip",
        "file_hash",
        status.alias("status"),
        F.lit(None).cast("string").alias("reason"),
        F.lit(None).cast("string").alias("ingest_id"),
        F.col("path").alias("full_path"),
        at.alias("event_ts"),
        F.col("doc_id").alias("seq"),
        F.lit(False).alias("is_tombstone"),
    ).select(*LEDGER_EVENT.fieldNames())


_PROCESSED = f"""
    SELECT file_path, source_zip, arg_max(file_hash, doc_id) AS file_hash, arg_max(status, doc_id) AS status,
           max(doc_id) AS doc_id
    FROM (SELECT f.*, CASE WHEN toxic = 1 THEN 'FAILED' WHEN quality = 1 THEN 'COMPLETED' ELSE 'PENDING' END AS status
          FROM ({_FILES}) f JOIN labels USING (doc_id))
    GROUP BY file_path, source_zip"""
_DONE = f"WITH f AS ({_FILES}), p AS ({_PROCESSED}), d AS (SELECT * FROM p WHERE status = 'COMPLETED')"
_KNOWN_NAME = "EXISTS (SELECT 1 FROM d WHERE d.file_path = f.file_path AND d.source_zip = f.source_zip)"
_KNOWN_HASH = "f.file_hash IN (SELECT file_hash FROM d)"


def label_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return led.processed_files(label_events(spark, sf_dir))


@query("skip_by_name", f"{_DONE} SELECT doc_id, path, source_zip FROM f WHERE NOT {_KNOWN_NAME}")
def skip_by_name(spark, sf_dir):
    new = skip.skip_by_name(document_files(spark, sf_dir), label_ledger(spark, sf_dir))
    return new.select("doc_id", "path", "source_zip")


@query("skip_by_hash", f"{_DONE} SELECT doc_id, path, file_hash FROM f WHERE NOT {_KNOWN_HASH}")
def skip_by_hash(spark, sf_dir):
    new = skip.skip_by_hash(document_files(spark, sf_dir), label_ledger(spark, sf_dir))
    return new.select("doc_id", "path", "file_hash")


_OUTCOMES = f"""{_DONE} SELECT doc_id, path, source_zip, CASE WHEN {_KNOWN_NAME} THEN 'already_processed_by_path'
    WHEN {_KNOWN_HASH} THEN 'already_processed_by_hash' ELSE 'newly_processed' END AS outcome FROM f"""


@query("classify_files", _OUTCOMES)
def classify_files(spark, sf_dir):
    seen = skip.classify_files(document_files(spark, sf_dir), label_ledger(spark, sf_dir))
    return seen.select("doc_id", "path", "source_zip", "outcome")


@query(
    "run_stats",
    f"""SELECT count(*) AS total_found,
               count(*) FILTER (outcome = 'already_processed_by_path') AS already_processed_by_path,
               count(*) FILTER (outcome = 'already_processed_by_hash') AS already_processed_by_hash,
               count(*) FILTER (outcome = 'newly_processed') AS newly_processed,
               CAST(0 AS BIGINT) AS failed, CAST(0 AS BIGINT) AS timeout FROM ({_OUTCOMES})""",
)
def run_stats(spark, sf_dir):
    return skip.run_stats(classify_files(spark, sf_dir))


@query(
    "batch_dedup",
    f"""SELECT file_hash, min_path AS path, min_zip AS source_zip FROM (
            SELECT file_hash, path AS min_path, source_zip AS min_zip,
                   row_number() OVER (PARTITION BY file_hash ORDER BY path, source_zip) AS n FROM ({_FILES}))
        WHERE n = 1""",
)
def batch_dedup(spark, sf_dir):
    return skip.batch_winners(document_files(spark, sf_dir)).select("file_hash", "path", "source_zip")


@query("content_hash", "SELECT doc_id, sha256(text) AS file_hash FROM documents")
def hashes(spark, sf_dir):
    return document_files(spark, sf_dir).select("doc_id", "file_hash")


@query(
    "source_name_filter",
    """SELECT page_id, regexp_extract(url, '[^/\\\\]+$') AS name FROM pages
       WHERE regexp_matches(regexp_extract(url, '[^/\\\\]+$'), '(page|top|1)')""",
)
def source_name_filter(spark, sf_dir):
    pages = files.match_names(table(spark, sf_dir, "pages"), "(page|top|1)", "url")
    return pages.select("page_id", basename(F.col("url")).alias("name"))


@query(
    "source_union",
    f"""SELECT path, source_zip, length FROM (SELECT f.path, f.source_zip, length(d.text) AS length
            FROM ({_FILES}) f JOIN documents d USING (doc_id))
        UNION ALL SELECT url, '/zip/pages.zip', length(html) FROM pages""",
)
def source_union(spark, sf_dir):
    none = F.lit(None).cast("string").alias("error")
    loose = document_files(spark, sf_dir).select("path", "source_zip", "length", none)
    archived = table(spark, sf_dir, "pages").select(
        F.col("url").alias("path"), F.lit("/zip/pages.zip").alias("source_zip"), F.length("html").cast("long").alias("length"), none
    )
    return files.union_listings(loose, archived).select("path", "source_zip", "length")


@query(
    "control_scrub",
    """SELECT doc_id, lang, chr(9) || regexp_replace(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g') || 'end' AS text
       FROM documents""",
)
def control_scrub(spark, sf_dir):
    dirty = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("\x01"), "lang", F.lit("\x7f")).alias("lang"),
        F.concat(F.lit("\t\x00\x1f"), "text", F.lit("\x0bend\x08")).alias("text"),
    )
    return scrub_control_chars(dirty)


@query("rows_per_file", f"SELECT path AS source_file, source_zip, count(*) AS n_rows FROM ({_EVENT_READINGS}) GROUP BY 1, 2")
def file_rows(spark, sf_dir):
    return rows_per_file(add_meta(event_readings(spark, sf_dir), META))


@query(
    "decode_roundtrip",
    """SELECT doc_id, text, translate(sha256(text), '0123456789abcdef', 'アイウエオ表ソ能キクケコサシスセ') AS label
       FROM documents""",
)
def decode_roundtrip(spark, sf_dir):
    """Texts in UTF-8 with and without BOM and in UTF-16, and Japanese labels in Shift-JIS, all by detection."""
    configure(spark)
    plain = F.encode("text", "UTF-8")
    label = F.translate(F.sha2(F.col("text").cast("binary"), 256), "0123456789abcdef", "アイウエオ表ソ能キクケコサシスセ")
    coded = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "de", F.concat(F.unhex(F.lit("EFBBBF")), plain))
        .when(F.col("lang") == "fr", F.concat(F.unhex(F.lit("FFFE")), F.encode("text", "UTF-16LE")))
        .when(F.col("lang") == "es", F.concat(F.unhex(F.lit("FEFF")), F.encode("text", "UTF-16BE")))
        .otherwise(plain)
        .alias("content"),
        F.encode(label, "Shift_JIS").alias("label"),
    )
    return coded.select(
        "doc_id",
        decode_text(spark, F.col("content"), "auto").alias("text"),
        decode_text(spark, F.col("label"), "auto").alias("label"),
    )


@query(
    "csv_fields",
    """SELECT doc_id, nullif(text, '') AS text, lang, CAST(n_chars AS VARCHAR) AS n_chars, n_chars || '" pipe' AS inch,
              ' "' || lang || '"' AS late FROM documents""",
)
def csv_fields(spark, sf_dir):
    """Whole texts as one quoted CSV field each: quotes, commas and newlines must come back.

    Two more fields hold quotes that open nothing, because they don't stand at the start.
    """
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat_ws(",", "lang", quoted, F.col("n_chars").cast("string"), F.concat("n_chars", F.lit('" pipe')), F.concat(F.lit(' "'), "lang", F.lit('"')), F.lit("")).alias("line")
    )
    fields = lines.selectExpr("doc_id", f"{split_fields('line')} AS fields")
    cells = fields.selectExpr("doc_id", *[f"fields[{i}] AS {name}" for i, name in enumerate("abcde")])
    return cells.selectExpr(
        "doc_id", f"{field_value('b')} AS text", f"{field_value('a')} AS lang", f"{field_value('c')} AS n_chars",
        f"{field_value('d')} AS inch", f"{field_value('e')} AS late",
    )


_HEAD = ", T1, N1, T1, X\n, text, size, text, -\n, line, chars, line, -\n"


@query(
    "whole_file_readings",
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
            r AS (SELECT '/doc_' || doc_id || '.csv' AS path, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(i) AS "Time",
                         nullif(line, '') AS line, CAST(length(line) AS VARCHAR) AS size,
                         CASE WHEN i % 2 = 0 THEN nullif(line, '') ELSE 'odd' END AS twin FROM l)
       SELECT path, "Time", line AS value, ' T1' AS sensor_id, ' text' AS sensor_name, ' line' AS unit FROM r
       UNION ALL SELECT path, "Time", size, ' N1', ' size', ' chars' FROM r
       UNION ALL SELECT path, "Time", twin, ' T1', ' text', ' line' FROM r WHERE twin IS DISTINCT FROM line""",
)
def whole_file_readings(spark, sf_dir):
    """Every document as a wide file with one data row per line of its text; one sensor fills two columns."""
    row = """concat_ws(',', date_format(timestampadd(SECOND, i, TIMESTAMP_NTZ'2024-01-01 00:00:00'), 'yyyy/M/d H:m:s'),
                concat('"', replace(line, '"', '""'), '"'), length(line),
                CASE WHEN i % 2 = 0 THEN concat('"', replace(line, '"', '""'), '"') ELSE 'odd' END, '0', '')"""
    body = f"array_join(transform(split(text, '\\n'), (line, i) -> {row}), '\\n')"
    docs = dealt(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").select(
        F.format_string("/doc_%d.csv", F.col("doc_id")).alias("path"),
        F.lit("").alias("source_zip"),
        F.encode(F.concat(F.lit(_HEAD), F.expr(body)), "UTF-8").alias("content"),
    )
    return wide.wide_to_long(spark, docs, "utf-8").drop("source_zip")


# --- ledger ---------------------------------------------------------------------------------------------------


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status changes of one file per user and event type; signups of a high value remove the file."""
    names = F.array(*[F.lit(s) for s in STATUSES])
    return table(spark, sf_dir, "events").select(
        F.format_string("user_%d.csv", F.col("user_id")).alias("file_path"),
        F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")).alias("source_zip"),
        F.sha2(F.col("props").cast("binary"), 256).alias("file_hash"),
        F.get(names, (F.floor("value") % 5).cast("int")).alias("status"),
        F.lit(None).cast("string").alias("reason"),
        F.lit(None).cast("string").alias("ingest_id"),
        F.col("event_type").alias("full_path"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.col("event_id").alias("seq"),
        ((F.col("event_type") == "signup") & (F.col("value") > 60)).alias("is_tombstone"),
    )


_USER_LEDGER = """
    SELECT 'user_' || user_id || '.csv' AS file_path, CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS source_zip,
           sha256(arg_max(props, event_id)) AS file_hash,
           arg_max(['PENDING', 'IN_PROGRESS', 'COMPLETED', 'FAILED', 'TIMEOUT'][CAST(floor(value) AS BIGINT) % 5 + 1], event_id)
               AS status,
           max(ts) AS processed_date, max(ts) AS status_updated_at,
           arg_max(event_type = 'signup' AND value > 60, event_id) AS removed
    FROM events GROUP BY user_id, event_type"""
_LEDGER_COLUMNS = "file_path, file_hash, source_zip, processed_date, status, status_updated_at"


def _naive(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("processed_date", "status_updated_at")})


@query("ledger_upsert", f"SELECT {_LEDGER_COLUMNS} FROM ({_USER_LEDGER})")
def ledger_upsert(spark, sf_dir):
    kept = user_events(spark, sf_dir).withColumn("is_tombstone", F.lit(False))
    return _naive(led.processed_files(kept))


@query("ledger_delete", f"SELECT {_LEDGER_COLUMNS} FROM ({_USER_LEDGER}) WHERE NOT removed")
def ledger_delete(spark, sf_dir):
    return _naive(led.processed_files(user_events(spark, sf_dir)))


@query("ledger_counts", f"SELECT status, count(*) AS n_files FROM ({_USER_LEDGER}) WHERE NOT removed GROUP BY status")
def ledger_counts(spark, sf_dir):
    return led.ledger_counts(led.processed_files(user_events(spark, sf_dir)))


@query(
    "ledger_status",
    f"""SELECT c.c_custkey, l.status FROM customer c
        LEFT JOIN (SELECT * FROM ({_USER_LEDGER}) WHERE NOT removed) l
        ON l.file_path = 'user_' || c.c_custkey || '.csv' AND l.source_zip = 'signup'""",
)
def ledger_status(spark, sf_dir):
    asked = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.format_string("/in/user_%d.csv", F.col("c_custkey")).alias("path"),
        F.lit("signup").alias("source_zip"),
    )
    return led.file_status(asked, led.processed_files(user_events(spark, sf_dir))).select("c_custkey", "status")


_MERGE_SIDES = """
    a AS (SELECT 'user_' || user_id || '.csv' AS file_path, '' AS source_zip, arg_max(sha256(props), event_id) AS file_hash,
                 max(ts) AS changed, 'COMPLETED' AS status FROM events WHERE event_type NOT IN ('purchase', 'error') GROUP BY user_id),
    b AS (SELECT 'user_' || user_id || '.csv' AS file_path, '' AS source_zip, arg_max(sha256(props), event_id) AS file_hash,
                 max(ts) AS changed, 'FAILED' AS status FROM events WHERE event_type IN ('purchase', 'error') GROUP BY user_id)"""


@query(
    "ledger_merge",
    f"""WITH {_MERGE_SIDES}
        SELECT file_path, file_hash, source_zip, changed AS processed_date, status, changed AS status_updated_at FROM b
        UNION ALL SELECT file_path, file_hash, source_zip, changed, status, changed FROM a
        WHERE file_path NOT IN (SELECT file_path FROM b)""",
)
def ledger_merge(spark, sf_dir):
    changes = user_events(spark, sf_dir).withColumns({"source_zip": F.lit(""), "is_tombstone": F.lit(False)})
    other = F.col("full_path").isin("purchase", "error")
    main = changes.where(~other).withColumn("status", F.lit(COMPLETED))
    more = changes.where(other).withColumn("status", F.lit(FAILED))
    return _naive(led.merge_ledgers(led.processed_files(main), led.processed_files(more)))


@query(
    "sql_params",
    """SELECT o_orderstatus, count(*) AS n, max(o_orderdate) AS last_date FROM orders
       WHERE o_totalprice > 1000.0 AND o_orderstatus <> 'P' GROUP BY o_orderstatus""",
)
def sql_params(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("gaugeline_orders")
    return Lake(spark, shared_dir(spark, "lake")).execute(
        "SELECT o_orderstatus, count(*) AS n, max(o_orderdate) AS last_date FROM gaugeline_orders"
        " WHERE o_totalprice > ? AND o_orderstatus <> ? GROUP BY o_orderstatus",
        [1000.0, "P"],
    )


@query(
    "sql_sensor_data",
    f"""SELECT sensor_name, unit, count(*) AS n, min("Time") AS first_time, max("Time") AS last_time
        FROM ({_EVENT_READINGS}) WHERE path <> '/plant/test_7.csv' AND length(value) > 5 GROUP BY sensor_name, unit""",
)
def sql_sensor_data(spark, sf_dir):
    """A lake that doesn't exist yet: its tables are empty, then readings are inserted, then asked for with parameters."""
    lake = Lake(spark, shared_dir(spark, "lake"))
    assert lake.readings().isEmpty() and lake.processed_files().isEmpty()
    readings = event_readings(spark, sf_dir).withColumn("Time", F.expr(parse_time("Time")))
    inserted = lake.insert_sensor_data(add_meta(readings, META))
    assert inserted == readings.count()
    return lake.execute(
        "SELECT sensor_name, unit, count(*) AS n, min(Time) AS first_time, max(Time) AS last_time FROM sensor_data"
        " WHERE source_file <> :file AND length(value) > :size GROUP BY sensor_name, unit",
        {"file": "/plant/test_7.csv", "size": 5},
    )


# --- archives derived from documents --------------------------------------------------------------------------


#: Bytes of archives that a task holds before it passes them on, and texts that it holds as Python objects.
_ZIP_BYTES, _ZIP_TEXTS = 4 << 20, 64


def _zip_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(paths), pa.array(packed, pa.binary())], names=["path", "content"])

    paths, packed, held = [], [], 0
    for batch in (whole.slice(at, _ZIP_TEXTS) for whole in batches for at in range(0, whole.num_rows, _ZIP_TEXTS)):
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("notes.txt", "no table")
                z.writestr(f"day/User_{doc_id}.csv", text)
                z.writestr("day/User.CSV", text)
                z.writestr("Cond_0.csv", text[::-1])
            paths.append(f"/zip/{doc_id}.zip")
            packed.append(buffer.getvalue())
            held += len(packed[-1])
            if held >= _ZIP_BYTES:
                yield made()
                paths, packed, held = [], [], 0
    if packed:
        yield made()


def document_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dealt(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return docs.mapInArrow(_zip_up, "path string, content binary")


@query(
    "archive_entries",
    """SELECT '/zip/' || doc_id || '.zip' AS source_zip, 'day/User_' || doc_id || '.csv' AS path, sha256(text) AS file_hash
       FROM documents
       UNION ALL SELECT '/zip/' || doc_id || '.zip', 'Cond_0.csv', sha256(reverse(text)) FROM documents""",
)
def archive_entries(spark, sf_dir):
    entries = archives.explode_archives(document_archives(spark, sf_dir), "(Cond|User|test)")
    return entries.select("source_zip", "path", content_hash(F.col("content")).alias("file_hash"))


@query(
    "archive_lookup",
    """SELECT '/zip/' || doc_id || '.zip' AS source_zip, requested, entry_path, error FROM documents,
       LATERAL (VALUES ('day' || chr(92) || 'User_' || doc_id || '.csv', 'day/User_' || doc_id || '.csv', NULL),
                       ('User.CSV', 'day/User.CSV', NULL),
                       ('gone.csv', NULL, 'not found in archive: gone.csv')) AS v(requested, entry_path, error)""",
)
def archive_lookup(spark, sf_dir):
    """Exact paths (with a backslash), names in another folder, and entries that are not there."""
    packed = document_archives(spark, sf_dir)
    wanted = table(spark, sf_dir, "documents").select(
        F.format_string("/zip/%d.zip", F.col("doc_id")).alias("source_zip"),
        F.explode(
            F.array(F.format_string("day\\User_%d.csv", F.col("doc_id")), F.lit("User.CSV"), F.lit("gone.csv"))
        ).alias("path"),
    )
    listed = archives.explode_archives(packed, suffix="", with_content=False)
    return archives.resolve_entries(wanted, listed).select("source_zip", "requested", "entry_path", "error")


# --- whole jobs -----------------------------------------------------------------------------------------------

_EVENT_HEAD = [", E1, E2, E1, E9", ", value, level, value, -", ", V, m, V,　-"]


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one wide file per user: three header rows and a data row per event; the fourth sensor is a dash.

    Users with an event above 400 have one broken time.
    """
    events = table(spark, sf_dir, "events")
    path = F.format_string("/plant/test_%d.csv", F.col("user_id")).alias("path")
    time = F.when(F.col("value") > 400, "broken").otherwise(F.date_format("ts", "yyyy/M/d HH:mm:ss"))
    value = decimal_text("value")
    line = F.concat_ws(
        ",", time, value, F.col("event_type"), F.when(F.col("event_type") == "view", value).otherwise(F.col("props")), F.lit("7"), F.lit("")
    )
    chunk = F.floor(F.col("event_id") / 100_000).cast("long").alias("chunk")
    data = events.select(path, chunk, F.lit(None).cast("int").alias("header_no"), line.alias("line"))
    heads = F.posexplode(F.array(*[F.lit(h) for h in _EVENT_HEAD])).alias("header_no", "line")
    head = events.select(path).distinct().select("path", F.lit(0).cast("long").alias("chunk"), heads)
    return data.unionByName(head).withColumn("source_zip", F.lit(""))


@query(
    "header_dim",
    """SELECT DISTINCT '/plant/test_' || user_id || '.csv' AS path, v.* FROM events,
       (VALUES (1, ' E1', ' value', ' V'), (2, ' E2', ' level', ' m'), (3, ' E1', ' value', ' V'))
           AS v(col_idx, sensor_id, sensor_name, unit)""",
)
def header_dim(spark, sf_dir):
    """Sensor dimension of every file, gathered from its three header rows among all lines."""
    sensors = wide.sensors_of(wide.profile_lines(event_lines(spark, sf_dir)), "path")
    return sensors.select("path", "s.col_idx", "s.sensor_id", "s.sensor_name", "s.unit")


@query(
    "file_errors",
    """SELECT '/plant/test_' || user_id || '.csv' AS path,
              CASE WHEN max(value) > 400 THEN 'unparsable Time' END AS error FROM events GROUP BY user_id""",
)
def file_errors(spark, sf_dir):
    return wide.profile_lines(event_lines(spark, sf_dir)).select("path", "error")


@query(
    "quarantine",
    """SELECT '/plant/test_' || user_id || '.csv' AS path, date_trunc('second', ts) AS "Time", v.* FROM events e,
        LATERAL (VALUES (CAST(CAST(e.value AS DECIMAL(18,4)) AS VARCHAR), ' E1'), (e.event_type, ' E2'),
                        (CASE WHEN e.event_type <> 'view' THEN e.props END, ' E1')) AS v(value, sensor_id)
        WHERE user_id NOT IN (SELECT user_id FROM events WHERE value > 400) AND v.value IS NOT NULL""",
)
def quarantine(spark, sf_dir):
    """A file with one unparsable time drops out whole, the others stay whole."""
    lines = event_lines(spark, sf_dir)
    readings = wide.readings_from_lines(lines, wide.profile_lines(lines), broadcastable=False)
    return readings.select("path", "Time", "value", "sensor_id")


def write_wide_files(
    spark: SparkSession, sf_dir: str, folder: str, rows_per_file: int = ROWS_PER_FILE, which: Column | None = None, broken: Column | None = None
) -> None:
    """Events as Shift-JIS files of at most ``rows_per_file`` data rows, header rows first, with a trailing comma.

    ``which`` chooses files by ``file_no``; the time of events that are ``broken`` doesn't parse.
    """
    configure(spark)
    head = [", S001, S002, S001, S004", ", 温度, 状態, 温度, -", ", ℃,, ℃,-"]
    file_no = F.floor(F.col("event_id") / rows_per_file).alias("file_no")
    events = table(spark, sf_dir, "events")
    events = events if which is None else events.select("*", file_no).where(which).drop("file_no")
    time = F.date_format("ts", "yyyy/M/d H:mm:ss")
    line = F.concat_ws(
        ",", time if broken is None else F.when(broken, "broken").otherwise(time), decimal_text("value"), "event_type", decimal_text("value"), F.lit("0"), F.lit("")
    )
    data = events.select(file_no, F.lit(3).alias("no"), line.alias("line"))
    heads = F.posexplode(F.array(*[F.lit(h) for h in head])).alias("no", "line")
    rows = data.unionByName(events.select(file_no).distinct().select("file_no", heads))
    (
        rows.repartition("file_no")
        .sortWithinPartitions("file_no", "no")
        .select("file_no", "line")
        .write.partitionBy("file_no")
        .options(encoding="Shift_JIS", sep="\x01", quote="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(folder)
    )


_FILE_CELLS = f"""
    SELECT DISTINCT CAST(event_id // {ROWS_PER_FILE} AS BIGINT) AS file_no, date_trunc('second', ts) AS "Time", v.*
    FROM events e, LATERAL (VALUES (CAST(CAST(e.value AS DECIMAL(18,4)) AS VARCHAR), ' S001', ' 温度', ' ℃'),
                                   (e.event_type, ' S002', ' 状態', NULL)) AS v(value, sensor_id, sensor_name, unit)"""


def _numbered(readings: DataFrame) -> DataFrame:
    """Generated part names differ from run to run; the folder number stands for the file."""
    number = F.regexp_extract("source_file", r"file_no=(\d+)", 1).cast("bigint")
    return readings.select(number.alias("file_no"), "Time", "value", "sensor_id", "sensor_name", "unit")


_SMALL_FILES = 500


@query(
    "flagship_ingest",
    f"""SELECT DISTINCT CAST(event_id // {_SMALL_FILES} AS BIGINT) AS file_no, date_trunc('second', ts) AS "Time", v.*, '' AS source_zip,
               'F1' AS factory, 'M7' AS machine_id, '２０２４年点検' AS data_label
        FROM events e, LATERAL (VALUES (CAST(CAST(e.value AS DECIMAL(18,4)) AS VARCHAR), ' S001', ' 温度', ' ℃'),
                                       (e.event_type, ' S002', ' 状態', NULL)) AS v(value, sensor_id, sensor_name, unit)
        WHERE event_id // {_SMALL_FILES} NOT IN (SELECT event_id // {_SMALL_FILES} FROM events WHERE event_id % 2003 = 7)""",
)
def flagship_ingest(spark, sf_dir):
    """Shift-JIS files, some with a broken time, through the whole job; the readings of the good ones."""
    folder, root = shared_dir(spark, "files"), shared_dir(spark, "lake")
    write_wide_files(spark, sf_dir, folder, _SMALL_FILES, broken=F.col("event_id") % 2003 == 7)
    lake = Lake(spark, root)
    ingest_folder(lake, folder, "part", options=Options(encoding="shift-jis", meta=META))
    readings = lake.readings()
    number = F.regexp_extract("source_file", r"file_no=(\d+)", 1).cast("bigint")
    return readings.select(number.alias("file_no"), *[c for c in readings.columns if c != "source_file"])


class _Dying(Lake):
    """A lake whose batches die before their commit."""

    def commit(self, *args, **kwargs) -> None:
        raise InterruptedError("before the commit")


@query("ingest_retry", _FILE_CELLS)
def ingest_retry(spark, sf_dir):
    """A batch dies before its commit, another takes up its files, then the first is retried: nothing twice."""
    folder, root = shared_dir(spark, "files"), shared_dir(spark, "lake")
    write_wide_files(spark, sf_dir, folder)
    lake, options = Lake(spark, root), Options(encoding="shift-jis", meta=META)
    try:
        ingest_folder(_Dying(spark, root), folder, "part", "one", options)
    except InterruptedError:
        ingest_folder(lake, folder, "part", "two", options)
    ingest_folder(lake, folder, "part", "one", options)
    return _numbered(lake.readings())


@query("stream_two_folders", _FILE_CELLS)
def stream_two_folders(spark, sf_dir):
    """Two streams of the default name, each with its own checkpoint, into one lake."""
    folder, root = shared_dir(spark, "files"), shared_dir(spark, "lake")
    lake = Lake(spark, root)
    for part in (0, 1):
        write_wide_files(spark, sf_dir, f"{folder}/{part}", which=F.col("file_no") % 2 == part)
        options = Options(encoding="shift-jis", meta=META)
        stream_ingest(lake, f"{folder}/{part}", f"{root}-checkpoint-{part}", "part", options=options).awaitTermination()
    return _numbered(lake.readings())


@query("rolled_back", f"SELECT 0 AS n_readings, count(DISTINCT event_id // {ROWS_PER_FILE}) AS n_files FROM events")
def rolled_back(spark, sf_dir):
    """A batch that dies and is rolled back leaves no readings; the files are found by their extension."""
    folder, root = shared_dir(spark, "files"), shared_dir(spark, "lake")
    write_wide_files(spark, sf_dir, folder)
    lake = Lake(spark, root)
    try:
        ingest_folder(_Dying(spark, root), folder, "part", "one", Options(encoding="shift-jis", meta=META))
    except InterruptedError:
        lake.rollback("one")
    found = files.find_files_with_extension(spark, folder, "csv").where(F.col("length") > 0)
    return found.agg(F.lit(lake.readings().count()).cast("int").alias("n_readings"), F.count("*").alias("n_files"))


@query("folder_ingest", _FILE_CELLS)
def folder_ingest(spark, sf_dir):
    """Real Shift-JIS files in folders, discovered, hashed, parsed, written and committed."""
    folder, root = shared_dir(spark, "files"), shared_dir(spark, "lake")
    write_wide_files(spark, sf_dir, folder)
    lake = Lake(spark, root)
    ingest_folder(lake, folder, "part", options=Options(encoding="shift-jis", meta=META))
    return _numbered(lake.readings())


@query("stream_ingest", _FILE_CELLS)
def streamed(spark, sf_dir):
    """The same files through the incremental file stream."""
    folder, root = shared_dir(spark, "files"), shared_dir(spark, "lake")
    write_wide_files(spark, sf_dir, folder)
    lake = Lake(spark, root)
    run = stream_ingest(lake, folder, f"{root}-checkpoint", "part", options=Options(encoding="shift-jis", meta=META))
    run.awaitTermination()
    return _numbered(lake.readings())


@query(
    "folder_ledger",
    f"""SELECT 'COMPLETED' AS status, count(DISTINCT event_id // {ROWS_PER_FILE}) AS n_files FROM events""",
)
def folder_ledger(spark, sf_dir):
    """The same files ingested twice: the second run finds them all in the ledger and changes nothing."""
    folder, root = shared_dir(spark, "files"), shared_dir(spark, "lake")
    write_wide_files(spark, sf_dir, folder)
    lake = Lake(spark, root, ledger_key="path")
    options = Options(encoding="shift-jis", meta=META)
    ingest_folder(lake, folder, "part", options=options)
    ingest_folder(lake, folder, "part", options=options)
    return led.ledger_counts(lake.processed_files())


# --- real files and archives derived from documents -----------------------------------------------------------


def put_files(files_: DataFrame) -> None:
    """Write ``(path, content)`` rows as files, each complete under its name at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                system, at = opened.locate(path)
                system.create_dir(at.rsplit("/", 1)[0])
                with system.open_output_stream(f"{at}.new") as out:
                    out.write(content.as_buffer())
                system.move(f"{at}.new", at)
            yield batch.select(["path"])

    files_.select("path", "content").mapInArrow(run, "path string").write.format("noop").mode("overwrite").save()


def write_archive(uri: str, entries: Iterator[tuple[str, bytes]]) -> pa.Table:
    """Write names and contents as a ZIP file, complete under its name at once."""
    system, at = opened.locate(uri)
    system.create_dir(at.rsplit("/", 1)[0])
    with system.open_output_stream(f"{at}.new") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in entries:
            z.writestr(name, content)
    system.move(f"{at}.new", at)
    return pa.table({"archive": [uri]})


def put_archives(entries: DataFrame) -> None:
    """Write ``(archive, name, content)`` rows as ZIP files of all their entries."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.sort_by("name")
        return write_archive(group["archive"][0].as_py(), zip(rows["name"].to_pylist(), rows["content"].to_pylist(), strict=True))

    entries.select("archive", "name", "content").groupBy("archive").applyInArrow(run, "archive string").write.format("noop").mode("overwrite").save()


def put_piece_archives(docs: DataFrame) -> None:
    """Write ``(archive, name, doc_id, text)`` rows as ZIP files; an entry holds the table of its documents in the order of their ids.

    Texts are shuffled once, by archive; the tables, which are longer, are made behind the shuffle.
    """

    def run(group: pa.Table) -> pa.Table:
        names = group["name"].to_pylist()
        rows = zip(names, group["body"].cast(pa.binary()).to_pylist(), strict=True)
        parts = ((name, _PIECE_HEAD.encode() + b"\n".join(body for _, body in same)) for name, same in itertools.groupby(rows, lambda r: r[0]))
        return write_archive(group["archive"][0].as_py(), parts)

    spark = docs.sparkSession
    # a number of its own: by their bytes too few tasks would be made for the work of packing them
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bodies = docs.select("archive", "name", "doc_id", "text").repartition(tasks, "archive").select("archive", "name", "doc_id", piece_body().alias("body"))
    ordered = bodies.sortWithinPartitions("archive", "name", "doc_id", "body").select("archive", "name", "body")
    ordered.groupBy("archive").applyInArrow(run, "archive string").write.format("noop").mode("overwrite").save()


#: Files of more bytes are read as lines, in splits of so many bytes: low, so that the tables' texts go both ways.
_BOTH_WAYS = {"whole_file_bytes": 60_000, "split_bytes": 16_384}
#: Documents of a file, and files of an archive.
_FILE_DOCS, _ZIP_FILES = 32, 8
_PIECE_HEAD = ", P1, P2, P3\n, piece, size, document\n, text, chars, id\n"
_SCRUB = "regexp_replace({0}, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g')"


def piece_body() -> Column:
    """The lines of a document (``doc_id, text``): a data row per sentence, quoted, line ends and all."""
    row = f"""concat_ws(',', date_format(timestampadd(SECOND, i + 100000 * (doc_id % {_FILE_DOCS}), TIMESTAMP_NTZ'2024-01-01 00:00:00'), 'yyyy/M/d H:mm:ss'),
                concat('"', replace(piece, '"', '""'), '"'), length(piece), doc_id, '')"""
    return F.expr(f"array_join(transform(split(text, '[.] '), (piece, i) -> {row}), '\n')")


def piece_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n, content``: texts as wide files of ``_FILE_DOCS`` documents each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    made = docs.select("doc_id", piece_body().alias("body")).groupBy(F.floor(F.col("doc_id") / _FILE_DOCS).alias("n")).agg(F.sort_array(F.collect_list(F.struct("doc_id", "body"))).alias("parts"))
    return made.select("n", F.encode(F.concat(F.lit(_PIECE_HEAD), F.array_join("parts.body", "\n")), "UTF-8").alias("content"))


_PIECES = f"""
    SELECT doc_id // {_FILE_DOCS} AS n, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(i + 100000 * (doc_id % {_FILE_DOCS})) AS "Time", v.*
    FROM (SELECT doc_id, unnest(string_split(t, '. ')) AS piece, generate_subscripts(string_split(t, '. '), 1) - 1 AS i
          FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
    LATERAL (VALUES (nullif({_SCRUB.format("piece")}, ''), ' P1'), (CAST(length(piece) AS VARCHAR), ' P2'), (CAST(doc_id AS VARCHAR), ' P3')) AS v(value, sensor_id)"""


@query("mode_equality", f'SELECT n AS file_no, "Time", value, sensor_id FROM ({_PIECES})')
def mode_equality(spark, sf_dir):
    """Every content as a loose file and in an archive, some read whole, some in splits that cut quoted line ends, then all once
    more on the other way: each is ingested once."""
    folder, lake = shared_dir(spark, "files"), Lake(spark, shared_dir(spark, "lake"), ledger_key="path")
    made = piece_files(spark, sf_dir)
    named = F.concat(F.lit("test_"), "n", F.lit(".csv"))
    put_files(made.select(F.concat(F.lit(f"{folder}/loose/"), named).alias("path"), "content"))
    archive = F.concat(F.lit(f"{folder}/zip/"), F.floor(F.col("n") / _ZIP_FILES), F.lit(".zip"))
    put_archives(made.select(archive.alias("archive"), F.concat(F.lit("d/"), named).alias("name"), "content"))
    ingest_folder(lake, folder, "^test", options=Options(encoding="utf-8", meta=META, **_BOTH_WAYS))
    other = F.concat(F.lit(f"{folder}/again/"), F.pmod("n", F.lit(_ZIP_FILES)), F.lit("-"), F.floor(F.col("n") / _ZIP_FILES**2), F.lit(".zip"))
    put_archives(made.select(other.alias("archive"), F.concat(F.lit("again/"), named).alias("name"), "content"))
    ingest_folder(lake, folder, "^test", options=Options(encoding="utf-8", meta=META, whole_file_bytes=120_000, split_bytes=40_000))
    number = F.regexp_extract("source_file", r"test_(\d+)", 1).cast("bigint")
    return lake.readings().select(number.alias("file_no"), "Time", "value", "sensor_id")


def document_zips(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Files of texts in archives, one in three of the entries a table; and per language an archive that is none."""
    docs = table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / _FILE_DOCS).alias("n"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    archive = F.concat(F.lit(f"{folder}/"), F.floor(F.col("n") / _ZIP_FILES), F.lit(".zip"))
    name = F.when(F.col("n") % 3 == 0, F.concat(F.lit("day/User_"), "n", F.lit(".csv"))).otherwise(F.concat(F.lit("notes/"), "n", F.lit(".txt")))
    put_piece_archives(docs.select(archive.alias("archive"), name.alias("name"), "doc_id", "text"))
    bad = table(spark, sf_dir, "documents").groupBy("lang").agg(F.min_by("text", "doc_id").alias("text"))
    put_files(bad.select(F.concat(F.lit(f"{folder}/_bad/"), "lang", F.lit(".zip")).alias("path"), F.encode(F.substring("text", 1, 200), "UTF-8").alias("content")))


_ZIP_OF = f"(n // {_ZIP_FILES}) || '.zip'"
_FILE_NOS = f"(SELECT DISTINCT doc_id // {_FILE_DOCS} AS n FROM documents)"


@query(
    "archive_listing",
    f"""SELECT {_ZIP_OF} AS archive, 'day/User_' || n || '.csv' AS path, '' AS error FROM {_FILE_NOS} WHERE n % 3 = 0
        UNION ALL SELECT lang || '.zip', '/_bad/' || lang || '.zip', 'invalid archive' FROM documents GROUP BY lang""",
)
def archive_listing(spark, sf_dir):
    """Entries from the archives' directories alone; a file that is no archive stands for itself, with the reason."""
    folder = shared_dir(spark, "zips")
    document_zips(spark, sf_dir, folder)
    found = archives.as_listing(archives.find_csv_in_archives(spark, folder, "(Cond|User|test)"))
    bad = F.col("error").isNotNull()
    archive = basename(F.when(bad, F.col("path")).otherwise(F.col("source_zip")))
    path = F.when(bad, F.regexp_extract("path", "/_bad/.*", 0)).otherwise(F.col("path"))
    return found.select(archive.alias("archive"), path.alias("path"), F.coalesce(F.regexp_extract("error", "^[a-z ]+", 0), F.lit("")).alias("error"))


@query(
    "archive_extract",
    f"""SELECT {_ZIP_OF} AS archive, CASE WHEN n % 3 = 0 THEN 'day' || chr(92) || 'User_' || n || '.csv' ELSE 'x/' || n || '.txt' END AS requested,
               CASE WHEN n % 3 = 0 THEN 'day/User_' || n || '.csv' ELSE 'notes/' || n || '.txt' END AS entry_path, text_hash, CAST(NULL AS VARCHAR) AS error
        FROM (SELECT doc_id // {_FILE_DOCS} AS n, sha256(string_agg(coalesce(text, ''), '. ' ORDER BY doc_id)) AS text_hash FROM documents GROUP BY 1)""",
)
def archive_extract(spark, sf_dir):
    """Every entry of every archive, asked for with a backslash or in another folder, read from its place; its texts are put
    together again from the sentences."""
    folder, n = shared_dir(spark, "zips"), F.col("n")
    document_zips(spark, sf_dir, folder)
    numbers = table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / _FILE_DOCS).alias("n")).distinct()
    asked = numbers.select(
        F.concat(F.lit(f"{folder}/"), F.floor(n / _ZIP_FILES), F.lit(".zip")).alias("source_zip"),
        F.when(n % 3 == 0, F.concat(F.lit("day\\User_"), n, F.lit(".csv"))).otherwise(F.concat(F.lit("x/"), n, F.lit(".txt"))).alias("path"),
    )
    found = archives.extract_entries(asked)
    lines = found.select("source_zip", "requested", "entry_path", "error", F.decode("content", "UTF-8").alias("text"))
    rows = lines.selectExpr("*", f"{split_lines('text')} AS lines").selectExpr("*", "slice(lines, 4, size(lines)) AS rows")
    cells = rows.withColumn("cells", F.expr(f"transform(rows, row -> {split_fields('row')}[1])"))
    text = F.expr(f"array_join(transform(cells, cell -> coalesce({field_value('cell')}, '')), '. ')")
    return cells.select(basename(F.col("source_zip")).alias("archive"), "requested", "entry_path", F.sha2(text.cast("binary"), 256).alias("text_hash"), "error")


def file_states(lake: Lake) -> DataFrame:
    """Final events of a lake's files and their numbers of readings."""
    counts = rows_per_file(lake.readings()).select(F.col("source_file").alias("full_path"), "source_zip", "n_rows")
    joined = lake.events().where(F.col("status").isin(COMPLETED, FAILED)).join(counts, ["full_path", "source_zip"], "left")
    file = F.when(F.col("source_zip") == "", basename(F.col("full_path"))).otherwise(F.col("full_path"))
    return joined.select(file.alias("file"), basename(F.col("source_zip")).alias("archive"), "status", F.coalesce("n_rows", F.lit(0)).alias("n"))


@query(
    "archive_ingest",
    f"""SELECT {_ZIP_OF} AS archive, 'day/User_' || n || '.csv' AS file, 'COMPLETED' AS status, count(*) AS n
        FROM ({_PIECES}) p WHERE p.n % 3 = 0 GROUP BY p.n
        UNION ALL SELECT '', lang || '.zip', 'FAILED', 0 FROM documents GROUP BY lang""",
)
def archive_ingest(spark, sf_dir):
    """Tables in archives, read entry by entry from their places, large ones as lines; archives that are none fail alone, on record."""
    folder, lake = shared_dir(spark, "zips"), Lake(spark, shared_dir(spark, "lake"))
    document_zips(spark, sf_dir, folder)
    ingest_folder(lake, folder, "(Cond|User|test)", options=Options(encoding="utf-8", meta=META, **_BOTH_WAYS))
    return file_states(lake)


@query(
    "file_listing",
    f"""SELECT CASE n % 4 WHEN 0 THEN '_d/_test_' WHEN 1 THEN '.e/.test_' WHEN 2 THEN 'f [1]/test +%_' ELSE '日本/test_' END || n || '.csv' AS path,
               CAST(CASE WHEN n % 7 = 0 THEN 0 ELSE bytes END AS BIGINT) AS length
        FROM (SELECT doc_id // {_FILE_DOCS} AS n, sum(strlen(coalesce(text, ''))) AS bytes FROM documents GROUP BY 1) WHERE n % 5 <> 0""",
)
def file_listing(spark, sf_dir):
    """Files of odd names, some hidden, some empty, found by tasks; those with another ending or name are not."""
    folder, n = shared_dir(spark, "files"), F.col("n")
    place = F.when(n % 4 == 0, "_d/_test_").when(n % 4 == 1, ".e/.test_").when(n % 4 == 2, "f [1]/test +%_").otherwise("日本/test_")
    ending = F.when(n % 5 != 0, ".csv").when(n % 2 == 0, ".CSV").otherwise(".csv.txt")
    grouped = table(spark, sf_dir, "documents").groupBy(F.floor(F.col("doc_id") / _FILE_DOCS).alias("n")).agg(F.array_join(F.collect_list("text"), "").alias("text"))
    content = F.encode(F.when(n % 7 == 0, "").otherwise(F.col("text")), "UTF-8")
    put_files(grouped.select(F.concat(F.lit(f"{folder}/"), place, n, ending).alias("path"), content.alias("content")))
    found = files.find_csv_files(spark, folder, "(?P<kind>test)")
    return found.select(F.substring("path", F.length(F.lit(opened.qualified(spark, folder))) + 2, F.length("path")).alias("path"), "length")


_AUTO = ["UTF-8", "UTF-16LE", "UTF-16BE", "windows-31j", "EUC-JP", "ISO-2022-JP"]
_KANA = "アイウエオ表ソ能キクケコサシスセ"


@query(
    "auto_charsets",
    f"""SELECT doc_id // {_FILE_DOCS} AS file_no, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(i + 100000 * (doc_id % {_FILE_DOCS})) AS "Time",
               '日本' || chr(10) || translate(sha256(t || i), '0123456789abcdef', '{_KANA}') AS value
        FROM (SELECT doc_id, coalesce(text, '') AS t, unnest(range(0, 3 + doc_id % 40)) AS i FROM documents)""",
)
def auto_charsets(spark, sf_dir):
    """Japanese files in six charsets, with and without marks, detected the same whether read whole or in splits."""
    configure(spark)
    folder, lake = shared_dir(spark, "files"), Lake(spark, shared_dir(spark, "lake"))
    value = f"concat('\"日本\\n', translate(sha2(cast(concat(coalesce(text, ''), i) AS binary), 256), '0123456789abcdef', '{_KANA}'), '\"')"
    time = f"date_format(timestampadd(SECOND, i + 100000 * (doc_id % {_FILE_DOCS}), TIMESTAMP_NTZ'2024-01-01 00:00:00'), 'yyyy/M/d H:mm:ss')"
    body = F.expr(f"array_join(transform(sequence(0, cast(2 + doc_id % 40 AS int)), i -> concat({time}, ',', {value}, ',')), '\n')")
    n = F.floor(F.col("doc_id") / _FILE_DOCS)
    parts = table(spark, sf_dir, "documents").select("doc_id", body.alias("body")).groupBy(n.alias("n")).agg(F.sort_array(F.collect_list(F.struct("doc_id", "body"))).alias("parts"))
    texts = parts.select("n", F.concat(F.lit(", 温度\n, 温度ソ\n, ℃\n"), F.array_join("parts.body", "\n")).alias("text"))
    kind, marks = F.pmod(F.xxhash64("n"), F.lit(len(_AUTO))), {"UTF-16LE": "FFFE", "UTF-16BE": "FEFF"}
    content = F.lit(None).cast("binary")
    for i, name in enumerate(_AUTO):
        coded = F.encode("text", name)
        content = F.when(kind == i, F.concat(F.unhex(F.lit(marks[name])), coded) if name in marks else coded).otherwise(content)
    put_files(texts.select(F.concat(F.lit(f"{folder}/test_"), "n", F.lit(".csv")).alias("path"), content.alias("content")))
    ingest_folder(lake, folder, "test", options=Options(encoding="auto", meta=META, **_BOTH_WAYS))
    number = F.regexp_extract("source_file", r"test_(\d+)", 1).cast("bigint")
    return lake.readings().select(number.alias("file_no"), "Time", "value")


@query(
    "stream_mixed",
    f"""SELECT CASE WHEN n % 3 = 2 THEN 'day/' ELSE '' END || CASE WHEN n % 3 = 1 THEN '_' ELSE '' END || 'test_' || n || '.csv' AS file,
               CASE WHEN n % 3 = 2 THEN {_ZIP_OF} ELSE '' END AS archive, CASE WHEN n % 7 = 0 THEN 'FAILED' ELSE 'COMPLETED' END AS status,
               CASE WHEN n % 7 = 0 THEN 0 ELSE count(*) END AS n
        FROM ({_PIECES}) p GROUP BY p.n""",
)
def stream_mixed(spark, sf_dir):
    """A stream over loose, hidden, empty and archived files, in two snapshots: its ledger and its readings per file."""
    folder, root, n = shared_dir(spark, "files"), shared_dir(spark, "lake"), F.col("n")
    made = piece_files(spark, sf_dir).withColumn("content", F.when(n % 7 == 0, F.lit(b"")).otherwise(F.col("content")))
    name = F.concat(F.when(n % 3 == 1, "_").otherwise(""), F.lit("test_"), n, F.lit(".csv"))
    put_files(made.where(n % 3 != 2).select(F.concat(F.lit(f"{folder}/"), F.pmod(F.xxhash64(n), F.lit(7)), F.lit("/"), name).alias("path"), "content"))
    archive = F.concat(F.lit(f"{folder}/_zip/"), F.floor(n / _ZIP_FILES), F.lit(".zip"))
    put_archives(made.where(n % 3 == 2).select(archive.alias("archive"), F.concat(F.lit("day/"), name).alias("name"), "content"))
    lake, options = Lake(spark, root), Options(encoding="utf-8", meta=META, **_BOTH_WAYS)
    in_half = max(1, made.where(n % 3 != 2).count() // 2)
    stream_ingest(lake, folder, f"{root}-checkpoint", "test", max_files_per_trigger=in_half, options=options).awaitTermination()
    return file_states(lake)
