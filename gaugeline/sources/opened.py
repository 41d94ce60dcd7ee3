"""Files opened by the task that reads them: folders, archive directories, contents, digests and lines.

A work list is a DataFrame with one narrow row per thing to read. It is dealt out evenly, every task opens what its rows name, and
what cannot be opened or read comes back as a row with ``error``, so nothing but that one file fails. No list of names passes
through the driver, names that begin with ``_`` or ``.`` and empty files are like others, and no file is held in memory unless its
contents are asked for.

File systems are those of pyarrow: local paths, ``s3`` (also ``s3a``), ``gs``, ``hdfs``, ``abfss``.
"""

from __future__ import annotations

import bz2
import hashlib
import os
import re
import struct
import sys
import zipfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeline.session import shared_dir

# The functions below travel to the executors with the job, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes read at once, and bytes of contents or lines in one Arrow batch.
BLOCK_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
#: Work of one task: bytes, and rows.
TASK_BYTES = 128 << 20
TASK_ROWS = 2000
#: Folders that a task lists before it hands the rest back.
FOLDERS_AT_ONCE = 256
HEADER_ROWS = 3

#: How lines are found: in bytes as they are (newline is one byte, quotes and commas never part of a character), or after
#: decoding. In the latter case lines come out in UTF-8.
BYTES, ISO_2022_JP = "bytes", "iso2022_jp"
UTF16_LE, UTF16_BE, UTF32_LE, UTF32_BE = "utf-16-le", "utf-16-be", "utf-32-le", "utf-32-be"
#: Units of the forms whose newline has more than one byte.
UNITS = {UTF16_LE: "<u2", UTF16_BE: ">u2", UTF32_LE: "<u4", UTF32_BE: ">u4"}

# Signatures and compression methods of ZIP files.
LOCAL_HEADER = b"PK\x03\x04"
STORED, DEFLATED, BZIP2 = 0, 8, 12

#: Where the bytes of a file are: a loose file, or (with ``source_zip``) an archive and the place of the entry in it.
WORK = "path string, source_zip string, length bigint, offset bigint, packed bigint, method int, crc bigint"
WORK_COLUMNS = ["path", "source_zip", "length", "offset", "packed", "method", "crc"]


# --- file systems ---------------------------------------------------------------------------------------------------


_SYSTEMS: dict[str, tuple] = {}


def _file_system(root: str) -> tuple[pafs.FileSystem, str]:
    if root not in _SYSTEMS:
        found, base = pafs.FileSystem.from_uri(root)
        _SYSTEMS[root] = found, base.rstrip("/")
    return _SYSTEMS[root]


def locate(uri: str) -> tuple[pafs.FileSystem, str]:
    """A file system and the path on it."""
    m = re.match(r"([A-Za-z][A-Za-z0-9+.-]*)://([^/]*)(/.*)?$", uri, re.DOTALL)
    if not m or m[1] == "file":
        return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    scheme = "s3" if m[1] in ("s3a", "s3n") else m[1]
    found, base = _file_system(f"{scheme}://{m[2]}/")
    return found, base + (m[3] or "")


def reason(e: BaseException) -> str:
    if isinstance(e, FileNotFoundError):
        return "missing file"
    return f"unreadable: {type(e).__name__}: {' '.join(str(e).split())[:300]}"


# --- folders --------------------------------------------------------------------------------------------------------

LISTED = "path string, is_folder boolean, length bigint, modified bigint, error string"
_LISTED = pa.schema([("path", pa.string()), ("is_folder", pa.bool_()), ("length", pa.int64()), ("modified", pa.int64()), ("error", pa.string())])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: Callable[[tuple], int] = lambda r: 256) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of about ``BATCH_BYTES``."""

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    held, n = [], 0
    for row in rows:
        held.append(row)
        n += size(row)
        if n >= BATCH_BYTES:
            yield batch()
            held, n = [], 0
    if held:
        yield batch()


def _in_folder(uri: str) -> Iterator[tuple]:
    """Files and folders directly in a folder. A link to a folder isn't followed."""
    system, path = locate(uri)
    base = uri.rstrip("/")
    if isinstance(system, pafs.LocalFileSystem):
        with os.scandir(path) as entries:
            for e in entries:
                name = f"{re.sub(r'^file:/+', '/', base)}/{e.name}"
                try:
                    name.encode()
                    folder = e.is_dir(follow_symlinks=False)
                    if folder or e.is_file():
                        at = e.stat()
                        yield name, folder, None if folder else at.st_size, at.st_mtime_ns, None
                except UnicodeEncodeError:
                    yield name.encode("utf-8", "replace").decode(), False, None, None, "unreadable: name is not UTF-8"
                except OSError as err:
                    yield name, False, None, None, reason(err)
        return
    for info in system.get_file_info(pafs.FileSelector(path)):
        if info.type in (pafs.FileType.File, pafs.FileType.Directory):
            folder = info.type == pafs.FileType.Directory
            yield f"{base}/{info.base_name}", folder, None if folder else info.size, info.mtime_ns, None


def list_folders(batches: Iterator[pa.RecordBatch], wanted: Callable[[str], bool]) -> Iterator[pa.RecordBatch]:
    """Wanted files (by their names) below the given folders, as far as ``FOLDERS_AT_ONCE`` go; folders that weren't looked into
    come back."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for given in batch["path"].to_pylist():
                left, looked = [given], 0
                while left:
                    folder = left.pop()
                    if looked >= FOLDERS_AT_ONCE:
                        yield folder, True, None, None, None
                        continue
                    looked += 1
                    try:
                        for row in _in_folder(folder):
                            if row[1]:
                                left.append(row[0])
                            elif wanted(row[0].rsplit("/", 1)[-1]):
                                yield row
                    except FileNotFoundError:
                        pass  # gone meanwhile, or never there
                    except Exception as e:
                        yield folder, False, None, None, reason(e)

    return _batches(rows(), _LISTED)


def named(suffixes: tuple[str, ...] = ("",), pattern: str | None = None) -> Callable[[str], bool]:
    """A test of file names: one of the endings, and a match of the (Python) regular expression anywhere."""
    regex = re.compile(pattern) if pattern else None
    return lambda name: name.endswith(suffixes) and (regex is None or regex.search(name) is not None)


def qualified(spark: SparkSession, path: str) -> str:
    """An absolute path with its file system; local ones without a scheme."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return re.sub(r"^file:/+", "/", at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString())


def walk(spark: SparkSession, folder: str, wanted: Callable[[str], bool] = named(), work: str | None = None) -> DataFrame:
    """``path, length, modified, error`` of all wanted files below a folder, listed by tasks, round by round.

    A round looks into the folders that the one before handed back and writes what it finds below ``work``; a tree of few folders
    takes one round. A folder that isn't there holds no files; one that can't be read is a row with an error.
    """
    at = work or shared_dir(spark, "listing")
    folders = spark.createDataFrame([(qualified(spark, folder),)], "path string")
    level = 0
    while True:
        folders.mapInArrow(lambda batches: list_folders(batches, wanted), LISTED).write.mode("overwrite").parquet(f"{at}/level={level}")
        left = spark.read.schema(LISTED).parquet(f"{at}/level={level}").where("is_folder").select("path")
        n = left.count()
        if not n:
            return spark.read.schema(LISTED).parquet(*[f"{at}/level={i}" for i in range(level + 1)]).where("NOT is_folder").drop("is_folder")
        folders = left.repartition(min(n, 4 * spark.sparkContext.defaultParallelism), "path")
        level += 1


# --- archives -------------------------------------------------------------------------------------------------------

ENTRIES = "source_zip string, path string, entry_index bigint, length bigint, offset bigint, packed bigint, method int, crc bigint, error string"
_ENTRIES = pa.schema([
    ("source_zip", pa.string()), ("path", pa.string()), ("entry_index", pa.int64()), ("length", pa.int64()), ("offset", pa.int64()),
    ("packed", pa.int64()), ("method", pa.int32()), ("crc", pa.int64()), ("error", pa.string()),
])


def directory(archive: str, opened, wanted: Callable[[str], bool]) -> Iterator[tuple]:
    """Entries of an archive from its directory, which stands at its end: no entry's bytes are read. Of equal names the last counts."""
    try:
        infos = zipfile.ZipFile(opened).infolist()
    except Exception as e:
        yield archive, None, None, None, None, None, None, None, f"invalid archive: {' '.join(str(e).split())}"
        return
    last = {info.filename: i for i, info in enumerate(infos)}
    for i, info in enumerate(infos):
        if not info.is_dir() and last[info.filename] == i and wanted(info.filename):
            error = "encrypted archive entry" if info.flag_bits & 1 else None
            yield archive, info.filename, i, info.file_size, info.header_offset, info.compress_size, info.compress_type, info.CRC, error


def read_directories(archives: DataFrame, pattern: str | None = None, suffix: str = ".csv") -> DataFrame:
    """Entries of the archives named by ``path`` whose names end with ``suffix`` and whose basenames contain a match of ``pattern``.

    An archive that can't be opened is one row with ``error`` and no ``path``.
    """
    fits = named((suffix,), pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for archive in batch["path"].to_pylist():
                    try:
                        system, path = locate(archive)
                        with system.open_input_file(path) as f:
                            yield from directory(archive, f, lambda name: fits(name.rsplit("/", 1)[-1]))
                    except Exception as e:
                        yield archive, None, None, None, None, None, None, None, reason(e)

        return _batches(rows(), _ENTRIES)

    return archives.select("path").mapInArrow(run, ENTRIES)


class Entry:
    """The bytes of one archive entry, inflated as they are read. What doesn't agree with the directory is a ValueError."""

    def __init__(self, opened, length: int, offset: int, packed: int, method: int, crc: int):
        self.opened, self.left, self.length, self.crc = opened, packed, length, crc
        opened.seek(offset)
        head = opened.read(30)
        if head[:4] != LOCAL_HEADER:
            raise ValueError("no entry where the archive's directory says")
        name, extra = struct.unpack("<HH", head[26:30])
        opened.seek(offset + 30 + name + extra)
        if method not in (STORED, DEFLATED, BZIP2):
            raise ValueError(f"compression method {method} is not supported")
        self.inflate = {STORED: None, DEFLATED: zlib.decompressobj(-15), BZIP2: bz2.BZ2Decompressor()}[method]
        self.pending, self.seen, self.sum = b"", 0, 0

    def read(self, n: int) -> bytes:
        """About ``n`` bytes, ``b''`` at the end."""
        out = b""
        while not out:
            if self.inflate is None:
                out = self.opened.read(min(n, self.left))
                self.left -= len(out)
                if not out:
                    break
                continue
            if not self.pending and self.left and not (isinstance(self.inflate, bz2.BZ2Decompressor) and not self.inflate.needs_input):
                self.pending = self.opened.read(min(n, self.left))
                if not self.pending:
                    raise ValueError("archive entry is cut off")
                self.left -= len(self.pending)
            out = self._inflated(n)
            if not out and (self.inflate.eof or not (self.pending or self.left)):
                break
        self.seen += len(out)
        self.sum = zlib.crc32(out, self.sum)
        if not out and (self.seen != self.length or self.sum != self.crc):
            raise ValueError("archive entry doesn't agree with its checksum")
        return out

    def _inflated(self, n: int) -> bytes:
        if self.inflate.eof:
            return b""
        out = self.inflate.decompress(self.pending, n)
        self.pending = b"" if isinstance(self.inflate, bz2.BZ2Decompressor) else self.inflate.unconsumed_tail
        return out


class Opened:
    """The bytes of a work row from any place on; an entry has to be read from its beginning."""

    def __init__(self, row: dict):
        self.row = row
        system, path = locate(row["source_zip"] or row["path"])
        self.file = system.open_input_file(path)
        if not row["source_zip"] and row["length"] is not None and self.file.size() != row["length"]:
            self.file.close()
            raise ValueError("the file's length has changed")

    def __enter__(self) -> Opened:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def blocks(self, start: int = 0, size: int = BLOCK_BYTES) -> Iterator[bytes]:
        if self.row["source_zip"]:
            skip, entry = start, Entry(self.file, *(self.row[c] for c in ("length", "offset", "packed", "method", "crc")))
            while data := entry.read(size):
                if skip < len(data):
                    yield data[skip:]
                skip = max(0, skip - len(data))
            return
        self.file.seek(start)
        while data := self.file.read(size):
            yield data


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def dealt(work: DataFrame, total_bytes: int, rows: int, *more: str) -> DataFrame:
    """A work list in as many tasks as its bytes and rows are worth, at least one per core."""
    cores = work.sparkSession.sparkContext.defaultParallelism
    n = max(min(rows, 2 * cores), -(-total_bytes // TASK_BYTES), -(-rows // TASK_ROWS), 1)
    return work.repartition(int(n), "path", "source_zip", *more)


# --- contents and digests -------------------------------------------------------------------------------------------

CONTENTS = "path string, source_zip string, length bigint, content binary, error string"
_CONTENTS = pa.schema([("path", pa.string()), ("source_zip", pa.string()), ("length", pa.int64()), ("content", pa.binary()), ("error", pa.string())])


def contents(work: DataFrame, *carried: str) -> DataFrame:
    """The whole bytes of every work row, or the error that kept them from being read.

    Where ``work`` has ``file_hash``, contents with another SHA-256 are an error. ``carried`` are more text columns that come along, so
    that contents need not be joined; then a row may have no path. Rows of one file that follow each other read it once. Rows that have
    an ``error`` or no path aren't read.
    """
    known = [c for c in ("file_hash", "error") if c in work.columns]
    schema = pa.schema([*_CONTENTS, *[(c, pa.string()) for c in carried]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            last, content, error = None, None, None
            for row in each(batches):
                mark = [row[c] for c in (*WORK_COLUMNS, *known)]
                if mark != last:
                    last, content, error = mark, None, row.get("error")
                    try:
                        if error is None and (row["path"] is not None or not carried):
                            with Opened(row) as f:
                                content = b"".join(f.blocks())
                            if row.get("file_hash") not in (None, hashlib.sha256(content).hexdigest()):
                                raise ValueError("the file has changed")
                    except Exception as e:
                        content, error = None, reason(e)
                yield row["path"], row["source_zip"], row["length"] if content is None else len(content), content, error, *[row[c] for c in carried]

        return _batches(rows(), schema, lambda r: len(r[3] or b"") + 256)

    return work.select(*WORK_COLUMNS, *known, *carried).mapInArrow(run, ", ".join([CONTENTS, *[f"{c} string" for c in carried]]))


BLOCKS = "path string, source_zip string, raw binary"


def read_blocks(work: DataFrame) -> DataFrame:
    """Bytes of splits in blocks of whole lines, without regard to quotes; what can't be read gives no rows here."""
    schema = pa.schema([("path", pa.string()), ("source_zip", pa.string()), ("raw", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for row in each(batches):
                try:
                    with Opened(row) as f:
                        for at, data in whole_lines(f, row["start"], row["form"], border=row["end"]):
                            if row["end"] is not None and at >= row["end"]:
                                break
                            yield row["path"], row["source_zip"], data
                except Exception:
                    continue  # the passes that count report it

        return _batches(rows(), schema, lambda r: len(r[2]) + 256)

    return work.select(*SPLIT_COLUMNS).mapInArrow(run, BLOCKS)


def stat(paths: DataFrame) -> DataFrame:
    """``path, source_zip, length, error`` of named loose files."""
    schema = pa.schema([("path", pa.string()), ("source_zip", pa.string()), ("length", pa.int64()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for path in batch["path"].to_pylist():
                    try:
                        system, at = locate(path)
                        info = system.get_file_info(at)
                        found = info.type == pafs.FileType.File
                        yield path, "", info.size if found else None, None if found else "missing file"
                    except Exception as e:
                        yield path, "", None, reason(e)

        return _batches(rows(), schema)

    return paths.select("path").mapInArrow(run, "path string, source_zip string, length bigint, error string")


DIGESTS = "path string, source_zip string, file_hash string, head binary, error string"
_DIGESTS = pa.schema([("path", pa.string()), ("source_zip", pa.string()), ("file_hash", pa.string()), ("head", pa.binary()), ("error", pa.string())])


def digests(work: DataFrame) -> DataFrame:
    """SHA-256 (lower-case hex) and the first four bytes of every work row, block by block: files of any length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for row in each(batches):
                seen, head, error = hashlib.sha256(), b"", None
                try:
                    with Opened(row) as f:
                        for data in f.blocks():
                            head = head or data[:4]
                            seen.update(data)
                except Exception as e:
                    error = reason(e)
                yield row["path"], row["source_zip"], None if error else seen.hexdigest(), head, error

        return _batches(rows(), _DIGESTS)

    return work.select(*WORK_COLUMNS).mapInArrow(run, DIGESTS)


# --- quotes ---------------------------------------------------------------------------------------------------------
#
# A quote opens a field at the field's start only; the field then ends at a quote that a comma or the line's end follows, two quotes
# standing for one. If another character follows, the field was never quoted: its quote is text and the line ends where it ends.
# Between two lines a file is therefore in one of two states: NONE, or OPEN (a quoted field may go on). What a line does depends
# on the state before it alone, so a split is a function of two states, and those of all splits are composed by a scan.

NONE, OPEN = 0, 1
_CLOSED = re.compile(rb'"[^"]*+(?:""[^"]*+)*+"(?=,|\Z)')
_TO_END = re.compile(rb'"[^"]*+(?:""[^"]*+)*+\Z')
_INSIDE = re.compile(rb'[^"]*+(?:""[^"]*+)*+')
#: Matches wherever a line may leave a quote open; a block without a match leaves none.
_MAYBE_OPEN = re.compile(rb'(?:^|,)"[^"\n]*+(?:""[^"\n]*+)*+$', re.MULTILINE)

PASSED, ENDED, REOPENED, BROKEN = "passed", "ended", "reopened", "broken"


def opens(line: bytes, at: int = 0) -> bool:
    """Whether a line, read as fields from ``at`` on, leaves a quote open."""
    while 0 <= at < len(line):
        if line[at : at + 1] == b'"':
            if m := _CLOSED.match(line, at):
                if m.end() == len(line):
                    return False
                at = m.end() + 1
                if at == len(line):
                    return False
                continue
            if _TO_END.match(line, at):
                return True
        at = line.find(b',"', at)
        if at < 0:
            return False
        at += 1
    return False


def resume(line: bytes) -> str:
    """What a line does to a quote that an earlier line opened."""
    at = _INSIDE.match(line).end()
    if at == len(line):
        return PASSED
    if at + 1 < len(line) and line[at + 1 : at + 2] != b",":
        return BROKEN
    return REOPENED if at + 1 < len(line) and opens(line, at + 2) else ENDED


def after(line: bytes, state: int) -> int:
    """The state after a line."""
    if state == OPEN:
        what = resume(line)
        if what != BROKEN:
            return NONE if what == ENDED else OPEN
    return OPEN if opens(line) else NONE


# --- lines ----------------------------------------------------------------------------------------------------------


def newline_places(data: bytes, form: str) -> np.ndarray:
    """Where lines end: places behind each newline."""
    if form in UNITS:
        size = np.dtype(UNITS[form]).itemsize
        return (np.flatnonzero(np.frombuffer(data, UNITS[form], len(data) // size) == 10) + 1) * size
    return np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1


def whole_lines(f: Opened, start: int, form: str, size: int = BLOCK_BYTES, border: int | None = None) -> Iterator[tuple[int, bytes]]:
    """Blocks of whole lines with their places, from the first line that begins at ``start`` or later.

    No block holds lines from both sides of ``border``, so that a split's own lines are all that is looked at, however much is read.
    """
    unit = np.dtype(UNITS[form]).itemsize if form in UNITS else 1
    at = max(0, start - start % unit - unit) if start else 0
    held, first = b"", start == 0
    for data in f.blocks(at, size):
        data = held + data
        cuts = newline_places(data, form)
        if not len(cuts):
            held = data
            continue
        if not first:  # what stands before the first newline belongs to a line that began earlier
            at, data, cuts, first = at + int(cuts[0]), data[int(cuts[0]) :], cuts[1:] - cuts[0], True
        end = int(cuts[-1]) if len(cuts) else 0
        if border is not None and at < border < at + end:
            own = int(cuts[np.searchsorted(cuts, border - at)])
            yield at, data[:own]
            if own < end:
                yield at + own, data[own:end]
        elif end:
            yield at, data[:end]
        at, held = at + end, data[end:]
    if held and first:
        yield at, held


def in_utf8(data: bytes, form: str) -> bytes:
    if form == BYTES:
        return data
    if form == ISO_2022_JP:
        return data if b"\x1b" not in data else b"\n".join(x.decode(form, "replace").encode() if b"\x1b" in x else x for x in data.split(b"\n"))
    return data.decode(form, "replace").encode("utf-8", "replace")


_MARK = b"\xef\xbb\xbf"


def lines_of(at: int, data: bytes, form: str, bom: bool) -> Iterator[tuple[int, bytes]]:
    """Lines of a block with their places, without line ends. ``bom``: a mark at the file's beginning is left out."""
    begin = 0
    for end in [*newline_places(data, form).tolist(), len(data)]:
        if begin < end:
            line = in_utf8(data[begin:end], form).removesuffix(b"\n").removesuffix(b"\r")
            yield at + begin, line.removeprefix(_MARK) if bom and at + begin == 0 else line
        begin = end


def text_of(at: int, data: bytes, form: str, bom: bool) -> bytes:
    """A whole block."""
    text = in_utf8(data, form)
    return text.removeprefix(_MARK) if bom and at == 0 else text


def quote_states(text: bytes, state: int = NONE) -> tuple[np.ndarray, np.ndarray, int] | None:
    """Places of the newlines in whole lines that begin in ``state``, the state behind each of them, and the state at the end.

    None unless every second quote stands at the start of a field and each of the others at the end of one (or both are one of two
    that stand for one): then the number of quotes before a place tells its state, and no line has to be looked at on its own.
    """
    padded = np.frombuffer(b"\n" + text + b"\n\n", np.uint8)
    quotes = np.flatnonzero(padded == 34)
    opening, closing = quotes[state::2], quotes[1 - state :: 2]
    before, behind = padded[opening - 1], padded[closing + 1]
    if not ((before == 44) | (before == 10) | (before == 34)).all():
        return None
    if not ((behind == 44) | (behind == 10) | (behind == 34) | ((behind == 13) & (padded[closing + 2] == 10))).all():
        return None
    newlines = np.flatnonzero(padded[1:-2] == 10)
    return newlines, (np.searchsorted(quotes, newlines + 1) + state) & 1, (len(quotes) + state) & 1


def split_records(at: int, data: bytes, form: str, bom: bool) -> tuple[list[bytes], int]:
    """Records of a block of whole lines that begins outside quotes, and how many of its bytes they take: all but those of a last
    record that isn't complete. 0 bytes: the lines have to be looked at one by one."""
    text = text_of(at, data, form, bom)
    if b'"' not in text or not _MAYBE_OPEN.search(text):
        found = text.split(b"\n")
        return found if found[-1] else found[:-1], len(data)
    known = quote_states(text)
    if known is None:
        return [], 0
    newlines, states, last = known
    ends = newlines[states == NONE]
    taken = len(data)
    if last == OPEN:
        if not len(ends):
            return [], 0
        places = newline_places(data, form)
        if len(places) != len(newlines):
            return [], 0
        taken = int(places[np.flatnonzero(states == NONE)[-1]])
    cuts = ends.tolist()
    if last == NONE and (not cuts or cuts[-1] + 1 < len(text)):
        cuts.append(len(text))  # the file's last line, without a line end
    found = [text[a:b] for a, b in zip([0, *[c + 1 for c in cuts]], cuts)]
    if b"\r" in text:
        found = [r.replace(b"\r\n", b"\n").removesuffix(b"\r") for r in found]
    return found, taken


class Records:
    """Records (lines, joined where a quoted field goes over line ends) that begin in a stretch of a file.

    The state at the beginning of the stretch is known. A quote that is open there belongs to a record that began earlier; its lines
    are passed over. The last record of the stretch is read to its end, wherever that is.
    """

    def __init__(self, f: Opened, start: int, end: int | None, state: int, form: str = BYTES, bom: bool = False, size: int = BLOCK_BYTES):
        self.f, self.start, self.end, self.state, self.form, self.bom, self.size = f, start, end, state, form, bom, size

    def blocks(self, slow_until: int = 0) -> Iterator[tuple[int, list[int] | None, list[bytes]]]:
        """Place of a block, places of its records (None: not worked out), records. Blank lines outside quotes stay in."""
        end = float("inf") if self.end is None else self.end
        pending: list[tuple[int, bytes]] = []  # lines since the one whose quote is open
        anchor, foreign, state = -1, self.state == OPEN, self.state
        kept = None  # what a block before the end held, while its last record isn't complete

        def put(place: int, parts: list[bytes]) -> None:
            if self.start <= place < end:
                if places is not None:
                    places.append(place)
                records.append(b"\n".join(parts))

        for at, data in whole_lines(self.f, self.start, self.form, self.size, self.end):
            if at >= end and not pending and not (foreign and state == OPEN):
                return
            first, places, records = kept or (at, [], [])
            kept, tried = None, at >= end
            lines = lines_of(at, data, self.form, self.bom)
            while lines is not None:
                rest = None
                for place, line in lines:
                    if state == NONE and place >= end:
                        break
                    if state == NONE and not tried and place >= slow_until:
                        tried = True
                        found, taken = split_records(place, data[place - at :], self.form, self.bom)
                        if taken:
                            if records:
                                yield first, places, records
                            first, places, records = place, None, found
                            rest = lines_of(place + taken, data[place - at + taken :], self.form, self.bom)
                            break
                    what = resume(line) if state == OPEN else None
                    if what in (PASSED, REOPENED):
                        pending.append((place, line))
                        if what == REOPENED:
                            anchor = len(pending) - 1
                        continue
                    if what == ENDED:
                        if not foreign:
                            put(pending[0][0], [x for _, x in pending] + [line])
                        pending, anchor, foreign, state = [], -1, False, NONE
                        continue
                    if what == BROKEN:  # lines up to the one with the quote are a record, each line behind it is one
                        if not foreign:
                            put(pending[0][0], [x for _, x in pending[: anchor + 1]])
                        for p, x in pending[anchor + 1 :]:
                            put(p, [x])
                        pending, anchor, foreign, state = [], -1, False, NONE
                        if place >= end:
                            break
                    if opens(line):
                        pending, anchor, state = [(place, line)], 0, OPEN
                    else:
                        put(place, [line])
                lines = rest
            if pending and at < end <= at + len(data):
                kept = first, places, records
            else:
                yield first, places, records
        if kept:
            yield kept
        if pending and not foreign:  # never closed: the file has an error, and this is only its last record
            yield pending[0][0], [pending[0][0]], [b"\n".join(x for _, x in pending)]


def split_states(f: Opened, start: int, end: int | None, form: str, bom: bool, known: bool = False) -> tuple[int, int]:
    """The states after the lines that begin in a stretch, if it begins in NONE and in OPEN. ``known``: it begins in NONE, and the
    first of the two is given for both."""
    limit = float("inf") if end is None else end
    none, opened = NONE, NONE if known else OPEN
    for at, data in whole_lines(f, start, form, border=end):
        if at >= limit:
            break
        plain = text_of(at, data, form, bom)
        if b'"' not in plain:
            continue
        calm = none == NONE and not _MAYBE_OPEN.search(plain)
        tried = False
        for place, line in lines_of(at, data, form, bom):
            if place >= limit:
                break
            same = none == opened
            if same and calm:
                break
            if same and not tried:
                tried = True
                found = quote_states(text_of(place, data[place - at :], form, bom), none)
                if found is not None:
                    none = opened = found[2]
                    break
            if b'"' not in line:
                continue
            opened = after(line, opened)
            if not calm:
                none = opened if same else after(line, none)
    return none, opened


#: A split of a work row: its number, the bytes where it begins and ends (null: the end of the file), and how to read it.
SPLIT = WORK + ", split bigint, start bigint, end bigint, form string, bom boolean"
SPLIT_COLUMNS = [*WORK_COLUMNS, "split", "start", "end", "form", "bom"]


def splits(work: DataFrame, split_bytes: int, *carried: str) -> DataFrame:
    """Work rows (with ``form`` and ``bom``) cut into splits of whole units; an archive entry is one."""
    split_bytes = max(4, split_bytes // 4 * 4)
    n = F.when(F.col("source_zip") != "", F.lit(1)).otherwise(F.greatest(F.lit(1), F.ceil(F.col("length") / split_bytes))).cast("long")
    cut = work.select(*WORK_COLUMNS, "form", "bom", *carried, n.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("split"))
    end = F.when(F.col("split") < F.col("n") - 1, (F.col("split") + 1) * split_bytes)
    return cut.withColumns({"start": F.col("split") * split_bytes, "end": end}).select(*SPLIT_COLUMNS, *carried)


SCANNED = "path string, source_zip string, split bigint, if_none int, if_open int, heads array<bigint>, error string"
_SCANNED = pa.schema([("path", pa.string()), ("source_zip", pa.string()), ("split", pa.int64()), ("if_none", pa.int32()), ("if_open", pa.int32()), ("heads", pa.list_(pa.int64())), ("error", pa.string())])


def scan_splits(work: DataFrame) -> DataFrame:
    """What every split does to the state of quotes; the first one also tells where the header rows begin, read from the file's
    head as far as they go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for row in each(batches):
                none, opened, heads, error = NONE, OPEN, None, None
                try:
                    with Opened(row) as f:
                        none, opened = split_states(f, row["start"], row["end"], row["form"], row["bom"], known=row["split"] == 0)
                    if row["split"] == 0:
                        heads = []
                        with Opened(row) as f:
                            for _, places, records in Records(f, 0, None, NONE, row["form"], row["bom"], 1 << 16).blocks(slow_until=1 << 62):
                                heads += [p for p, r in zip(places, records, strict=True) if r not in (b"", b"\r")]
                                if len(heads) >= HEADER_ROWS:
                                    break
                        heads = heads[:HEADER_ROWS]
                except Exception as e:
                    error = reason(e)
                yield row["path"], row["source_zip"], row["split"], none, opened, heads, error

        return _batches(rows(), _SCANNED)

    return work.select(*SPLIT_COLUMNS).mapInArrow(run, SCANNED)


LINES = "path string, source_zip string, length bigint, chunk bigint, header_no int, raw binary, charset string, error string"
_LINES = pa.schema([("path", pa.string()), ("source_zip", pa.string()), ("length", pa.int64()), ("chunk", pa.int64()), ("header_no", pa.int32()), ("raw", pa.binary()), ("charset", pa.string()), ("error", pa.string())])


def read_records(work: DataFrame, chunk_bytes: int) -> DataFrame:
    """Non-blank records of splits that carry ``state`` (at their beginning), ``heads`` and ``charset``: ``path, source_zip, length,
    chunk, header_no, raw, charset``. A split that can't be read is one row with ``error``, and no more of its records come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each(batches):

            def batch(chunk: int, numbers: list | None, raw: list, row=row, error: str | None = None) -> pa.RecordBatch:
                n = max(len(raw), error is not None)
                same = lambda v, kind: pa.repeat(pa.scalar(v, kind), n)
                columns = [same(row["path"], pa.string()), same(row["source_zip"], pa.string()), same(row["length"], pa.int64()), same(chunk, pa.int64())]
                columns += [same(None, pa.int32()) if numbers is None else pa.array(numbers, pa.int32()), same(None, pa.binary()) if error else pa.array(raw, pa.binary()), same(row["charset"], pa.string()), same(error, pa.string())]
                return pa.RecordBatch.from_arrays(columns, schema=_LINES)

            heads = {place: i for i, place in enumerate(row["heads"] or [])}
            try:
                with Opened(row) as f:
                    for at, places, records in Records(f, row["start"], row["end"], row["state"], row["form"], row["bom"]).blocks(max(heads, default=-1) + 1):
                        chunk = max(at, row["start"]) // chunk_bytes
                        if places is None:
                            kept = [r for r in records if r and r != b"\r"]
                            if kept:
                                yield batch(chunk, None, kept)
                        elif found := [(heads.get(p), r) for p, r in zip(places, records, strict=True) if r and r != b"\r"]:
                            yield batch(chunk, *map(list, zip(*found, strict=True)))
            except Exception as e:
                yield batch(row["start"] // chunk_bytes, None, [], error=reason(e))

    return work.select(*SPLIT_COLUMNS, "state", "heads", "charset").mapInArrow(run, LINES)
