"""A stream of the files that appear below a folder, empty and hidden ones and archives included.

The offset is the number of a listing snapshot. Asked for the latest offset, the reader lists the folder, writes the names that no
snapshot holds yet as the next ones, of at most ``max_files`` names each, and answers with the last number. Snapshots are files in the
stream's checkpoint, complete before their number can enter an offset; so a batch that is repeated reads the same names again, and a
crash between the two loses none. As with Spark's own file source, a file counts by its path: one that is changed later isn't new.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from gaugeline.sources import opened

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "gaugeline_folder"
SCHEMA = "snapshot bigint, path string, length bigint, error string"
_ARROW = pa.schema([("snapshot", pa.int64()), ("path", pa.string()), ("length", pa.int64()), ("error", pa.string())])


class Snapshots:
    """Numbered lists of new files in a folder of the checkpoint."""

    def __init__(self, at: str):
        self.system, self.path = opened.locate(at)
        self.system.create_dir(self.path)
        self.last, self.known = 0, set()

    def name(self, number: int) -> str:
        return f"{self.path}/{number:020d}.json"

    def refresh(self) -> None:
        """Take in the snapshots that this reader doesn't know yet."""
        found = [int(f.base_name[:-5]) for f in self.system.get_file_info(pafs.FileSelector(self.path)) if f.base_name.endswith(".json")]
        for number in sorted(n for n in found if n > self.last):
            self.known.update(row[0] for row in self.read(number))
            self.last = number

    def read(self, number: int) -> list[list]:
        with self.system.open_input_stream(self.name(number)) as f:
            return json.loads(f.read())

    def add(self, rows: list[list]) -> None:
        number = self.last + 1
        with self.system.open_output_stream(f"{self.name(number)}.new") as f:
            f.write(json.dumps(rows).encode())
        self.system.move(f"{self.name(number)}.new", self.name(number))
        self.known.update(row[0] for row in rows)
        self.last = number


class Snapshot(InputPartition):
    def __init__(self, number: int):
        super().__init__(number)
        self.number = number


class FolderReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.at = options["path"], options["snapshots"]
        self.max_files = int(options.get("maxfiles", options.get("maxFiles", "10000")))
        self.suffixes = tuple(options["suffixes"].split(","))
        self.snapshots = None

    def initialOffset(self) -> dict:
        return {"snapshot": 0}

    def latestOffset(self) -> dict:
        if self.snapshots is None:
            self.snapshots = Snapshots(self.at)
        self.snapshots.refresh()
        wanted = opened.named(self.suffixes)
        left, found = [self.folder], []
        while left:
            folder = left.pop()
            try:
                for path, is_folder, length, _, error in opened._in_folder(folder):
                    if is_folder:
                        left.append(path)
                    elif wanted(path.rsplit("/", 1)[-1]) and path not in self.snapshots.known:
                        found.append([path, length, error])
            except FileNotFoundError:
                pass
        found.sort()
        for i in range(0, len(found), self.max_files):
            self.snapshots.add(found[i : i + self.max_files])
        return {"snapshot": self.snapshots.last}

    def partitions(self, start: dict, end: dict) -> list[Snapshot]:
        return [Snapshot(n) for n in range(start["snapshot"] + 1, end["snapshot"] + 1)]

    def read(self, partition: Snapshot) -> Iterator[pa.RecordBatch]:
        rows = Snapshots(self.at).read(partition.number)
        columns = [[partition.number] * len(rows), *([r[i] for r in rows] for i in range(3))]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)

    def commit(self, end: dict) -> None:
        pass


class FolderSource(DataSource):
    """``path`` (the folder), ``snapshots`` (where they are kept), ``suffixes`` (comma-separated endings), ``maxFiles`` (of a snapshot)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> FolderReader:
        return FolderReader(self.options)
