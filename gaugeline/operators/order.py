"""Runs of lines: a map-side summary of lines as they come, so that whether times repeat is known without shuffling lines.

Lines of a split come in the order of the file, and sensor files are written in the order of time. A run is the lines of one split
in one Arrow batch. Within it times either rise strictly or not; between runs it is enough that their spans of time don't meet.
A file whose runs all rise and whose spans are apart holds no time twice, whatever the runs' order.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_HEAD = pa.list_(pa.struct([("no", pa.int32()), ("line", pa.string())]))
_RUNS = pa.schema([
    ("path", pa.string()), ("source_zip", pa.string()), ("first_time", pa.int64()), ("last_time", pa.int64()), ("rises", pa.bool_()), ("without_time", pa.int64()),
    ("bad_time", pa.bool_()), ("open_quote", pa.bool_()), ("width", pa.int32()), ("chunk", pa.int64()), ("read_error", pa.string()), ("head", _HEAD),
])
RUNS = (
    "path string, source_zip string, first_time bigint, last_time bigint, rises boolean, without_time bigint,"
    " bad_time boolean, open_quote boolean, width int, chunk bigint, read_error string, head array<struct<no: int, line: string>>"
)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From ``path, source_zip, chunk, header_no, header, read_error, open_quote, width, micros, has_time`` to ``RUNS``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = np.stack([pc.dictionary_encode(batch[c]).indices.to_numpy() for c in ("path", "source_zip", "chunk")])
        edges = [0, *(np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        out = [[] for _ in _RUNS]
        for a, b in zip(edges, edges[1:]):
            part = batch.slice(a, b - a)
            is_data = np.logical_and(part["header_no"].is_null().to_numpy(zero_copy_only=False), part["read_error"].is_null().to_numpy(zero_copy_only=False))
            micros = part["micros"].filter(pa.array(is_data))
            has_time = part["has_time"].filter(pa.array(is_data))
            times = micros.drop_null().to_numpy()
            numbers = part["header_no"].drop_null()
            heads = [(n, h) for n, h in zip(part["header_no"].to_pylist(), part["header"].to_pylist()) if n is not None] if len(numbers) else []
            row = (
                part["path"][0].as_py(), part["source_zip"][0].as_py(),
                int(times.min()) if len(times) else None, int(times.max()) if len(times) else None, bool((np.diff(times) > 0).all()), micros.null_count,
                bool(pc.any(pc.and_(has_time, micros.is_null())).as_py()), bool(pc.any(part["open_quote"]).as_py()), pc.max(part["width"]).as_py(), pc.max(part["chunk"]).as_py(),
                pc.max(part["read_error"]).as_py(), [{"no": n, "line": h} for n, h in heads],
            )
            for column, value in zip(out, row, strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _RUNS, strict=True)], schema=_RUNS)
