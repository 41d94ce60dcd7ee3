"""Token ids in binary files: canonical length-limited Huffman codes, independent blocks, checkpoints for table-driven decoding.

One code for all files is made from the counts of all ids (package-merge, which is optimal under a limit of bits). Only its
lengths are stored; the codes follow from them, sorted by length and id.

Layout below a folder: ``codebook`` holds the lengths; ``blocks`` holds the files, in ascending order of document ids. A file is
a sequence of blocks, each followed by ``SEPARATOR``. A block has whole documents (ids, lengths), the place of its first id in the
file, a bit offset for every ``EVERY`` ids, the code bits, and a CRC. It can be read without its neighbours: a reader's split
may begin anywhere in a file, and in a block all stretches between checkpoints are decoded side by side, a step of table lookup
each. The first byte of a block is a mask by which all others are changed, chosen so that the separator never occurs inside.

Plan: texts are encoded once, to a written table; ids are counted with partial counts per task (at most the vocabulary);
documents are dealt to files by ranges of (id, hash, place), so even equal rows that make up a third of a table spread over
several files; each task writes its file with Spark's text sink, whose commit protocol covers lost executors. Reading is a
text scan cut at the separators. Only numbers per file (a bounded number of files) and the codebook reach the driver.

Defined cases: a null text counts as empty, so a document has at least its end id; rows without id come first, equal ids stand
side by side, ordered by a hash of their ids; an empty table gives a codebook without codes and no rows; a text of any length
is one document of one block; other columns are ignored.
"""

from __future__ import annotations

import math
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeline.llm.bpe import codec, default_tokenizer
from gaugeline.llm.common import saved, slices
from gaugeline.session import shared_dir

END_ID = 2
#: Longest code, unless the vocabulary in use needs more.
MAX_BITS = 18
#: Ids in a block, about, and from one checkpoint to the next.
BLOCK_IDS = 1 << 18
EVERY = 512
#: Ids in a file, about. There are never more than ``MAX_FILES`` files.
FILE_IDS = 1 << 24
MAX_FILES = 100_000
#: No beginning of it is also an ending, so it is found wherever it stands.
SEPARATOR = "=ids-block\n"
_MAGIC = b"IDB1"
#: Place of the first id, file, documents, ids, checkpoints, bytes of code bits, digest of the codebook.
_HEAD = struct.Struct("<qIIQIQI")


# --- the code -----------------------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits for symbols with these counts (above 0).

    Package-merge: on every level the packages are pairs of the level before, merged with the symbols. Going back from the
    last level, the symbols among the items taken get one more bit each.
    """
    n = len(counts)
    if n < 2:
        return np.ones(n, np.uint8)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols don't fit into {limit} bits")
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.int64)
    items, levels = weights, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = len(items) // 2 * 2
        both = np.concatenate([weights, items[0:pairs:2] + items[1:pairs:2]])
        rank = np.argsort(both, kind="stable")
        items = both[rank]
        levels.append(rank < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for symbols in reversed(levels):
        own = int(symbols[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.uint8)
    out[order] = lengths
    return out


@dataclass
class Codebook:
    """Bits of every id (0: not in use); codes and tables follow from them."""

    bits: np.ndarray

    def __post_init__(self):
        used = np.flatnonzero(self.bits)
        self.order = used[np.lexsort((used, self.bits[used]))]
        own = self.bits[self.order].astype(np.int64)
        self.longest = int(own.max()) if len(own) else 0
        # In units of the longest code, a code begins where those before it end.
        ends = np.cumsum(1 << (self.longest - own))
        self.codes = np.zeros(len(self.bits), np.uint32)
        self.codes[self.order] = (ends - (1 << (self.longest - own))) >> (self.longest - own)
        self.digest = zlib.crc32(self.bits.tobytes())

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Id and bits for every value of the next ``longest`` bits."""
        if not len(self.order):
            return np.zeros(1, np.uint32), np.zeros(1, np.int64)
        own = self.bits[self.order].astype(np.int64)
        spans = 1 << (self.longest - own)
        spans[-1] += (1 << self.longest) - spans.sum()  # a single code leaves half of the values unused
        return np.repeat(self.order.astype(np.uint32), spans), np.repeat(own, spans)

    def dump(self) -> bytes:
        return zlib.compress(self.bits.tobytes(), 9)

    @staticmethod
    def load(data: bytes) -> Codebook:
        return Codebook(np.frombuffer(zlib.decompress(data), np.uint8))


def make_codebook(counts: dict[int, int], limit: int = MAX_BITS) -> Codebook:
    ids = np.array(sorted(counts), np.int64)
    bits = np.zeros(int(ids[-1]) + 1 if len(ids) else 0, np.uint8)
    if len(ids):
        bits[ids] = code_lengths(np.array([counts[int(i)] for i in ids], np.int64), max(limit, math.ceil(math.log2(len(ids) + 1))))
    return Codebook(bits)


def put_bits(ids: np.ndarray, book: Codebook, every: int = EVERY) -> tuple[bytes, np.ndarray]:
    """Code bits of ids, and the bit offset of each ``every``-th one."""
    if not len(ids):
        return b"", np.zeros(0, "<u8")
    length = book.bits[ids].astype(np.int64)
    ends = np.cumsum(length)
    starts = ends - length
    window = book.codes[ids].astype(np.int64) << (32 - (starts & 7) - length)  # up to 25 + 7 bits from the byte where it starts
    out = np.zeros((int(ends[-1]) + 7 >> 3) + 4)
    for j in range(4):  # codes share bytes but no bits, so sums are unions
        out += np.bincount((starts >> 3) + j, weights=(window >> (24 - 8 * j)) & 255, minlength=len(out))
    return out[:-4].astype(np.uint8).tobytes(), starts[::every].astype("<u8")


def get_bits(data: bytes, n: int, checkpoints: np.ndarray, table: tuple[np.ndarray, np.ndarray], longest: int, every: int = EVERY) -> np.ndarray:
    """``n`` ids. All stretches take their next id in the same step: one look into the table for each."""
    if not n:
        return np.zeros(0, np.uint32)
    symbol, bits = table
    # The last stretch may be shorter; what it reads beyond its end, up to every * longest bits, is cut off.
    raw = np.frombuffer(data + bytes(every * longest // 8 + 8), np.uint8).astype(np.uint32)
    words = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    at, mask = checkpoints.astype(np.int64), (1 << longest) - 1
    steps = min(every, n)
    out = np.empty((steps, len(at)), np.uint32)
    for step in range(steps):
        value = (words[at >> 3] >> (32 - longest - (at & 7)).astype(np.uint32)) & mask
        out[step] = symbol[value]
        at += bits[value]
    return out.T.reshape(-1)[:n]


# --- blocks -------------------------------------------------------------------------------------------------------


def put_block(doc_ids: list[int | None], ids: list[np.ndarray], start: int, file: int, book: Codebook) -> bytes:
    every = np.concatenate(ids)
    code, checkpoints = put_bits(every, book)
    body = b"".join([
        _MAGIC,
        _HEAD.pack(start, file, len(ids), len(every), len(checkpoints), len(code), book.digest),
        np.array([i is None for i in doc_ids], np.uint8).tobytes(),
        np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
        np.array([len(x) for x in ids], "<u8").tobytes(),
        checkpoints.tobytes(),
        code,
    ])
    body += struct.pack("<I", zlib.crc32(body))
    return masked(body)


def masked(body: bytes) -> bytes:
    """A mask, and the bytes changed by it, among which the separator doesn't occur."""
    end = SEPARATOR.encode()
    for mask in range(256):
        out = bytes([mask]) + (body if not mask else (np.frombuffer(body, np.uint8) ^ mask).tobytes())
        if end not in out + end[:-1]:
            return out
    raise ValueError("the separator stands in the block under every mask")


def unmasked(data: bytes) -> bytes:
    return data[1:] if not data[0] else (np.frombuffer(data, np.uint8)[1:] ^ data[0]).tobytes()


def get_block(data: bytes, book: Codebook, table: tuple[np.ndarray, np.ndarray]) -> tuple[int, int, list[int | None], np.ndarray, np.ndarray]:
    """Place of the first id, file, document ids, their numbers of ids, and all ids of a block."""
    body = unmasked(data)
    if body[:4] != _MAGIC or struct.unpack("<I", body[-4:])[0] != zlib.crc32(body[:-4]):
        raise ValueError("a block of ids is damaged")
    start, file, docs, n, n_checkpoints, n_code, digest = _HEAD.unpack_from(body, 4)
    if digest != book.digest:
        raise ValueError("a block of ids was written with another codebook")
    at = 4 + _HEAD.size
    none = np.frombuffer(body, np.uint8, docs, at)
    doc_ids = np.frombuffer(body, "<i8", docs, at := at + docs).tolist()
    lengths = np.frombuffer(body, "<u8", docs, at := at + 8 * docs).astype(np.int64)
    checkpoints = np.frombuffer(body, "<u8", n_checkpoints, at := at + 8 * docs)
    at += 8 * n_checkpoints
    ids = get_bits(body[at : at + n_code], n, checkpoints, table, book.longest)
    return start, file, [None if m else i for i, m in zip(doc_ids, none.tolist(), strict=True)], lengths, ids


# --- jobs ---------------------------------------------------------------------------------------------------------


def token_rows(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, ids`` of every document with its end id, as a written table; ids take two bytes each if the vocabulary allows."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        own = codec(path)
        width = "<u2" if len(own.bytes_of) <= 1 << 16 else "<u4"
        for batch in slices(batches, 128):
            ids = [np.append(own.encode(t or ""), END_ID).astype(width).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array([int(width[2])] * len(ids), pa.int32())], ["doc_id", "ids", "width"])

    return saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, ids binary, width int"), "token-ids")


def _ids(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{width}")


def count_ids(rows: DataFrame) -> dict[int, int]:
    """How often each id occurs; as many numbers as the vocabulary has ids."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in slices(batches):
            for data, width in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n = np.bincount(_ids(data, width))
                if len(n) > len(total):
                    total = np.pad(total, (0, len(n) - len(total)))
                total[: len(n)] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    found = rows.select("ids", "width").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    return {r["id"]: r["n"] for r in found.collect()}


def write(rows: DataFrame, path: str, limit: int = MAX_BITS, block_ids: int = BLOCK_IDS, file_ids: int = FILE_IDS) -> None:
    """Files of ``rows`` (a table of ``token_rows``) below ``path``."""
    spark = rows.sparkSession
    counts = count_ids(rows)
    made = make_codebook(counts, limit)
    spark.createDataFrame([(masked(made.dump()),)], "value binary").select(F.col("value").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(f"{path}/codebook")
    book = spark.sparkContext.broadcast(made)
    files = min(MAX_FILES, max(spark.sparkContext.defaultParallelism, math.ceil(sum(counts.values()) / file_ids)))
    key = ["doc_id", "tie", "at"]
    ranged = rows.select("*", F.xxhash64("ids").alias("tie"), F.monotonically_increasing_id().alias("at")).repartitionByRange(files, *key).sortWithinPartitions(*key)
    ranged = ranged.select("doc_id", "ids", "width", F.spark_partition_id().alias("file"))

    def run(batches):
        doc_ids, ids, held, start, file = [], [], 0, 0, 0

        def block():
            nonlocal doc_ids, ids, held, start
            out = put_block(doc_ids, ids, start, file, book.value)
            doc_ids, ids, held, start = [], [], 0, start + held
            return pa.RecordBatch.from_arrays([pa.array([out], pa.binary())], ["value"])

        for batch in slices(batches):
            for doc_id, data, width, file in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc_ids.append(doc_id)
                ids.append(_ids(data, width))
                held += len(ids[-1])
                if held >= block_ids:
                    yield block()
        if ids:
            yield block()

    ranged.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(f"{path}/blocks")


def _scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", SEPARATOR).text(path).select(F.col("value").cast("binary").alias("value"))


def read(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``, if asked for) of every document in the files below ``path``.

    A block knows its place in its file; where a file begins among all ids follows from the files' lengths.
    """
    book = spark.sparkContext.broadcast(Codebook.load(unmasked(bytes(_scan(spark, f"{path}/codebook").first()["value"]))))
    fields = "file bigint, at bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if ids else "")

    def run(batches):
        table = book.value.table()
        for batch in slices(batches, 1):
            start, file, doc_ids, lengths, values = get_block(batch.column(0)[0].as_py(), book.value, table)
            cuts = np.concatenate([[0], np.cumsum(lengths)])
            values = values.astype("<u4")
            crc = [zlib.crc32(values[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            columns = [pa.array([file] * len(crc), pa.int64()), pa.array(start + cuts[:-1], pa.int64()), pa.array(doc_ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())]
            if ids:
                columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in fields.split(", ")])

    rows = saved(_scan(spark, f"{path}/blocks").mapInArrow(run, fields), "token-rows")
    ends = sorted((r["file"], r["end"]) for r in rows.groupBy("file").agg(F.max(F.col("at") + F.col("n_tokens")).alias("end")).collect())
    first, offsets = 0, []
    for file, end in ends:
        offsets.append((file, first))
        first += end
    known = F.broadcast(spark.createDataFrame(offsets, "file bigint, first bigint"))  # one row per file, MAX_FILES at most
    columns = [F.col("doc_id"), (F.col("first") + F.col("at")).alias("start"), F.col("n_tokens"), F.col("ids_crc32"), *([F.col("ids")] if ids else [])]
    return rows.join(known, "file").select(*columns)


def roundtrip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the ids of ``docs`` into the shared folder and read them back."""
    path = shared_dir(docs.sparkSession, "ids")
    write(token_rows(docs, tokenizer), path)
    return read(docs.sparkSession, path)
