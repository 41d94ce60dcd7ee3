"""WARC archives compressed record by record with a Zstandard dictionary of their own.

A file starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary; every record is a frame of its own, so
records can be read one by one. The dictionary is built from a bounded sample of the records to be archived.

Files are written by Spark's text sink, so its commit protocol covers lost executors and any file system works: a row is a
frame, and the line separator is an empty skippable frame (``P*M\\x18`` and four zero bytes, all ASCII), which readers skip. Each
task of the writer starts its file with the dictionary.

Equal payloads are archived once: the record with the largest page id is the response, the others are revisit records that name
it. Grouping is by length, SHA-1 and SHA-256, on digests only; a payload that a third of all pages share meets the pages
over salted keys.

Defined cases: a null payload counts as empty; empty payloads equal each other; pages without an id are archived as
responses of their own with ``page_id`` null; repeated ids are archived each (a response and its repeats with equal
payload: one of them, by the hash of its URL, is the response); an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeline.llm.common import saved, slices
from gaugeline.session import path_exists, shared_dir

DICTIONARY_MAGIC = 0x184D2A5D
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
DICTIONARY_BYTES = 64 << 10
#: Bounds of the sample for the dictionary: records, and bytes of each.
SAMPLE_ROWS = 1000
SAMPLE_BYTES = 16 << 10
LEVEL = 6
#: Bytes handed to the decompressor at once, as it copies what lies behind a frame's end.
PIECE = 8 << 10
#: Copies of a group's one row for the join with its pages.
SALTS = 32
DATE = "2000-01-01T00:00:00Z"


def _digest32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, sha1_hex: str, refers_to: int | None, date: str = DATE) -> bytes:
    """A WARC/1.1 response or revisit record. The revisit carries no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    name = "none" if page_id is None else str(page_id)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {(url or '').translate({10: '%0A', 13: '%0D'})}",
        f"WARC-Payload-Digest: sha1:{_digest32(sha1_hex)}",
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers, payload (of a response) and payload length of one record; a response's digest is computed anew."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    number = lambda x: None if x in (None, "<urn:page:none>") else int(x.removeprefix("<urn:page:").rstrip(">"))
    return {"page_id": number(headers["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": headers["WARC-Type"], "refers_to": number(headers.get("WARC-Refers-To")), "payload": payload, "url": headers["WARC-Target-URI"]}


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; empty where the samples are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def frames(data: bytes):
    """Records of a file, one by one. Skippable frames other than the leading dictionary are passed over."""
    at, context = 0, zstandard.ZstdDecompressor()
    while at < len(data):
        magic, size = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if at == 0 and magic == DICTIONARY_MAGIC and size:
                context = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
            at += 8 + size
            continue
        part, out, view = context.decompressobj(), [], memoryview(data)
        while not part.eof:
            if at >= len(data):
                raise ValueError("a record is cut off")
            piece = view[at : at + PIECE]
            out.append(part.decompress(piece))
            at += len(piece)
        at -= len(part.unused_data)
        yield b"".join(out)


def _records(pages: DataFrame) -> DataFrame:
    """Pages with digests and, for repeated payloads, the response they refer to. Payloads aren't grouped, only digests."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).select("*", F.sha1("payload").alias("sha1"), F.sha2("payload", 256).alias("sha2"))
    key = ["sha1", "sha2", "size"]
    keyed = rows.withColumn("size", F.length("payload"))
    own = F.struct("page_id", F.xxhash64("url").alias("tie"))
    groups = keyed.where(F.col("page_id").isNotNull()).groupBy(*key).agg(F.max(own).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    groups = saved(groups, "warc-groups").select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    refers = F.when(F.col("page_id").isNotNull() & (own != F.col("first")), F.col("first.page_id"))
    return salted.join(groups, [*key, "salt"], "left").select("page_id", "url", "payload", "sha1", refers.alias("refers_to"))


def write(pages: DataFrame, path: str, date: str = DATE, dictionary: bytes | None = None) -> None:
    """Archive ``pages`` (``page_id, url, html``) as files below ``path``."""
    rows = _records(pages)
    if dictionary is None:
        count = max(1, pages.count())
        chosen = pages.where(F.pmod(F.xxhash64("page_id", "url"), F.lit(1_000_003)) < F.lit(round(min(1.0, SAMPLE_ROWS / count) * 1_000_003)))
        sample = chosen.select("page_id", "url", F.substring(F.coalesce("html", F.lit("")), 1, SAMPLE_BYTES).alias("html")).limit(2 * SAMPLE_ROWS).collect()
        made = [(r, r["html"].encode()) for r in sample]
        dictionary = build_dictionary([record(r["page_id"], r["url"], p, hashlib.sha1(p).hexdigest(), None, date) for r, p in sorted(made, key=lambda x: (str(x[0]["page_id"]), x[1]))])
    lead = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary

    def run(batches):
        extra = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        context, begun = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, **extra), False
        for batch in slices(batches, 256):
            out = [] if begun else [lead]
            begun = True
            for page_id, url, payload, sha1, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out.append(context.compress(record(page_id, url, payload, sha1, refers_to, date)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    rows.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(path)


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Records of the archives below ``path``; a file is read by one task, its records one after the other."""
    fields = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint" + (", url string, payload binary" if payloads else "")
    names = [f.split()[0] for f in fields.split(", ")]
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names)

    def run(batches):
        for batch in slices(batches, 1):
            rows: list[dict] = []
            for data in frames(batch.column(0)[0].as_py()):
                rows.append(parse(data))
                if len(rows) == 256:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

    if not path_exists(spark, path):
        return spark.createDataFrame([], fields)
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").mapInArrow(run, fields)


def roundtrip(pages: DataFrame) -> DataFrame:
    """Archive into the shared folder and read back."""
    path = shared_dir(pages.sparkSession, "warc")
    write(pages, path)
    return read(pages.sparkSession, path)
