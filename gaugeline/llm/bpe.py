"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes of a text chooses chunk borders that depend on the bytes near them only, so a passage that
many texts share yields the same chunks in each. Chunks that occur more than once are encoded once, by the row that owns
them; all others are encoded where their text is. Joins are then repaired: the ids around a border are re-encoded over a
window that grows until its outer ids agree with the ids stored for the chunks.

A border may cut a word, a run of spaces or even a special token. Windows start and end at safe points: a single space
between two characters that aren't white space. The pattern that splits texts before merging never takes such a space into the
token before it, so ids on the two sides of a safe point don't depend on each other. A chunk without a safe point is
re-encoded with its neighbours, in the extreme the whole text at once.

Plan: chunk hashes of each distinct text are counted (hashes only, no text). Texts with a shared chunk are shuffled, compressed,
by their digest, equal texts meeting in one row; all others are encoded where they are read. No group is larger than the
chunks of one text.

Defined cases: a null text counts as empty; an empty text has no ids; equal texts in several rows, null or repeated ids
give a row each; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from gaugeline.llm.common import saved, slices

#: A border wherever so many low bits of the rolling hash are 0: about 1 KiB apart.
BORDER_BITS = 10
#: Bytes that the rolling hash looks back on.
WINDOW = 32
#: Shorter chunks aren't worth sharing.
LEAST_SHARED = 64
_SPECIAL = "<|endoftext|>"
#: Characters that both encoding libraries class alike; a text with others is encoded by the slower one.
_PLAIN = re.compile("[\x00-\u052f\u1e00-\u1eff\u2000-\u206f\u20a0-\u20bf\u2190-\u23ff\u2500-\u27bf\u3000-\u30ff\u4e00-\u9fa5\uac00-\ud7a3\uff00-\uffef]*")
_SAFE = re.compile(r"\S( )(?=\S)")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Codec:
    """Ids as the tokenizers library gives them, by the faster rank encoder where the two surely agree."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        vocab = self.slow.get_vocab(with_added_tokens=True)
        table = _byte_table()
        self.bytes_of = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = token.encode() if token == _SPECIAL else bytes(table[c] for c in token)
        self.fast = None
        ranks_path = path.removesuffix(".json") + ".tiktoken"
        if os.path.exists(ranks_path):
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={_SPECIAL: vocab[_SPECIAL]})

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None and len(text) < 200_000 and _PLAIN.fullmatch(text):
            return self.fast.encode_to_numpy(text, allowed_special="all")
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _byte_table() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


@lru_cache(maxsize=1)
def _gear() -> np.ndarray:
    return np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)


def borders(data: bytes) -> list[int]:
    """Chunk borders of UTF-8 bytes, 0 and the length included; never inside a character."""
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return [0]
    h = _gear()[b]
    step = 1
    while step < WINDOW:  # h[i] becomes the sum of gear[b[i - k]] << k over the window
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    at = np.flatnonzero((h >> np.uint32(32 - BORDER_BITS)) == 0) + 1
    at = at[at < len(b)]
    at = at[(b[at] & 0xC0) != 0x80]
    return [0, *at.tolist(), len(b)]


@dataclass
class Piece:
    """A chunk's text, its first and last safe points (-1: none), and the ids between them."""

    text: str
    first: int
    last: int
    ids: np.ndarray


def _none() -> np.ndarray:
    return np.zeros(0, np.uint32)


def _safe_before(text: str, at: int, least: int) -> int:
    """The last safe point before ``at``, ``least`` at the lowest; -1: none."""
    while (at := text.rfind(" ", least, at)) > 0:
        if at + 1 < len(text) and not text[at - 1].isspace() and not text[at + 1].isspace():
            return at
    return -1


def piece(text: str, own: Codec) -> Piece:
    m = _SAFE.search(text)
    if not m:
        return Piece(text, -1, -1, _none())
    first, last = m.start(1), max(m.start(1), _safe_before(text, len(text), 0))
    return Piece(text, first, last, own.encode(text[first:last]) if last > first else _none())


def _repair(left: Piece | None, window: str, right: Piece | None, own: Codec) -> np.ndarray:
    """Ids of the text between two pieces' ids. One more segment on either side is re-encoded together with it; while that
    disagrees with the stored ids, the segments join the window."""
    while True:
        ids = own.encode(window) if window else _none()
        cut_left = _safe_before(left.text, left.last, left.first) if left and left.last > left.first else -1
        m = _SAFE.search(right.text, right.first, right.last + 2) if right and right.last > right.first else None
        cut_right = m.start(1) if m else -1
        if right and right.last > right.first and cut_right < 0:
            cut_right = right.last
        a = left.text[cut_left : left.last] if cut_left >= 0 else ""
        b = right.text[right.first : cut_right] if cut_right > 0 else ""
        if not a and not b:
            return ids
        ids_a, ids_b = (own.encode(a) if a else _none()), (own.encode(b) if b else _none())
        agree = np.array_equal(own.encode(a + window + b), np.concatenate([ids_a, ids, ids_b]))
        if agree and (not a or np.array_equal(left.ids[-len(ids_a) :], ids_a)) and (not b or np.array_equal(right.ids[: len(ids_b)], ids_b)):
            return ids
        window = a + window + b
        if a:
            left.last = cut_left
            left.ids = own.encode(left.text[left.first : cut_left]) if cut_left > left.first else _none()
        if b:
            right.first = cut_right
            right.ids = own.encode(right.text[cut_right : right.last]) if right.last > cut_right else _none()


def join(pieces: list[Piece], own: Codec) -> np.ndarray:
    """Ids of the whole text: the pieces' ids, and repaired windows over the joins. A piece without a safe point is all window."""
    out: list[Piece | np.ndarray] = []
    left, window = None, ""
    for p in [*pieces, None]:
        if p is not None and p.first < 0:
            window += p.text
            continue
        out.append(_repair(left, window + (p.text[: p.first] if p else ""), p, own))
        if p is not None:
            out.append(p)
            left, window = p, p.text[p.last :]
    return np.concatenate([x.ids if isinstance(x, Piece) else x for x in out])


@lru_cache(maxsize=1)
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def _packed(data: bytes) -> bytes:
    return _zstd()[0].compress(data)


def _unpacked(data: bytes) -> bytes:
    return _zstd()[1].decompress(data)


def _flags(digests: DataFrame) -> np.ndarray:
    """A bitmap of 2^24 bits over the first three bytes of digests: 512 rows of 4 KiB at most, whatever the input's size."""
    at = F.conv(F.hex(F.substring("digest", 1, 3)), 16, 10).cast("long") + 1
    rows = digests.select(at.alias("n")).groupBy(F.bitmap_bucket_number("n").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")).collect()
    out = np.zeros((512, 4096), np.uint8)
    for r in rows:
        out[r["b"] - 1] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out.reshape(-1)


def encode(docs: DataFrame, tokenizer: str | None = None, least: int = 2) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, n_reused`` (chunks taken from elsewhere) for every row of ``docs``.

    Texts without a shared chunk are encoded where they are read, without a shuffle. A fixed-size bitmap says which may have
    one; its errors only send a text the longer way.
    """
    path = tokenizer or default_tokenizer()
    result = ["n_tokens", "ids_sha256", "decoded_sha256", "n_reused"]
    kinds = "n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_reused bigint"

    def refs(batches):
        for batch in slices(batches):
            data = [(t or "").encode() for t in batch.column(0).to_pylist()]
            cut = [borders(d) for d in data]
            keys = [[xxhash.xxh3_128_digest(d[a:b]) if b - a >= LEAST_SHARED else b"" for a, b in zip(c, c[1:], strict=False)] for d, c in zip(data, cut, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(d).digest() for d in data], pa.binary()), pa.array(keys, pa.list_(pa.binary()))], ["digest", "keys"])

    def row(ids: list[int], own: Codec, names: list[str], reused: int) -> tuple:
        return len(ids), hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest(), hashlib.sha256(own.decode(ids).encode()).hexdigest(), reused

    def arrays(rows: list[tuple]) -> list[pa.Array]:
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        return [pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.string(), pa.string(), pa.int64()], strict=True)]

    def alone(batches):
        own, bits = codec(path), flags.value
        names = [str(i) for i in range(len(own.bytes_of))]
        for batch in slices(batches, 128):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            plain = [i for i, t in enumerate(texts) if not _flagged(bits, hashlib.sha256(t.encode()).digest())]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(plain, pa.int64())), *arrays([row(own.encode(texts[i]).tolist(), own, names, 0) for i in plain])], ["doc_id", *result])

    def packed(batches):
        bits = flags.value
        for batch in slices(batches):
            found = [(h, d) for t in batch.column(0).to_pylist() if _flagged(bits, h := hashlib.sha256(d := (t or "").encode()).digest())]
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in found], pa.binary()), pa.array([_packed(d) for _, d in found], pa.binary())], ["digest", "z"])

    def owned(batches):
        """Ids between the safe points of the chunks that a text owns."""
        own = codec(path)
        for batch in slices(batches, 64):
            keys, blobs = [], []
            for z, seqs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = _unpacked(z)
                at = borders(data)
                for s in seqs:
                    chunk = data[at[s] : at[s + 1]]
                    keys.append(xxhash.xxh3_128_digest(chunk))
                    p = piece(chunk.decode(), own)
                    blobs.append(_packed(np.array([p.first, p.last], np.int32).tobytes() + p.ids.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(blobs, pa.binary())], ["key", "blob"])

    def spliced(batches):
        own = codec(path)
        names = [str(i) for i in range(len(own.bytes_of))]
        for batch in slices(batches, 64):
            rows = []
            for z, shared in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = _unpacked(z)
                at = borders(data)
                known = {x["seq"]: x["blob"] for x in shared or []}
                pieces, run = [], 0
                for s in sorted(known):
                    if run < s:
                        pieces.append(piece(data[at[run] : at[s]].decode(), own))
                    raw = _unpacked(known[s])
                    first, last = np.frombuffer(raw[:8], np.int32).tolist()
                    pieces.append(Piece(data[at[s] : at[s + 1]].decode(), first, last, np.frombuffer(raw[8:], "<u4")))
                    run = s + 1
                if run < len(at) - 1:
                    pieces.append(piece(data[at[run] :].decode(), own))
                rows.append(row(join(pieces, own).tolist(), own, names, len(known)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays(rows)], ["digest", *result])

    text = docs.select("text")
    uses = saved(text.mapInArrow(refs, "digest binary, keys array<binary>").groupBy("digest").agg(F.count("*").alias("copies"), F.first("keys").alias("keys")), "bpe-keys")
    chunks = uses.select("digest", "copies", F.posexplode("keys").alias("seq", "key")).where(F.length("key") > 0)
    shared = saved(chunks.groupBy("key").agg(F.sum("copies").alias("n"), F.min(F.struct("digest", "seq")).alias("owner")).where(F.col("n") >= least).select("key", "owner"), "bpe-shared")
    wanted = saved(chunks.join(shared.select("key"), "key").select("digest", "seq", "key"), "bpe-wanted")
    flags = docs.sparkSession.sparkContext.broadcast(_flags(wanted.select("digest")))

    texts = text.mapInArrow(packed, "digest binary, z binary").groupBy("digest").agg(F.first("z").alias("z"))
    owners = shared.select("owner.digest", "owner.seq").groupBy("digest").agg(F.collect_list("seq").alias("seqs"))
    ids = saved(texts.join(owners, "digest").select("z", "seqs").mapInArrow(owned, "key binary, blob binary"), "bpe-ids")
    known = wanted.join(ids, "key").groupBy("digest").agg(F.collect_list(F.struct("seq", "blob")).alias("shared"))
    results = saved(texts.join(known, "digest", "left").select("digest", "z", "shared").mapInArrow(spliced, f"digest binary, {kinds}"), "bpe-results")

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("digest"))
    long_way = rows.join(results, "digest").select("doc_id", *result)
    return docs.select("doc_id", "text").mapInArrow(alone, f"doc_id {kind}, {kinds}").unionByName(long_way)


def _flagged(bits: np.ndarray, digest: bytes) -> bool:
    at = int.from_bytes(digest[:3], "big")
    return bool(bits[at >> 3] >> (at & 7) & 1)


def decode(ids: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Texts of arrays ``ids`` (null: null), special tokens included; other columns stay."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        for batch in slices(batches):
            at = batch.schema.get_field_index("ids")
            texts = pa.array([None if x is None else codec(path).decode(x) for x in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "decoded"])

    return ids.mapInArrow(run, T.StructType([*ids.schema.fields, T.StructField("decoded", T.StringType())]))
