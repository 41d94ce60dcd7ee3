"""Vector bin packing: training sequences under limits on tokens, segments and loss-bearing tokens at once.

Every document is cut into full sequences and a rest. Rests are dealt evenly into shards, and each shard is packed on its own: the open sequence takes the rest with the largest dot product of its demand and the sequence's remaining
capacity, both as shares of the limits, among those that fit; it closes when none fits. Sizes are grouped, so a choice costs
the number of distinct sizes and not of rests.

Shards hold about ``SHARD`` rests, whatever the input's size: their number follows a count. Only numbers are shuffled, never
ids or texts. A shard wastes at most its last few sequences.

Defined cases: a null or empty document is its end id alone; rows with equal ids are separate documents in the result
(pieces of each); null ids too; an empty table gives no pieces; other columns are ignored. With limits that a rest can't meet
alone (segments below 1, loss below its own) the rest is cut until each part can.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gaugeline.llm.bpe import codec, default_tokenizer
from gaugeline.llm.common import saved, slices

#: Limits of a sequence.
TOKENS = 1024
SEGMENTS = 64
#: Rests per shard.
SHARD = 2048
END_ID = 0

_PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, loss bigint"


def pieces(docs: DataFrame, tokens: int = TOKENS, loss: int | None = None, tokenizer: str | None = None, loss_share=None) -> DataFrame:
    """Pieces of every document of at most ``tokens`` ids, with the crc32 of their ids and their loss-bearing tokens.

    Without ``loss_share`` all ids of a piece but its first bear loss (the first has no context to be predicted from).
    ``loss_share`` maps (text, ids) to a boolean array, for data in which only some parts are learned.
    """
    path = tokenizer or default_tokenizer()
    most_loss = loss or tokens

    def run(batches):
        own = codec(path)
        for batch in slices(batches, 128):
            out: list[list] = [[] for _ in range(6)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text or ""
                ids = np.append(own.encode(text), np.uint32(END_ID)).astype("<u4")
                bears = np.ones(len(ids), np.int64) if loss_share is None else np.append(np.asarray(loss_share(text, ids[:-1]), np.int64), 1)
                total, at = len(ids), 0
                while at < total:
                    end = min(total, at + tokens)
                    while (own_loss := int(bears[at + 1 : end].sum())) > most_loss:
                        end = at + (end - at + 1) // 2
                    for column, value in zip(out, (doc_id, at, end - at, zlib.crc32(ids[at:end].tobytes()), total, own_loss), strict=True):
                        column.append(value)
                    at = end
            kinds = [batch.schema.field(0).type, *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "loss"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, _PIECE.replace("doc_id bigint", f"doc_id {kind}"))


def pack_shard(size: np.ndarray, loss: np.ndarray, limits: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each item by the dot-product heuristic.

    Items of one size and loss are interchangeable and form a kind; kinds are kept in arrays, so that a choice is one
    vectorised pass over the kinds left.
    """
    tokens, segments, most_loss = limits
    kinds, kind_of, count = np.unique(np.stack([size, loss], 1), axis=0, return_inverse=True, return_counts=True)
    kind_of = kind_of.reshape(-1)
    members = np.split(np.argsort(kind_of, kind="stable"), np.cumsum(count)[:-1])
    demand = np.column_stack([kinds[:, 0] / tokens, np.full(len(kinds), 1 / segments), kinds[:, 1] / most_loss])
    left = count.copy()
    sequence, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
    alive = np.arange(len(kinds))
    number = 0
    while len(alive):
        room = np.array([tokens, segments, most_loss], float)
        fit = alive
        while len(fit) and room[1] >= 1:
            fit = fit[(kinds[fit, 0] <= room[0]) & (kinds[fit, 1] <= room[2])]
            if not len(fit):
                break
            k = fit[np.argmax(demand[fit] @ (room / (tokens, segments, most_loss)))]
            left[k] -= 1
            i = members[k][left[k]]
            sequence[i], offset[i] = number, tokens - room[0]
            room -= (kinds[k, 0], 1, kinds[k, 1])
            if not left[k]:
                fit = fit[fit != k]
        alive = alive[left[alive] > 0]
        number += 1
    return sequence, offset


def pack(parts: DataFrame, tokens: int = TOKENS, segments: int = SEGMENTS, loss: int | None = None) -> DataFrame:
    """``parts`` (of ``pieces``) with ``sequence_id`` and ``offset``.

    The shard of a rest comes from its place in ``parts``, which should be a written table: so even many rows of one id and
    text spread over all shards, and a repeated task deals them as before.
    """
    limits = (tokens, segments, loss or tokens)
    rests = parts.where(F.col("length") < tokens).count()
    shards = max(1, round(rests / SHARD))
    key = F.xxhash64(F.monotonically_increasing_id())
    full = F.col("length") == tokens
    dealt = parts.select("*", F.when(full, F.lit(-1)).otherwise(F.pmod(key, F.lit(shards)).cast("int")).alias("shard"))

    def run(group: pa.Table) -> pa.Table:
        rows = group.sort_by([("length", "ascending"), ("loss", "ascending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        sequence, offset = pack_shard(rows["length"].to_numpy(), rows["loss"].to_numpy(), limits)
        ids = (np.int64(rows["shard"][0].as_py()) << 32) + sequence
        return rows.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offset))

    columns = [f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields]
    packed = dealt.where("shard >= 0").groupBy("shard").applyInArrow(run, ", ".join([*columns, "sequence_id bigint", "offset bigint"]))
    #: A full piece is a sequence of its own; numbers below zero keep clear of the shards' numbers.
    alone = dealt.where("shard < 0").select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return alone.unionByName(packed).drop("shard")


def sequences(docs: DataFrame, **limits) -> DataFrame:
    """Documents to packed pieces. The pieces' numbers are written once, because tokenizing is what costs."""
    cut = {k: v for k, v in limits.items() if k in ("tokens", "loss", "tokenizer", "loss_share")}
    return pack(saved(pieces(docs, **cut), "pieces"), **{k: v for k, v in limits.items() if k in ("tokens", "segments", "loss")})
