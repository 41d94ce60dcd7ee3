"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors are rotated and split into low-dimensional blocks. Two vectors of cosine c lie at squared distance 2 (1 - c); so in
one block at least their squared distance is within the block's share of that budget, in proportion to its dimensions. Each
block is therefore range-joined under its own budget: several grids, rotated and shifted at random, whose cells are
``SIDE`` standard deviations of such a distance wide, bring neighbours into one cell. A link that barely reaches the threshold
is missed by all grids of all blocks with a probability below ``MISS``; closer ones far more rarely.

What shares a cell is first compared by 64 sign bits (five standard deviations of slack), then exactly, in double precision.
Members of a cell are compared with its smallest member, which joins them to components; members of different components in a
cell are then compared with each other. As every link lies within a component, links are counted there exactly, in blocks of
``CHUNK`` vectors. So a cell or component may hold any number of vectors: no pairs are emitted and no group is collected.

Equal vectors are one node with a number of copies. Nodes are named by 64 bits of a hash of their values.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do rows
with a null id; vectors of different lengths don't link; rows of one id are separate vectors in the
counts of others, and each shows the largest count and smallest component of them; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from gaugeline.llm.common import saved, slices
from gaugeline.llm.components import components

COSINE = 0.9
#: Dimensions of a block at most.
BLOCK = 16
SIDE = 4.5
MISS = 0.004
CHUNK = 512


def _orthogonal(rng: np.random.Generator, n: int) -> np.ndarray:
    q, r = np.linalg.qr(rng.normal(size=(n, n)))
    return q * np.sign(np.diag(r))


def _grids(size: int, cosine: float, edges: np.ndarray, sigma: float, samples: int = 4000, turns: int = 16) -> int:
    """Grids per block at which a link of exactly the threshold is missed with probability ``MISS``.

    A pair's distance is spread unevenly over the blocks, and all grids of a block see the same share; so the probability is averaged
    over differences of random direction, not taken from the mean share.
    """
    rng = np.random.default_rng(size + 1)
    apart = rng.normal(size=(samples, size))
    apart *= math.sqrt(2 * (1 - cosine)) / np.linalg.norm(apart, axis=1, keepdims=True)
    missed = np.ones((samples, len(edges) - 1))
    for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        for _ in range(turns):
            near = 1 - np.abs(apart[:, a:b] @ _orthogonal(rng, b - a)) / (SIDE * sigma)
            missed[:, k] -= np.clip(near, 0, None).prod(1) / turns
    each = np.log(np.clip(missed, 1e-300, 1)).sum(1)
    grids = 1
    while np.exp(grids * each).mean() > MISS:
        grids += 1
    return grids


@lru_cache(maxsize=8)
def _plan(size: int, cosine: float) -> tuple:
    """Rotation, blocks with their grids (projection, shift), and sign planes, for vectors of ``size`` dimensions."""
    rng = np.random.default_rng(size)
    turn = _orthogonal(rng, size)
    n_blocks = math.ceil(size / BLOCK)
    edges = np.linspace(0, size, n_blocks + 1).astype(int)
    sigma = math.sqrt(2 * (1 - cosine) / size)  # of one coordinate, when the budget is spent evenly
    grids = _grids(size, cosine, edges, sigma)
    blocks = []
    for a, b in zip(edges, edges[1:], strict=False):
        projections = np.hstack([_orthogonal(rng, b - a) for _ in range(grids)])
        blocks.append((a, b, projections / (SIDE * sigma), rng.uniform(0, 1, projections.shape[1])))
    return turn, blocks, grids, rng.normal(size=(size, 64))


def cells(x: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the cells (vectors x all grids) and sign bits of unit vectors."""
    turn, blocks, grids, planes = _plan(x.shape[1], cosine)
    y, keys = x @ turn, []
    with np.errstate(over="ignore"):
        for k, (a, b, projection, shift) in enumerate(blocks):
            at = np.floor(y[:, a:b] @ projection + shift).astype(np.int64).astype(np.uint64).reshape(len(x), grids, b - a)
            h = np.arange(k * grids + 1, (k + 1) * grids + 1, dtype=np.uint64)[None, :] * np.uint64(0xD1342543DE82EF95) + np.uint64(x.shape[1])
            for d in range(b - a):
                h = (h ^ at[:, :, d]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            keys.append(h.view(np.int64))
        bits = ((y @ planes) > 0).astype(np.uint64) @ (np.uint64(1) << np.arange(64, dtype=np.uint64))
    return np.concatenate(keys, 1), bits.view(np.int64)


def _slack(cosine: float) -> int:
    """Sign bits that may differ between linked vectors."""
    p = math.acos(cosine) / math.pi
    return math.ceil(64 * p + 5 * math.sqrt(64 * p * (1 - p)))


def _unit(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.float64)


def neighbours(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id, embedding``)."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def named(batches):
        for batch in slices(batches):
            rows, nodes, units = [], [], []
            for i, v in enumerate(batch.column(1).to_pylist()):
                if v and all(c is not None for c in v):
                    x = np.array(v, float)
                    length = float(np.linalg.norm(x / m) * m) if (m := float(np.abs(x).max())) > 0 and np.isfinite(m) else 0.0
                    if length > 0 and np.isfinite(length):
                        rows.append(i)
                        nodes.append(xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63))
                        units.append((x / length).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(nodes, pa.int64()), pa.array(units, pa.binary())], ["vec_id", "node", "unit"])

    def slotted(batches):
        for batch in slices(batches, 256):
            nodes, units = batch.column(0).to_numpy(), [_unit(u) for u in batch.column(1).to_pylist()]
            sizes = np.array([len(u) for u in units])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                keys, bits = cells(np.stack([units[i] for i in at]), cosine)
                n = keys.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(np.repeat(nodes[at], n)), pa.array(np.repeat(bits, n))], ["key", "node", "bits"])

    def close(batches):
        for batch in slices(batches, 2048):
            keep = [i for i, (x, y) in enumerate(zip(batch.column("ua").to_pylist(), batch.column("ub").to_pylist(), strict=True)) if len(x) == len(y) and _unit(x) @ _unit(y) >= cosine]
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    def counted(group: pa.Table) -> pa.Table:
        labels, chunk, copies = (group[c].to_numpy() for c in ("label", "chunk", "copies"))
        p, q = group["p"][0].as_py(), group["q"][0].as_py()
        x, links = np.stack([_unit(u) for u in group["unit"].to_pylist()]) if len(set(map(len, group["unit"].to_pylist()))) == 1 else None, np.zeros(len(labels), np.int64)
        units = group["unit"].to_pylist()
        order = np.argsort(labels, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(labels[order])) + 1):
            own = x[at] if x is not None else np.stack([_unit(units[i]) for i in at])
            if p == q:
                near = own @ own.T >= cosine
                np.fill_diagonal(near, False)
                links[at] = near @ copies[at]
            else:
                one, two = chunk[at] == p, chunk[at] == q
                near = own[one] @ own[two].T >= cosine
                links[at[one]], links[at[two]] = near @ copies[at[two]], near.T @ copies[at[one]]
        return pa.table({"node": group["node"], "links": pa.array(links)})

    base = saved(vectors.where(F.col("vec_id").isNotNull()).select("vec_id", "embedding").mapInArrow(named, f"vec_id {kind}, node bigint, unit binary"), "embed-base")
    nodes = saved(base.groupBy("node").agg(F.count("*").alias("copies"), F.min("vec_id").alias("low"), F.first("unit").alias("unit")), "embed-nodes")
    slots = saved(nodes.select("node", "unit").mapInArrow(slotted, "key bigint, node bigint, bits bigint"), "embed-slots")
    cell = saved(slots.groupBy("key").agg(F.min(F.struct("node", "bits")).alias("center"), F.max("node").alias("high")).where("center.node < high").drop("high"), "embed-cells")
    members = saved(slots.join(cell, "key"), "embed-members")

    alike = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= _slack(cosine)
    one = nodes.select(F.col("node").alias("a"), F.col("unit").alias("ua"))
    two = nodes.select(F.col("node").alias("b"), F.col("unit").alias("ub"))
    verified = lambda pairs: saved(pairs.join(one, "a").join(two, "b").select("a", "b", "ua", "ub").mapInArrow(close, "a bigint, b bigint"), "embed-links")
    stars = members.where((F.col("node") != F.col("center.node")) & alike(F.col("bits"), F.col("center.bits")))
    links = verified(stars.select(F.col("node").alias("a"), F.col("center.node").alias("b")).distinct())
    labels = saved(components(links), "embed-labels")

    known = saved(members.join(labels, "node", "left").select("key", "node", "bits", F.col("center.node").alias("center"), F.coalesce("label", "node").alias("label")), "embed-known")
    mixed = saved(known.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n")).where("low < high and n > 2").select("key", "low"), "embed-mixed")
    left = known.join(mixed, "key")
    other = left.where("label != low").select("key", F.col("node").alias("a"), F.col("label").alias("la"), F.col("bits").alias("x"))
    across = left.select("key", F.col("node").alias("b"), F.col("label").alias("lb"), F.col("bits").alias("y"), "low", "center")
    rest = other.join(across, "key").where("la != lb and (lb = low or a < b) and a != center and b != center").where(alike(F.col("x"), F.col("y")))
    more = verified(rest.select("a", "b").distinct())
    if not more.isEmpty():
        labels = saved(components(links.union(more)), "embed-labels")

    sizes = saved(labels.groupBy("label").agg(F.count("*").alias("m")), "embed-sizes")
    sized = labels.join(sizes, "label").join(nodes, "node")
    small = F.col("m") <= CHUNK
    bins = max(1, labels.count() // CHUNK)
    parts = F.ceil(F.col("m") / CHUNK).cast("int")
    placed = sized.select("node", "label", "copies", "unit", small.alias("small"), parts.alias("parts"), F.pmod(F.xxhash64("node"), parts).cast("int").alias("chunk"))
    placed = placed.select("*", F.explode(F.when(F.col("small"), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))).alias("with"))
    tasks = placed.select(
        "node", "label", "copies", "unit", "chunk",
        F.when(F.col("small"), F.pmod(F.xxhash64("label"), F.lit(bins))).otherwise(F.col("label")).alias("task"),
        F.when(F.col("small"), F.lit(-1)).otherwise(F.least("chunk", "with")).alias("p"),
        F.when(F.col("small"), F.lit(-1)).otherwise(F.greatest("chunk", "with")).alias("q"),
    )
    sums = tasks.groupBy("task", "p", "q").applyInArrow(counted, "node bigint, links bigint").groupBy("node").agg(F.sum("links").alias("links"))
    lows = labels.join(nodes.select("node", "low"), "node").groupBy("label").agg(F.min("low").alias("component"))
    linked = sums.join(labels, "node").join(lows, "label").select("node", "links", "component")
    results = saved(nodes.select("node", "copies", "low").join(linked, "node", "left"), "embed-results")
    rows = base.select("vec_id", "node").join(results, "node")
    found = rows.groupBy("vec_id").agg(F.max(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.min(F.coalesce("component", "low")).alias("component_id"))
    found = saved(found, "embed-found").withColumnRenamed("vec_id", "__id")
    out = vectors.select("vec_id").join(found, F.col("vec_id") == F.col("__id"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
