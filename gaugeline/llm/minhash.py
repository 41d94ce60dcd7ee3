"""Near-duplicate documents by DartMinHash: fast weighted signatures, a banded join, exact verification.

Darts fall on (element, weight, rank) as a Poisson process that only hashes determine, so all sets see the same darts. A set
owns the darts whose weight is at most its element's weight. Of these each of ``HASHES`` coordinates keeps the one of smallest
rank; two sets keep the same dart with a probability equal to their weighted Jaccard similarity. Cells of the process are
dyadic in weight and rank, and ranks are looked at only up to where about ``k ln k + 2k`` darts are expected, so a signature
costs little more than reading the set.

Elements are runs of five words. By default every element weighs 1, and similarity is that of sets; ``weights="counts"``
weighs by the number of occurrences.

Plan: equal sets are one class from the start. In each bucket of equal bands the member whose own buckets are the fullest, most
likely what the others were copied from, is the center (a partial maximum); members are compared with it, exactly, and joined
to components. In buckets that still hold several components, sets of different components are compared with each other: as
pairs where a bucket is small, else in blocks of ``CHUNK`` sets that return one link per two components at most. So no link
between different components is lost, while copies are never expanded into pairs and no group is collected.

Defined cases: a null or word-less text is in no class but its own; a text of fewer than five words is one element; rows with a
null id are classes of their own and kept; rows of one id and text count as one; ties go to the smallest id; an empty table
gives an empty result; other columns are ignored by ``classes`` and kept by ``keep_first``.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from gaugeline.llm.common import saved, slices, split_by_key
from gaugeline.llm.components import components

WORDS = 5
SIMILARITY = 0.8
#: Coordinates, and coordinates per band: 25 bands of 5 find a pair of similarity 0.8 with probability 0.99995.
HASHES = 125
ROWS = 5
#: Members of a bucket that are compared as pairs at most, and sets in a block beyond that.
SMALL = 16
CHUNK = 128
#: Elements that are compared at once, so that long texts take no more memory.
BLOCK_ELEMENTS = 1 << 17
#: Distinct words whose hashes a task remembers.
REMEMBERED = 300_000
#: Ranks below 2^FINEST are one level.
FINEST = -4
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> _U(11)).astype(np.float64) * 2.0**-53


@lru_cache(maxsize=128)
def _poisson(mean: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, ... darts in a cell."""
    p, out, k = math.exp(-mean), [], 0
    total = p
    while total < 1 - 1e-15 and k < mean + 60 + 12 * math.sqrt(mean):
        out.append(total)
        k += 1
        p *= mean / k
        total += p
    return np.array(out)


def shingles(text: str, cache: dict[str, int]) -> np.ndarray:
    """Hashes of the runs of ``WORDS`` words, in order; of all words, where there are fewer."""
    words = text.split()
    if not words:
        return np.zeros(0, _U)
    if len(cache) > REMEMBERED:
        cache.clear()
    h = []
    for w in words:
        x = cache.get(w)
        if x is None:
            x = cache[w] = xxhash.xxh3_64_intdigest(w.encode())
        h.append(x)
    a = np.array(h, _U)
    n = min(WORDS, len(a))
    out = np.zeros(len(a) - n + 1, _U)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * _U(0x9E3779B97F4A7C15) + a[k : len(a) - n + 1 + k]
        return _mix(out + _U(n))


def signature(elements: np.ndarray, weights: np.ndarray, k: int = HASHES) -> np.ndarray:
    """The darts kept by each coordinate, as hashes; of distinct elements with weights above 0."""
    until = max(FINEST, math.ceil(math.log2((k * math.log(k) + 2 * k) / float(weights.sum()))))
    top = max(0, math.ceil(math.log2(float(weights.max()))))
    best_rank, best, begin = np.full(k, np.inf), np.zeros(k, _U), FINEST
    with np.errstate(over="ignore"):
        while True:
            parts: list[tuple[np.ndarray, ...]] = []
            for weight_level in range(top + 1):
                low_w, high_w = (0.0, 1.0) if weight_level == 0 else (2.0 ** (weight_level - 1), 2.0**weight_level)
                inside = slice(None) if weight_level == 0 else weights > low_w
                own, limit = elements[inside], weights[inside]
                for level in range(begin, until + 1):
                    low, high = (0.0, 2.0**FINEST) if level == FINEST else (2.0 ** (level - 1), 2.0**level)
                    cell = _mix(own + _U((weight_level * 4096 + level + 2048) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
                    table = _poisson((high - low) * (high_w - low_w))
                    u = _unit(cell)
                    hit = np.flatnonzero(u >= table[0])
                    times = np.searchsorted(table, u[hit], side="right")
                    parts.append((np.repeat(cell[hit], times), np.repeat(limit[hit], times), _nth(times), np.full(times.sum(), low), np.full(times.sum(), high - low), np.full(times.sum(), low_w), np.full(times.sum(), high_w - low_w)))
            cell, limit, nth, low, wide, low_w, wide_w = (np.concatenate(x) for x in zip(*parts, strict=True))
            dart = _mix(cell + (nth + 1).astype(_U) * _U(0x9E3779B97F4A7C15))
            if weights.min() < 2.0**top or top == 0 and weights.min() < 1:
                owned = low_w + wide_w * _unit(_mix(dart ^ _U(0xA5A5A5A5A5A5A5A5))) <= limit
                dart, low, wide = dart[owned], low[owned], wide[owned]
            rank = low + wide * _unit(_mix(dart ^ _U(0x5851F42D4C957F2D)))
            where = (dart % _U(k)).astype(np.int64)
            order = np.lexsort((rank, where))
            ranked = where[order]
            first = order[np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))] if len(order) else order
            better = first[rank[first] < best_rank[where[first]]]
            best_rank[where[better]], best[where[better]] = rank[better], dart[better]
            if np.isfinite(best_rank).all():
                return best
            begin, until = until + 1, until + 1


def _nth(times: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of a given length."""
    return np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)


def bands(darts: np.ndarray, rows: int = ROWS) -> list[int]:
    """A key per band of coordinates; the band's number is part of it."""
    with np.errstate(over="ignore"):
        grid = darts[: len(darts) // rows * rows].reshape(-1, rows)
        h = np.arange(1, len(grid) + 1, dtype=_U)
        for c in range(rows):
            h = _mix(h * _U(0x9E3779B97F4A7C15) + grid[:, c])
        return h.view(np.int64).tolist()


def _set(text: str, cache: dict[str, int], counts: bool) -> tuple[np.ndarray, np.ndarray]:
    elements, n = np.unique(shingles(text, cache), return_counts=True)
    return elements, n.astype(float) if counts else np.ones(len(elements))


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sorted sets."""
    if a[1].sum() < SIMILARITY * b[1].sum() or b[1].sum() < SIMILARITY * a[1].sum():
        return 0.0  # can't reach the threshold
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both))


def _weights(elements: np.ndarray, blob: bytes) -> np.ndarray:
    """Stored weights; none are stored where every element weighs 1."""
    return np.frombuffer(blob, np.float64) if blob else np.ones(len(elements))


def _stored(blob: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    elements = np.frombuffer(blob, _U)
    return elements, _weights(elements, weights)


def _pieces(index: np.ndarray, sets: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Indexes in runs of sets that hold ``BLOCK_ELEMENTS`` elements together (or one set)."""
    if not len(index):
        return []
    run = np.cumsum([len(sets[i][0]) for i in index]) // BLOCK_ELEMENTS
    return np.split(index, np.flatnonzero(np.diff(run)) + 1)


def _similar(own: list[tuple[np.ndarray, np.ndarray]], n: int, least: float) -> np.ndarray:
    """Which of the first ``n`` sets are similar to which of the others."""
    values, back, often = np.unique(np.concatenate([e for e, _ in own]), return_inverse=True, return_counts=True)
    weight = np.concatenate([w for _, w in own])
    row = np.repeat(np.arange(len(own)), [len(e) for e, _ in own])
    place = np.cumsum(often > 1) - 1  # elements of one set alone meet nothing
    shared = often[back] > 1
    row, column, weight = row[shared], place[back[shared]], weight[shared]
    total = np.array([w.sum() for _, w in own])
    both = np.zeros((n, len(own) - n))
    below = 0.0
    for level in np.unique(weight):  # min(v, w) is the sum of the steps that both reach
        reach = weight >= level
        for at in range(0, int(place[-1]) + 1, 4096):
            use = reach & (column >= at) & (column < at + 4096)
            m = np.zeros((len(own), 4096), np.float32)
            m[row[use], column[use] - at] = 1
            both += (level - below) * (m[:n] @ m[n:].T)
        below = level
    return both / (total[:n, None] + total[None, n:] - both) >= least


def block_links(sets: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, one: np.ndarray, two: np.ndarray, least: float) -> list[tuple[int, int]]:
    """One pair of similar sets for any two labels, among sets ``one`` and sets ``two`` (indexes)."""
    found: dict[tuple, tuple[int, int]] = {}
    for a in _pieces(one, sets):
        for b in _pieces(two, sets):
            differ = labels[a][:, None] != labels[b][None, :]
            if differ.any():
                for i, j in np.argwhere(_similar([sets[k] for k in (*a, *b)], len(a), least) & differ):
                    found.setdefault((labels[a[i]], labels[b[j]]), (int(a[i]), int(b[j])))
    return list(found.values())


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of ``pairs`` (``a, b``: classes) whose sets are similar enough."""

    def run(batches):
        for batch in slices(batches, 256):
            keep = []
            for i, (x, wx, y, wy) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3, 4, 5)), strict=True)):
                if jaccard(_stored(x, wx), _stored(y, wy)) >= least:
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    one = sets.select(F.col("digest").alias("a"), F.col("elements").alias("ea"), F.col("weights").alias("wa"))
    two = sets.select(F.col("digest").alias("b"), F.col("elements").alias("eb"), F.col("weights").alias("wb"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "ea", "wa", "eb", "wb")
    return saved(both.mapInArrow(run, "a binary, b binary"), "minhash-links")


def classes(docs: DataFrame, least: float = SIMILARITY, weights: str = "set") -> DataFrame:
    """``doc_id, class_id, kept``: the smallest id of the near-duplicates a document is connected with, and if it is that one."""
    counts = weights == "counts"
    kind = docs.schema["doc_id"].dataType.simpleString()

    def signed(batches):
        cache: dict[str, int] = {}
        for batch in slices(batches):
            rows, digests, keys = [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                elements, w = _set(text, cache, counts)
                if len(elements):
                    rows.append(i)
                    digests.append(xxhash.xxh3_128_digest(elements.tobytes() + (w.tobytes() if counts else b"")))
                    keys.append(bands(signature(elements, w)))
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "mark", "digest", "bands"])

    def elements(batches):
        cache: dict[str, int] = {}
        for batch in slices(batches, 128):
            made = [_set(t, cache, counts) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([e.tobytes() for e, _ in made], pa.binary()), pa.array([w.tobytes() if counts else b"" for _, w in made], pa.binary())], ["digest", "elements", "weights"])

    def blocks(group: pa.Table) -> pa.Table:
        digests, labels, chunk = group["digest"].to_pylist(), np.array(group["label"].to_pylist(), object), group["chunk"].to_numpy()
        p, q = group["p"][0].as_py(), group["q"][0].as_py()
        found = block_links([_stored(e, w) for e, w in zip(group["elements"].to_pylist(), group["weights"].to_pylist(), strict=True)], labels, np.flatnonzero(chunk == p), np.flatnonzero(chunk == q), least)
        return pa.table({"a": pa.array([digests[i] for i, _ in found], pa.binary()), "b": pa.array([digests[j] for _, j in found], pa.binary())})

    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("mark"), "text")
    base = saved(texts.mapInArrow(signed, f"doc_id {kind}, mark bigint, digest binary, bands array<bigint>"), "minhash-bands")
    sets = saved(base.groupBy("digest").agg(F.min(F.struct("doc_id", "mark")).alias("rep"), F.first("bands").alias("bands")), "minhash-sets")
    slots = sets.select("digest", F.explode("bands").alias("key"))
    often = saved(slots.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "minhash-often")
    held = saved(slots.join(often, "key"), "minhash-held")
    fullest = saved(held.groupBy("digest").agg(F.sum("n").alias("score")), "minhash-scores")
    scored = held.join(fullest, "digest")
    centers = saved(scored.groupBy("key").agg(F.max(F.struct("score", "digest")).alias("top")).select("key", F.col("top.digest").alias("center")), "minhash-centers")
    members = saved(held.join(centers, "key"), "minhash-members")

    wanted = members.select("digest").distinct().join(sets.select("digest", "rep"), "digest").select("digest", "rep.doc_id", "rep.mark")
    wanted = saved(wanted, "minhash-wanted")
    possible, _ = split_by_key(texts, ["doc_id", "mark"], wanted)
    own = possible.join(wanted, ["doc_id", "mark"]).select("digest", "text").mapInArrow(elements, "digest binary, elements binary, weights binary")
    own = saved(own.dropDuplicates(["digest"]), "minhash-elements")
    pairs = members.where("digest != center").select(F.col("digest").alias("a"), F.col("center").alias("b")).distinct()
    links = _verified(pairs, own, least)
    labels = saved(components(links), "minhash-labels")

    named = members.join(labels.withColumnRenamed("node", "digest"), "digest", "left").select("key", "n", "digest", "center", F.coalesce("label", "digest").alias("label"))
    named = saved(named, "minhash-named")
    mixed = saved(named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").drop("high"), "minhash-mixed")
    left = saved(named.join(mixed, "key"), "minhash-left")
    small = left.where(F.col("n") <= SMALL)
    other = small.where("label != low").select("key", F.col("digest").alias("a"), F.col("label").alias("la"))
    across = small.select("key", F.col("digest").alias("b"), F.col("label").alias("lb"), "low", "center")
    rest = other.join(across, "key").where("la != lb and (lb = low or a < b) and a != center and b != center").select("a", "b").distinct()
    more = _verified(rest, own, least)

    parts = F.ceil(F.col("n") / CHUNK).cast("int")
    large = left.where(F.col("n") > SMALL).select("key", "digest", "label", parts.alias("parts"), F.pmod(F.xxhash64("digest"), parts).cast("int").alias("chunk"))
    dealt = large.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with")).join(own, "digest")
    tasks = dealt.select("key", F.least("chunk", "with").alias("p"), F.greatest("chunk", "with").alias("q"), "digest", "label", "chunk", "elements", "weights")
    across_blocks = saved(tasks.groupBy("key", "p", "q").applyInArrow(blocks, "a binary, b binary"), "minhash-block-links")
    more = more.union(across_blocks)
    if not more.isEmpty():
        labels = saved(components(links.union(more)), "minhash-labels")

    ids = base.select("doc_id", "mark", "digest").distinct().join(labels.withColumnRenamed("node", "digest"), "digest", "left")
    ids = saved(ids.select("doc_id", "mark", F.coalesce("label", "digest").alias("label")), "minhash-ids")
    tops = saved(ids.groupBy("label").agg(F.min(F.struct("doc_id", "mark")).alias("top")), "minhash-tops")
    found = saved(ids.join(tops, "label").select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), "top"), "minhash-found")
    whole = docs.select("doc_id", F.xxhash64("text").alias("mark"))
    joined = whole.join(found, (F.col("doc_id") == F.col("__id")) & (F.col("mark") == F.col("__mark")), "left")
    first = F.coalesce(F.struct("doc_id", "mark") == F.col("top"), F.lit(True))
    return joined.select("doc_id", F.coalesce("top.doc_id", "doc_id").alias("class_id"), first.alias("kept"), "mark")


def keep_first(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class, the one of smallest id."""
    gone = saved(classes(docs, least).where("not kept").select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).distinct(), "minhash-gone")
    return docs.join(gone, (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__mark")), "left_anti")
