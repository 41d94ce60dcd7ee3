"""Vector code compression: product codes whose assignment skips most distances by adaptive bounds.

Components become integers, vectors are cut into parts, and every part position has a codebook that a few rounds of assignment
and averaging improve. Everything that decides is integer arithmetic, so the result doesn't depend on how rows are spread.

Bounds (after Drake and Hamerly): with each part are kept its entry, its ``b`` closest other entries in order of lower bounds on
their distances, and one outer bound for all entries that aren't listed. When the codebook moves, each bound is lowered by
how far its entry moved (the outer one by the largest move), and the order is restored. A part whose exact distance to its
entry is below the first bound is done after one distance instead of one per entry. Else the entries up to the first larger
bound are compared by exact integer distances, ties to the lower index; only where not even the outer bound is larger, all
entries are. Bounds are rounded down and distances up, so a doubtful case is always verified. ``b`` follows what was needed:
a task writes as many entries as 99 of 100 parts of its last rows looked at, and the next round starts from the needs of all.

Plan: one pass over the vectors per assignment, without a shuffle. A pass writes the vectors with their state as a table and, per
task, one partial sum per entry; sums meet in an aggregate of as many rows as there are entries, which with the codebooks
(parts x entries x components) is all that the driver sees. The state of the pass before is removed when the next is written.

Defined cases: vectors that are null or hold null or non-finite components are dropped, as are those whose length isn't the usual
one among the smallest ids (the most common there, ties to the longer), and those with a component of 10^30 or more in size,
for which no sum is exact; a length that can't be cut into equal parts is a ValueError. Rows without id come last in order; equal ids are rows
of their own, in order of their vectors; fewer vectors than entries give as many entries as vectors; an empty table gives no
rows; labels without value belong together; other columns are ignored. Errors beyond a long are null, and so are sums with them.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gaugeline.llm.common import slices
from gaugeline.session import delete_path, shared_dir

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Other entries listed with a part at first: a share of all entries.
LISTED_SHARE = 8
LEAST_LISTED = 2
_EXACT = 1 << 53
_LONG = (1 << 63) - 1
#: Labels whose totals are broadcast; beyond, totals are joined over salted keys.
BROADCAST_LABELS = 100_000
SALTS = 16

Books = list[list[tuple[int, ...]]]  # part, entry: components


# --- vectors ------------------------------------------------------------------------------------------------------


def kept(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` of the vectors that take part."""
    good = F.expr("forall(embedding, x -> x IS NOT NULL AND abs(x) < 1e30D)")
    return vectors.select("vec_id", "label", "embedding").where(F.col("embedding").isNotNull() & good)


def first_vectors(rows: DataFrame, n: int, scale: int) -> list[list[int]]:
    """The ``n`` vectors of smallest id, as integers."""
    order = [F.col("vec_id").asc_nulls_last(), "embedding", "label"]
    found = [r["embedding"] for r in rows.orderBy(*order).limit(n).select("embedding").collect()]
    return [[int(v) for v in np.floor(np.array(x, np.float64) * scale)] for x in found]


def pack(x: np.ndarray) -> bytes:
    """Integer-valued float64 components: two bytes each if they fit."""
    return b"h" + x.astype("<i2").tobytes() if not len(x) or np.abs(x).max() < 1 << 15 else b"d" + x.astype("<f8").tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i2" if data[:1] == b"h" else "<f8", offset=1).astype(np.float64)


# --- bounds -------------------------------------------------------------------------------------------------------


def down(x: np.ndarray) -> np.ndarray:
    """As float16, never above ``x``."""
    out = np.minimum(np.maximum(x, 0) * (1 - 1e-9), 65504).astype(np.float16)
    return np.where(out.astype(np.float64) > x, np.nextafter(out, np.float16(-1)), out).clip(0, None).astype(np.float16)


def exact_fits(x: np.ndarray, entries: np.ndarray) -> bool:
    most = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    return 4 * max(1, x.shape[-1]) * most * most < _EXACT


def all_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to all entries, as int64; every term is below 2^53."""
    return ((x**2).sum(1)[:, None] - 2 * (x @ entries.T) + (entries**2).sum(1)[None]).astype(np.int64)


def assign_all(x: np.ndarray, entries: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Entry, its squared distance, the next ``b`` entries, and lower bounds of these with the outer one at the end."""
    d = all_distances(x, entries)
    order = np.argsort(d, axis=1, kind="stable")
    near = np.take_along_axis(d, order[:, : b + 2], 1)
    low = np.full((len(x), b + 1), np.inf)
    low[:, : near.shape[1] - 1] = np.sqrt(near[:, 1:])
    return order[:, 0], near[:, 0], order[:, 1 : b + 1], down(low)


def assign_by_bounds(x: np.ndarray, entries: np.ndarray, drift: np.ndarray, own: np.ndarray, listed: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``assign_all``, from the state before the entries moved by ``drift``; last, how many listed entries each row needed
    (more than are listed: all entries were compared)."""
    b = listed.shape[1]
    low = low.astype(np.float64)
    low[:, :b] -= drift[listed]
    low[:, b] -= drift.max()
    low = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]
    best = ((x - entries[own]) ** 2).sum(1).astype(np.int64)
    reach = np.sqrt(best) * (1 + 1e-9)
    need = (low <= reach[:, None]).sum(1)  # bounds are in order: so many come first
    own, listed = own.copy(), listed.copy()

    rows = np.flatnonzero((need > 0) & (need <= b))
    if len(rows):
        most = int(need[rows].max())
        ids = np.concatenate([own[rows, None], listed[rows, :most]], 1)
        d = ((x[rows, None, :] - entries[ids]) ** 2).sum(2).astype(np.int64)
        unasked = np.arange(most + 1)[None] > need[rows, None]
        key = np.where(unasked, np.iinfo(np.int64).max, d * len(entries) + ids)
        order = np.argsort(key, axis=1, kind="stable")  # entries that needn't be asked stay where they are
        ids, d, unasked = (np.take_along_axis(a, order, 1) for a in (ids, d, unasked))
        own[rows], best[rows], listed[rows, :most] = ids[:, 0], d[:, 0], ids[:, 1:]
        low[rows, :most] = np.where(unasked[:, 1:], low[rows, :most], np.sqrt(d[:, 1:]))
        low[rows] = np.minimum.accumulate(low[rows][:, ::-1], axis=1)[:, ::-1]
    out = down(low)
    rows = np.flatnonzero(need > b)
    if len(rows):
        own[rows], best[rows], listed[rows], out[rows] = assign_all(x[rows], entries, b)
    return own, best, listed, out, need


def assign_large(x: np.ndarray, entries: list[tuple[int, ...]]) -> tuple[np.ndarray, list[int]]:
    """Entries and squared distances for components too large for float64, in Python's integers."""
    own, best = [], []
    for row in x:
        v = [int(c) for c in row]
        d, k = min((sum((a - c) ** 2 for a, c in zip(v, e, strict=True)), k) for k, e in enumerate(entries))
        own.append(k)
        best.append(d)
    return np.array(own, np.int64), best


def needed(need: np.ndarray, b: int) -> int:
    """Entries to list from here on, given what rows needed: enough for 99 of 100 of those that a list could answer."""
    answered = need[need <= b]
    return min(b, max(LEAST_LISTED, int(np.ceil(np.quantile(answered, 0.99))))) if len(answered) else b


# --- a row's state: number of listed entries, then per part its entry, the listed entries and the bounds -------------


def dump_state(own: np.ndarray, listed: np.ndarray, low: np.ndarray) -> list[bytes]:
    """``own`` (rows, parts), ``listed`` (rows, parts, b), ``low`` (rows, parts, b + 1)."""
    n, b = len(own), listed.shape[2]
    parts = [own.astype("<u2").reshape(n, -1), listed.astype("<u2").reshape(n, -1), low.astype("<f2").view("<u2").reshape(n, -1)]
    lead = np.full((n, 1), b, "<u2")
    return [r.tobytes() for r in np.concatenate([lead, *parts], 1)]


def load_state(states: list[bytes], parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of states with the same number of listed entries."""
    raw = np.frombuffer(b"".join(states), "<u2").reshape(len(states), -1)
    b = int(raw[0, 0])
    own, listed, low = np.split(raw[:, 1:], [parts, parts * (1 + b)], axis=1)
    return own.astype(np.int64), listed.reshape(len(raw), parts, b).astype(np.int64), np.ascontiguousarray(low).view("<f2").reshape(len(raw), parts, b + 1)


# --- passes -------------------------------------------------------------------------------------------------------


class Pass:
    """One assignment of all vectors, as a function on Arrow batches."""

    def __init__(self, books: Books, before: Books | None, listed: int, scale: int, last: bool):
        self.books, self.scale, self.last, self.listed = books, scale, last, listed
        self.entries = [np.array(b, np.float64).reshape(len(b), -1) for b in books]
        self.drift = None
        if before is not None:
            old = [np.array(b, np.float64).reshape(len(b), -1) for b in before]
            self.drift = [np.sqrt(((a - c) ** 2).sum(1)) * (1 + 1e-9) for a, c in zip(self.entries, old, strict=True)]

    def rows(self, x: np.ndarray, states: list[bytes] | None):
        """For rows of one kind of state: entries, squared distances, states, and what each part needed."""
        n, p = len(x), len(self.entries)
        d = x.shape[1] // p
        b = min(self.listed, len(self.books[0]) - 1)
        if states is not None:
            old_own, old_listed, old_low = load_state(states, p)
            b = old_listed.shape[2]
        own, errors = np.empty((n, p), np.int64), [0] * n
        listed, low = np.zeros((n, p, b), np.int64), np.zeros((n, p, b + 1), np.float16)
        need = np.full((n, p), b + 1)
        for i, entries in enumerate(self.entries):
            part = np.ascontiguousarray(x[:, i * d : (i + 1) * d])
            if not exact_fits(part, entries):  # bounds of 0: verified again the next time
                own[:, i], best = assign_large(part, self.books[i])
                listed[:, i] = [[k for k in range(b + 1) if k != o][:b] for o in own[:, i]]
                errors = [e + int(v) for e, v in zip(errors, best, strict=True)]
                continue
            if states is None or self.drift is None:
                own[:, i], best, listed[:, i], low[:, i] = assign_all(part, entries, b)
            else:
                own[:, i], best, listed[:, i], low[:, i], need[:, i] = assign_by_bounds(part, entries, self.drift[i], old_own[:, i], old_listed[:, i], old_low[:, i])
            errors = [e + v for e, v in zip(errors, best.tolist(), strict=True)]
        return own, errors, listed, low, need


def run_pass(step: Pass, names: list[str], kinds: list[pa.DataType]):
    """``mapInArrow`` function: rows ``kind`` 0 with their state, then (unless it is the last pass) one row of ``kind`` 1 per entry
    with the count and the sums of its parts, and of ``kind`` 2 with what parts needed."""
    parts = len(step.entries)

    def blank(rows: int, /, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(name, pa.nulls(rows, kind)) for name, kind in zip(names, kinds, strict=True)], names)

    def run(batches):
        d = step.entries[0].shape[1]
        sums = [np.zeros((len(e), d)) for e in step.entries]
        large: Counter = Counter()
        counts, needs, listed_now = np.zeros((parts, len(step.entries[0])), np.int64), Counter(), None
        for batch in slices(batches, 4096):
            n = batch.num_rows
            if not n:
                continue
            states = batch.column("state").to_pylist() if "state" in batch.schema.names else None
            if states is None:
                packed = [pack(np.floor(np.array(v, np.float64) * step.scale)) for v in batch.column("embedding").to_pylist()]
            else:
                packed = batch.column("q").to_pylist()
            x = np.array([unpack(q) for q in packed]).reshape(n, -1)
            groups: dict[bytes, list[int]] = {}
            for i in range(n):
                groups.setdefault(states[i][:2] if states else b"", []).append(i)
            for rows in groups.values():
                mine = x[rows]
                own, errors, listed, low, need = step.rows(mine, [states[i] for i in rows] if states else None)
                b = listed.shape[2]
                if states and step.drift is not None:
                    for z, c in zip(*np.unique(np.minimum(need, b + 1), return_counts=True), strict=True):
                        needs[int(z)] += int(c)
                    listed_now = needed(need, b) if listed_now is None else max(needed(need, b), listed_now - 1)
                    if listed_now < b:  # the first bound that is cut off becomes the outer one
                        listed, low = listed[:, :, :listed_now], low[:, :, : listed_now + 1]
                if not step.last:
                    for i in range(parts):
                        part = mine[:, i * d : (i + 1) * d]
                        counts[i] += np.bincount(own[:, i], minlength=counts.shape[1])
                        if np.abs(part).max(initial=0) < 1 << 24:  # below 2^53 for 2^29 rows of a task
                            for j in range(d):
                                sums[i][:, j] += np.bincount(own[:, i], weights=part[:, j], minlength=counts.shape[1])
                        else:
                            for k, row in zip(own[:, i].tolist(), part.tolist(), strict=True):
                                for j, v in enumerate(row):
                                    large[i, k, j] += int(v)
                take = pa.array(rows, pa.int64())
                shown = {
                    "kind": pa.array([0] * len(rows), pa.int32()),
                    "vec_id": batch.column("vec_id").take(take),
                    "label": batch.column("label").take(take),
                    "error": pa.array([e if e <= _LONG else None for e in errors], pa.int64()),
                    "q": pa.array([packed[i] for i in rows], pa.binary()),
                    "state": pa.array(dump_state(own, listed, low), pa.binary()),
                    "code": pa.array(["".join(f"{k:02x}" for k in r) for r in own.tolist()] if step.last else [None] * len(rows), pa.string()),
                }
                drop = ("q", "state") if step.last else ()
                yield blank(len(rows), **{k: v for k, v in shown.items() if k not in drop})
        if step.last:
            return
        used = [(i, k) for i, k in zip(*np.nonzero(counts), strict=True)]
        yield blank(
            len(used),
            kind=pa.array([1] * len(used), pa.int32()),
            slot=pa.array([int(i) * counts.shape[1] + int(k) for i, k in used], pa.int32()),
            n=pa.array([int(counts[i, k]) for i, k in used], pa.int64()),
            sums=pa.array([[str(int(sums[i][k, j]) + large[int(i), int(k), j]) for j in range(d)] for i, k in used], pa.list_(pa.string())),
        )
        found = sorted(needs.items())
        yield blank(len(found), kind=pa.array([2] * len(found), pa.int32()), slot=pa.array([z for z, _ in found], pa.int32()), n=pa.array([c for _, c in found], pa.int64()))

    return run


def moved(books: Books, written: DataFrame, d: int) -> Books:
    """Every entry replaced by the floor of its parts' mean; entries without parts stay."""
    entries = len(books[0])
    total = [F.sum(F.col("sums")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(d)]
    rows = written.where("kind = 1").groupBy("slot").agg(F.sum("n").alias("n"), *total).collect()
    out = [list(b) for b in books]
    for r in rows:
        out[r["slot"] // entries][r["slot"] % entries] = tuple(int(r[f"s{j}"]) // r["n"] for j in range(d))
    return out


def codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of every vector (``vec_id, embedding, label``) that takes part."""
    spark = vectors.sparkSession
    rows = kept(vectors)
    first = first_vectors(rows, entries, scale)
    dim = max(Counter(map(len, first)).items(), key=lambda c: (c[1], c[0]))[0] if first else 0
    if any(len(v) != dim for v in first):
        first = first_vectors(rows.where(F.size("embedding") == dim), entries, scale)
    if dim % parts:
        raise ValueError(f"{dim} components can't be cut into {parts} equal parts")
    rows, d = rows.where(F.size("embedding") == dim), dim // parts
    books: Books = [[tuple(v[i * d : (i + 1) * d]) for v in first] for i in range(parts)]

    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    fields = f"kind int, vec_id {id_type}, label {label_type}, error bigint, q binary, state binary, code string, slot int, n bigint, sums array<string>"
    empty = spark.createDataFrame([], fields)
    names = empty.columns
    kinds = list(empty.toArrow().schema.types)
    if not first:
        return _shown(empty.where("kind = 0"), books)

    listed, before, last_path = max(LEAST_LISTED, entries // LISTED_SHARE), None, None
    for number in range(rounds + 1):
        step = Pass(books, before, listed, scale, last=number == rounds)
        path = shared_dir(spark, "codes")
        rows.mapInArrow(run_pass(step, names, kinds), fields).write.option("compression", "zstd").parquet(path)
        if last_path:
            delete_path(spark, last_path)
        written, last_path = spark.read.schema(fields).parquet(path), path
        if step.last:
            return _shown(written, books)
        needs = {r["slot"]: r["n"] for r in written.where("kind = 2").groupBy("slot").agg(F.sum("n").alias("n")).collect()}
        if needs:
            listed = needed(np.repeat(list(needs), [max(1, round(1000 * c / sum(needs.values()))) for c in needs.values()]), listed)
        before, books = books, moved(books, written, d)
        rows = written.where("kind = 0").select("vec_id", "label", "q", "state")


def _shown(written: DataFrame, books: Books) -> DataFrame:
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    coded = written.select("vec_id", "label", "code", "error")
    total = F.when(F.count("error") == F.count("*"), F.try_sum("error")).alias("label_error")
    totals = coded.groupBy(F.col("label").alias("__label")).agg(total)
    same = F.col("label").eqNullSafe(F.col("__label"))
    if totals.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        joined = coded.join(F.broadcast(totals), same)
    else:
        spread = totals.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
        joined = coded.withColumn("__own", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")).join(spread, same & (F.col("__own") == F.col("__salt")))
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
