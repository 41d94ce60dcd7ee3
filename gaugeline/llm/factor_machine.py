"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)): all pairwise interactions in time linear
in the features of a text. It is trained on the driver from a sample of labelled rows bounded by ``FIT_ROWS`` (features only,
computed on the executors), and applied to whole texts without shuffle.

Metadata are numeric columns named by the caller, taken on a logarithmic scale; the registered query names ``n_chars``.

Defined cases: a null text counts as empty; a text without words has only the statistics' values at 0; null or non-finite
metadata count as 0; rows are scored one by one, so repeated rows, ties and null ids each give their own row; other columns
are ignored; an empty table gives no rows; texts of any length are read whole; with no labels or only one class every score is
that class share (0 without labels).
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from gaugeline.llm.common import labelled_sample, slices

FIT_ROWS = 12_000
#: Buckets for words, and factors of the interactions.
BUCKETS = 2048
FACTORS = 8
_SYMBOL = re.compile(r"[#*$%&|<>{}\[\]@~^_=+\\/]")
STATS = 14


def _stats(text: str, words: list[str], counts: dict[str, int]) -> list[float]:
    n, chars = max(1, len(words)), max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    upper = sum(w.isupper() for w in words)
    return [
        np.log1p(len(words)) / 8,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        min(2.0, len(_SYMBOL.findall(text)) / n),
        min(2.0, text.count("!") / n),
        min(2.0, text.count("|") / n),
        upper / n,
        sum(w[0].isupper() for w in words) / n,
        sum(map(len, words)) / n / 10,
        min(2.0, 10 * sum(map(text.count, ".,;:")) / n),
        1 - len(set(lines)) / max(1, len(lines)),
        min(2.0, 20 * len(lines) / n),
        sum(map(text.count, "0123456789")) / chars,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
    ]


def features(text: str, extra: list[float], cache: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and values: statistics, metadata, then hashed words (square root of their share)."""
    words = text.split()
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    first = STATS + len(extra)
    ids = list(range(first))
    for w in counts:
        i = cache.get(w)
        if i is None:
            if len(cache) > 500_000:
                cache.clear()
            i = cache[w] = zlib.crc32(w.encode()) % BUCKETS
        ids.append(first + i)
    share = np.sqrt(np.fromiter(counts.values(), np.float32) / max(1, len(words)))
    values = np.concatenate([np.array(_stats(text, words, counts) + extra, np.float32), share])
    # Words that meet in a bucket are one feature: their values add up here, before any product of features.
    kept, place = np.unique(np.array(ids, np.int32), return_inverse=True)
    return kept, np.bincount(place, values, len(kept)).astype(np.float32)


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margin(self, ids: np.ndarray, vals: np.ndarray) -> float:
        """The sum-of-squares identity, for distinct features."""
        v = self.factors[ids] * vals[:, None]
        return float(self.bias + self.linear[ids] @ vals + 0.5 * np.sum(v.sum(0) ** 2 - (v**2).sum(0)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, epochs: int = 12, seed: int = 3) -> Machine:
    """Adagrad on the log loss; classes are weighted towards balance, so that the rare one isn't drowned."""
    rng = np.random.default_rng(seed)
    if not len(y) or y.min() == y.max():
        return Machine(40.0 if len(y) and y[0] else -40.0, np.zeros(size, np.float32), np.zeros((size, FACTORS), np.float32))
    w, v, b = np.zeros(size), rng.normal(0, 0.02, (size, FACTORS)), 0.0
    gw, gv, gb = np.full(size, 1e-3), np.full((size, FACTORS), 1e-3), 1e-3
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(epochs):
        perm = rng.permutation(len(y))
        for at in range(0, len(perm), 128):
            part = perm[at : at + 128]
            x = np.zeros((len(part), size))
            for r, i in enumerate(part):
                np.add.at(x[r], rows[i][0], rows[i][1])
            s = x @ v
            z = b + x @ w + 0.5 * (np.sum(s**2, 1) - np.sum((x**2) @ (v**2), 1))
            g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[part]) * weight[part] / len(part)
            dw = x.T @ g + 1e-6 * w
            dv = x.T @ (g[:, None] * s) - ((x**2).T @ g)[:, None] * v + 1e-6 * v
            gw += dw**2
            gv += dv**2
            gb += g.sum() ** 2
            w -= 0.1 * dw / np.sqrt(gw)
            v -= 0.05 * dv / np.sqrt(gv)
            b -= 0.1 * g.sum() / np.sqrt(gb)
    return Machine(b, w.astype(np.float32), v.astype(np.float32))


def _extra(batch: pa.RecordBatch, row: int, metadata: list[str]) -> list[float]:
    out = []
    for name in metadata:
        x = batch.column(name)[row].as_py()
        out.append(float(np.copysign(np.log1p(abs(float(x))), float(x))) / 8 if x is not None and np.isfinite(float(x)) else 0.0)
    return out


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, metadata: list[str] | None = None, fit_rows: int = FIT_ROWS) -> Machine:
    metadata = metadata or []
    sample = labelled_sample(docs.select("doc_id", "text"), labels, "quality", allowed, fit_rows)
    if metadata:
        sample = sample.join(docs.select("doc_id", *metadata), "doc_id")

    def run(batches):
        cache: dict[str, int] = {}
        for batch in slices(batches):
            made = [features(t, _extra(batch, i, metadata), cache) for i, t in enumerate(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("label"), pa.array([i.tobytes() for i, _ in made], pa.binary()), pa.array([v.tobytes() for _, v in made], pa.binary())], ["k", "label", "ids", "vals"])

    rows = sample.mapInArrow(run, "k string, label int, ids binary, vals binary").collect()
    rows.sort(key=lambda r: (r["k"], bytes(r["ids"]), bytes(r["vals"])))
    data = [(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["vals"], np.float32)) for r in rows]
    return train(data, np.array([r["label"] for r in rows], dtype=int), STATS + len(metadata) + BUCKETS)


def score(docs: DataFrame, machine: Machine, metadata: list[str] | None = None) -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    metadata = metadata or []
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # a fixed number of weights

    def run(batches):
        own, cache = shared.value, {}
        for batch in slices(batches):
            z = [own.margin(*features(t or "", _extra(batch, i, metadata), cache)) for i, t in enumerate(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))), pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", *metadata).mapInArrow(run, f"doc_id {kind}, score double")
