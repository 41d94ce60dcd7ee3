"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posteriors.

1. Voters: fixed insults, words and word stems that the labelled rows point to, and patterns. A voter fires or doesn't.
2. Label model: P(label) x product of P(voter | parent voter, label). The parents form a maximum spanning tree of
   conditional mutual information, so two voters that say the same thing (a word and its stem) aren't counted twice.
   Accuracies, correlations and the class share are estimated by EM; a row's given label is one more voter of fixed accuracy.
3. Classifier: logistic regression over hashed words and stems, trained on the posteriors, applied to whole texts.

Fitting uses a sample of labelled rows bounded by ``fit_rows``; scoring reads each text once, without shuffle.

Defined cases: a null text counts as empty; a text without words has the score of the intercept; rows are scored one by one,
so repeated rows, ties and null ids each give their own row; extra columns are ignored; with no labels or only one class
every score is that class share (0 without labels).
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gaugeline.llm.common import labelled_sample, slices

#: Most labelled rows used for fitting.
FIT_ROWS = 8_000
#: Hashed features of the classifier.
BUCKETS = 1 << 18
STEMS = (4, 5)
#: English insults that vote whatever the labels say.
INSULTS = "idiot moron stupid loser scum trash worthless pathetic disgusting clown dumb fool jerk bastard vermin filth".split()
_WORD = re.compile(r"\w+")


def _terms(text: str) -> tuple[dict[str, int], int]:
    """Counts of words and of stems (``abcd*``) in a text, and its number of words."""
    words = _WORD.findall(text.lower())
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    for w, n in list(counts.items()):
        for k in STEMS:
            if len(w) > k:
                s = w[:k] + "*"
                counts[s] = counts.get(s, 0) + n
    return counts, len(words)


def _vector(text: str, cache: dict[str, int], voters: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms (square root of a term's count per hundred words, at most 2), then the voters' own features.

    Voter ``j`` has feature ``BUCKETS + j``, the log of one plus its count, whatever the length of the text; two more features
    hold the log of one plus all hits, and whether two different voters fire.
    """
    counts, n = _terms(text)
    if not n:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    ids, hits, own = [], [], []
    for t, c in counts.items():
        i = cache.get(t)
        if i is None:
            if len(cache) > 500_000:
                cache.clear()
            i = cache[t] = zlib.crc32(t.encode()) % BUCKETS
        ids.append(i)
        if t in voters:
            hits.append(BUCKETS + voters[t])
            own.append(c)
    values = np.minimum(np.sqrt(np.fromiter(counts.values(), np.float32) * (100.0 / n)), 2.0)
    if not hits:
        return np.array(ids, np.int32), values.astype(np.float32)
    first = BUCKETS + len(voters)
    return np.array([*ids, *hits, first, first + 1], np.int32), np.concatenate([values, np.log1p(own), [np.log1p(sum(own)), float(len(hits) > 1)]]).astype(np.float32)


@dataclass
class LabelModel:
    """Tree-augmented generative model of binary voters."""

    prior: float = 0.5
    parent: np.ndarray = field(default_factory=lambda: np.zeros(0, int))
    #: P(voter fires | label, parent's vote): [voter, label, parent].
    fires: np.ndarray = field(default_factory=lambda: np.zeros((0, 2, 2)))

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        out = np.full(len(votes), np.log(self.prior) - np.log1p(-self.prior))
        for j, up in enumerate(self.parent):
            above = votes[:, up] if up >= 0 else np.zeros(len(votes), int)
            p = self.fires[j][:, above]
            on = votes[:, j] == 1
            out += np.where(on, np.log(p[1]) - np.log(p[0]), np.log1p(-p[1]) - np.log1p(-p[0]))
        return out

    def fit(self, votes: np.ndarray, gold: np.ndarray, accuracy: float = 0.98, rounds: int = 15) -> np.ndarray:
        """Posteriors of label 1. ``gold``: labels known for the rows, a voter whose accuracy is fixed."""
        hint = np.where(gold == 1, 1.0, -1.0) * np.log(accuracy / (1 - accuracy))
        q = 1 / (1 + np.exp(-hint))
        for step in range(rounds):
            self.prior = float(np.clip(q.mean(), 1e-3, 1 - 1e-3))
            if step % 5 == 0:
                self.parent = _tree(votes, q)
            self.fires = np.empty((votes.shape[1], 2, 2))
            for j, up in enumerate(self.parent):
                above = votes[:, up] if up >= 0 else np.zeros(len(votes), int)
                for y, weight in ((0, 1 - q), (1, q)):
                    total = np.bincount(above, weight, 2)
                    base = (np.sum(weight * votes[:, j]) + 0.1) / (weight.sum() + 1)
                    self.fires[j, y] = np.clip((np.bincount(above, weight * votes[:, j], 2) + base) / (total + 1), 1e-4, 1 - 1e-4)
            new = 1 / (1 + np.exp(-np.clip(self.log_odds(votes) + hint, -40, 40)))
            moved, q = float(np.abs(new - q).max()), new
            if moved < 1e-4:
                break
        return q


def _tree(votes: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Parents by the maximum spanning tree of mutual information given the label; weak links are left out."""
    m = votes.shape[1]
    info = np.zeros((m, m))
    for weight in (q, 1 - q):
        total = weight.sum() + 1e-9
        v = votes.astype(float)
        both = (v * weight[:, None]).T @ v / total
        one = np.diag(both)
        for a in (0, 1):
            for b in (0, 1):
                pa_, pb = (one if a else 1 - one)[:, None], (one if b else 1 - one)[None, :]
                joint = both if a and b else (one[:, None] - both) if a else (one[None, :] - both) if b else 1 - one[:, None] - one[None, :] + both
                with np.errstate(divide="ignore", invalid="ignore"):
                    part = joint * np.log(joint / (pa_ * pb))
                info += total / len(votes) * np.where(joint > 1e-12, part, 0)
    np.fill_diagonal(info, -1)
    parent = np.full(m, -1)
    inside, best, at = np.zeros(m, bool), np.full(m, -1.0), np.full(m, -1)
    for _ in range(m):
        k = int(np.argmax(np.where(inside, -2, best)))
        inside[k] = True
        parent[k] = at[k] if best[k] > 1e-3 else -1
        better = ~inside & (info[k] > best)
        best[better], at[better] = info[k][better], k
    return parent


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    voters: list[str] = field(default_factory=list)
    label_model: LabelModel | None = None


def _voters(texts: list[str], y: np.ndarray, most: int = 120) -> list[str]:
    """Insults, and the terms that point most surely to label 1 (a Wald bound of the log odds over 1.5)."""
    seen: list[dict[str, int]] = [{}, {}]
    for text, label in zip(texts, y, strict=True):
        d = seen[int(label)]
        for k in _terms(text)[0]:
            d[k] = d.get(k, 0) + 1
    n0, n1 = max(1, int((y == 0).sum())), max(1, int((y == 1).sum()))
    found = []
    for k, a in seen[1].items():
        if a >= 4:
            b = seen[0].get(k, 0)
            odds = np.log((a + 0.5) / (n1 - a + 0.5)) - np.log((b + 0.5) / (n0 - b + 0.5))
            if (low := odds - 1.64 * np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))) > 1.5:
                found.append((-low, k))
    return list(dict.fromkeys([*INSULTS, *(k for _, k in sorted(found)[:most])]))


def _votes(voters: list[str], texts: list[str]) -> np.ndarray:
    """A column per term, then patterns: two terms, many terms for the length, none, shouting, second person with a term."""
    out = np.zeros((len(texts), len(voters) + 5), dtype=int)
    for i, text in enumerate(texts):
        t, n = _terms(text)
        hit = [j for j, v in enumerate(voters) if v in t]
        out[i, hit] = 1
        total = sum(t[voters[j]] for j in hit)
        out[i, len(voters) :] = (len(hit) >= 2, total * 60 >= max(n, 1), not hit, text.count("!") * 20 > max(n, 1), bool(hit) and ("you" in t or "your" in t))
    return out


def _logistic(vectors: list[tuple[np.ndarray, np.ndarray]], q: np.ndarray, size: int, epochs: int = 15, l2: float = 1e-6, seed: int = 5) -> tuple[np.ndarray, float]:
    """Adagrad on soft labels over features of three texts or more; the rarer class weighs up to four times as much."""
    lens = np.array([len(i) for i, _ in vectors])
    kept = np.flatnonzero(np.bincount(np.concatenate([i for i, _ in vectors]), minlength=size) >= 3)
    place = np.full(size, -1)
    place[kept] = np.arange(len(kept))
    f_all, x_all, r_all = place[np.concatenate([i for i, _ in vectors])], np.concatenate([v for _, v in vectors]), np.repeat(np.arange(len(vectors)), lens)
    use = f_all >= 0
    f_all, x_all, r_all = f_all[use], x_all[use], r_all[use]
    starts = np.searchsorted(r_all, np.arange(len(vectors) + 1))
    w, b = np.zeros(len(kept)), float(np.log((q.mean() + 1e-3) / (1 - q.mean() + 1e-3)))
    gw, gb = np.full(len(kept), 1e-2), 1e-2
    up = float(np.clip((1 - q.mean()) / max(q.mean(), 1e-3), 1, 4))
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        perm = order.permutation(len(q))
        for at in range(0, len(perm), 128):
            part = perm[at : at + 128]
            take = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in part])
            f, x, row = f_all[take], x_all[take], np.repeat(np.arange(len(part)), starts[part + 1] - starts[part])
            z = np.bincount(row, w[f] * x, len(part)) + b
            y = q[part]
            g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * np.where(y > 0.5, up, 1.0) / len(part)
            grad = np.bincount(f, g[row] * x, len(kept)) + l2 * w
            gw += grad**2
            w -= 0.3 * grad / np.sqrt(gw)
            gb += g.sum() ** 2
            b -= 0.1 * g.sum() / np.sqrt(gb)
    out = np.zeros(size)
    out[kept] = w
    return out, b


def fit_rows(rows: list[tuple[str, int]]) -> Model:
    """A model from texts and labels."""
    y = np.array([label for _, label in rows], dtype=int)
    if not len(rows) or y.min() == y.max():
        share = float(y.mean()) if len(rows) else 0.0
        return Model(np.zeros(BUCKETS + 2, np.float32), 40.0 if share else -40.0)
    texts = [text for text, _ in rows]
    voters = _voters(texts, y)
    label_model = LabelModel()
    q = label_model.fit(_votes(voters, texts), y)
    cache: dict[str, int] = {}
    index = {v: j for j, v in enumerate(voters)}
    w, b = _logistic([_vector(text, cache, index) for text in texts], q, BUCKETS + len(voters) + 2)
    return Model(w.astype(np.float32), b, voters, label_model)


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, most_rows: int = FIT_ROWS) -> Model:
    rows = labelled_sample(docs, labels, "toxic", allowed, most_rows).select("doc_id", "text", "label").collect()
    return fit_rows([(r["text"], r["label"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["text"]))])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    used = np.flatnonzero(np.abs(model.weights) > 1e-4).astype(np.int32)
    shared = docs.sparkSession.sparkContext.broadcast((used, model.weights[used], model.bias, model.voters, len(model.weights)))  # about BUCKETS numbers at most

    def run(batches):
        used, values, bias, voters, size = shared.value
        w = np.zeros(size, np.float32)
        w[used] = values
        index = {v: j for j, v in enumerate(voters)}
        cache: dict[str, int] = {}
        for batch in slices(batches):
            z = np.full(batch.num_rows, bias)
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids, vals = _vector(text or "", cache, index)
                z[i] += float(w[ids] @ vals)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double").select("doc_id", F.col("score"))
