from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from gaugeline.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<double>, label int, code string, error string, n int"  # the last three clash with result names


def brute(rows, parts=16, entries=64, rounds=2):
    """The contract in Python's integers. Rows: (id, vector, label)."""
    from math import floor, isfinite

    good = [(i, [floor(256 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and isfinite(x) for x in v)]
    order = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = len(order[0][1]) // parts
    cut = lambda v, p: tuple(v[p * d : (p + 1) * d])
    books = [[cut(v, p) for _, v, _ in order[:entries]] for p in range(parts)]
    nearest = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        found = [[nearest(cut(v, p), books[p])[1] for p in range(parts)] for _, v, _ in good]
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [cut(v, p) for (_, v, _), f in zip(good, found) if f[p] == k]
                if mine:
                    books[p][k] = tuple(sum(c) // len(mine) for c in zip(*mine))
    last = [[nearest(cut(v, p), books[p]) for p in range(parts)] for _, v, _ in good]
    errors = [sum(e for e, _ in f) for f in last]
    by_label: dict = {}
    for (_, _, lab), e in zip(good, errors):
        by_label[lab] = by_label.get(lab, 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), e, by_label[lab], digest) for (i, _, lab), f, e in zip(good, last, errors)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", "y", 1) for i, v, lab in rows], SCHEMA)


def vectors(seed, n, d=32, spread=4):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, d))
    out = [centers[rng.integers(12)] + rng.normal(size=d) / spread for _ in range(n)]
    return [[float(np.float32(x)) for x in v] for v in out]


def test_equals_brute_force(spark):
    rng = random.Random(1)
    given = vectors(2, 500)
    rows = [(i, v, rng.choice([None, 1, 2, 3])) for i, v in zip(rng.sample(range(10_000), 500), given)]
    assert got(vc.codes(frame(spark, rows).repartition(5))) == brute(rows)


def test_odd_rows_ties_and_copies(spark):
    """Small whole numbers, so that many distances are equal; zero vectors, copies, equal and missing ids, bad components."""
    rng = random.Random(3)
    rows = [(i, [rng.choice([0.0, 1 / 256, -1 / 256, 2 / 256]) for _ in range(16)], rng.choice([None, 7])) for i in range(200)]
    rows += [(900 + i, rows[5][1], 7) for i in range(150)] + [(3, rows[9][1], None), (3, [0.0] * 16, 1), (None, [0.5] * 16, 1), (None, [0.25] * 16, None)]
    bad = [(1, None, 1), (2, [None] * 16, 1), (4, [float("nan")] + [0.0] * 15, 1), (5, [float("inf")] * 16, 1), (6, [0.0, -float("inf")] + [0.0] * 14, 1)]
    other = [(10_000, [0.0] * 32, 7), (10_001, [], None)]  # not the usual length
    assert got(vc.codes(frame(spark, rows + bad + other).repartition(3))) == brute(rows)


def test_fewer_vectors_than_entries(spark):
    rows = [(i, v, 1) for i, v in enumerate(vectors(5, 5, 16))]
    assert got(vc.codes(frame(spark, rows))) == brute(rows)
    assert got(vc.codes(frame(spark, rows[:1]))) == brute(rows[:1])


def test_no_vectors(spark):
    assert got(vc.codes(frame(spark, []))) == []
    assert got(vc.codes(frame(spark, [(1, None, 1)]))) == []
    with pytest.raises(ValueError):
        vc.codes(frame(spark, [(1, [1.0] * 15, 1)]))


def test_large_components(spark):
    rows = [(i, [x * 3e5 for x in v], 1) for i, v in enumerate(vectors(6, 90, 16))]
    assert got(vc.codes(frame(spark, rows))) == brute(rows)
    huge = vc.codes(frame(spark, [(i, [1e12 * (i + 1)] * 16, 1) for i in range(70)])).collect()
    assert len(huge) == 70 and {r["label_error"] for r in huge} == {None}


def test_other_sizes_and_more_rounds(spark):
    rows = [(i, v, i % 3) for i, v in enumerate(vectors(8, 400, 24, 2))]
    assert got(vc.codes(frame(spark, rows).repartition(4), parts=4, entries=40, rounds=5)) == brute(rows, 4, 40, 5)


@pytest.mark.parametrize("seed", range(6))
def test_bounds_hold_and_spare_work(seed):
    """Round after round, assignments by bounds equal full ones, and every bound stays below the true distance."""
    rng = np.random.default_rng(seed)
    x = np.floor(256 * (rng.normal(size=(8, 4))[rng.integers(8, size=3000)] + rng.normal(size=(3000, 4)) / 6))
    entries = x[:48].copy()
    own, best, listed, low = vc.assign_all(x, entries, 8)
    spared = 0
    for _ in range(8):
        new = entries.copy()
        for k in np.unique(own):
            new[k] = x[own == k].sum(0) // (own == k).sum()
        drift = np.sqrt(((new - entries) ** 2).sum(1)) * (1 + 1e-9)
        entries = new
        own, best, listed, low, need = vc.assign_by_bounds(x, entries, drift, own, listed, low)
        d = vc.all_distances(x, entries)
        assert np.array_equal(own, d.argmin(1)) and np.array_equal(best, d.min(1))
        true = np.sqrt(d)
        assert (np.take_along_axis(true, listed, 1) >= low[:, :-1].astype(float)).all()
        outside = true.copy()
        np.put_along_axis(outside, listed, np.inf, 1)
        np.put_along_axis(outside, own[:, None], np.inf, 1)
        assert (outside.min(1) >= low[:, -1].astype(float)).all()
        assert (np.diff(low.astype(float), axis=1) >= 0).all()
        spared += int((need == 0).sum())
        cut = vc.needed(need, listed.shape[1])
        listed, low = listed[:, :cut], low[:, : cut + 1]
    assert spared > 12_000


def test_state_and_components_come_back():
    rng = np.random.default_rng(0)
    own, listed, low = rng.integers(64, size=(5, 3)), rng.integers(64, size=(5, 3, 4)), np.sort(rng.random((5, 3, 5)).astype(np.float16))
    back = vc.load_state(vc.dump_state(own, listed, low), 3)
    assert all(np.array_equal(a, b) for a, b in zip(back, (own, listed, low)))
    for x in ([], [1.0, -32767.0], [4e9, -1.0]):
        assert vc.unpack(vc.pack(np.array(x))).tolist() == x


def test_down_never_rounds_up():
    x = np.concatenate([np.random.default_rng(1).random(10_000) * 3000, [0, 1e-9, 65504, 1e6, np.inf]])
    assert (vc.down(x).astype(float) <= x).all() and (vc.down(x).astype(float) >= np.minimum(x, 65504) * 0.998 - 1e-6).all()
