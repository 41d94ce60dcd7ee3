from __future__ import annotations

import random

import numpy as np

from gaugeline.llm import embed, lines, minhash
from gaugeline.llm.components import components


def words(rng, n):
    return ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(3, 9))) for _ in range(n)]


def edited(rng, base, n):
    out = list(base)
    for _ in range(n):
        out[rng.randrange(len(out))] = words(rng, 1)[0]
    return out


def shingles(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_classes(texts):
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(texts))]


def test_near_duplicates_equal_brute_force(documents):
    rng = random.Random(3)
    texts = [None, "", "  ", "one two", "one two", "one two three", "x " * 4000]
    for _ in range(12):
        base = words(rng, rng.randrange(60, 200))
        texts += [" ".join(base)] + [" ".join(edited(rng, base, rng.randrange(0, 9))) for _ in range(rng.randrange(1, 6))]
    hot = words(rng, 150)
    texts += [" ".join(edited(rng, hot, rng.randrange(0, 10))) for _ in range(70)]
    rng.shuffle(texts)
    rows = {r["doc_id"]: r for r in minhash.classes(documents(texts)).collect()}
    want = brute_classes(texts)
    assert [rows[i]["class_id"] for i in range(len(texts))] == want
    assert [rows[i]["kept"] for i in range(len(texts))] == [c == i for i, c in enumerate(want)]


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    for top in (1, 9):
        got, want = [], []
        for _ in range(40):
            e = np.unique(rng.integers(0, 1 << 63, 200).astype(np.uint64))
            a, b = rng.integers(1, top + 1, len(e)).astype(float), rng.integers(1, top + 1, len(e)).astype(float)
            keep = rng.random(len(e)) < 0.85
            x, y = minhash.signature(e, a), minhash.signature(e[keep], b[keep])
            got.append((x == y).mean())
            b = np.where(keep, b, 0)
            want.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        assert abs(np.mean(got) - np.mean(want)) < 0.02
    assert minhash.jaccard((np.array([1, 2], np.uint64), np.array([2.0, 3.0])), (np.array([1, 2], np.uint64), np.array([2.0, 2.5]))) == 0.9


def test_blocks_find_a_link_for_each_two_labels():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 60, 100).astype(np.uint64))
    sets = [(np.sort(np.append(base[k:], rng.integers(0, 1 << 60, k).astype(np.uint64))), np.ones(len(base))) for k in (0, 3, 40, 4)]
    assert minhash.block_links(sets, np.array([0, 1, 2, 1]), np.arange(4), np.arange(4), 0.8)
    links = {tuple(sorted(x)) for x in minhash.block_links(sets, np.array([0, 1, 2, 1]), np.arange(4), np.arange(4), 0.8)}
    assert links and all(2 not in x for x in links)


def test_near_duplicates_of_odd_rows(documents):
    docs = documents(["a b c d e f"] * 4, [7, 7, None, 3])
    rows = minhash.classes(docs).collect()
    assert len(rows) == 4 and sorted((r["class_id"] or 0, r["kept"]) for r in rows) == [(0, True), (3, False), (3, False), (3, True)]
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 3]
    assert minhash.classes(documents([])).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(500, 500), (7, 7)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    x = list(rng.normal(size=(120, 64)))
    for k in range(6):
        x += [x[k] + rng.normal(size=64) * s for s in (0.05, 0.2, 0.35, 0.45, 0.47, 0.0)]
    hot = rng.normal(size=64)
    x += [hot + rng.normal(size=64) * 0.15 for _ in range(700)] + [hot * 3] * 5
    x = np.array(x, np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [None, [], [0.0] * 64, [float("nan")] * 64, [None] * 64, [1.0, 2.0], [2.0, 4.0], [float("inf")] * 64]
    rows += [(len(x) + i, v) for i, v in enumerate(odd)] + [(None, x[0].tolist())]
    got = {r["vec_id"]: r for r in embed.neighbours(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()}
    assert len(got) == len(rows)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    assert [got[i]["n_links"] for i in range(len(x))] == near.sum(1).tolist()
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(x)).min(1))
        if (new == label).all():
            break
        label = new
    assert [got[i]["component_id"] for i in range(len(x))] == label.tolist()
    at = len(x)
    assert [got[at + i]["n_links"] for i in range(len(odd))] == [0, 0, 0, 0, 0, 1, 1, 0] and got[at + 6]["component_id"] == at + 5
    assert got[None]["n_links"] == 0 and got[None]["kept"]
    assert embed.neighbours(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def brute_lines(rows):
    """The first place of every passage stays, all later ones go."""
    places = {}
    for doc_id, text in sorted((r for r in rows if r[0] is not None and r[1] is not None)):
        for start, end in lines.passages(text):
            places.setdefault(text[start:end].rstrip("\n"), []).append((doc_id, start, end))
    gone = {}
    for found in places.values():
        for doc_id, start, end in sorted(found)[1:]:
            gone.setdefault(doc_id, set()).update(range(start, end))
    return {i: None if t is None else "".join(c for k, c in enumerate(t) if k not in gone.get(i, ())) for i, t in rows}


def test_line_chunks_equal_brute_force(documents):
    rng = random.Random(6)
    pool = [" ".join(words(rng, rng.randrange(4, 14))) for _ in range(400)]
    shared = pool[:12]
    long_line = " ".join(words(rng, 60))
    texts = [None, "", "\n\n", "one line", "\n".join(pool[:30]), "\n".join(pool[:30])]
    for k in range(30):
        own = [rng.choice(pool[12:]) for _ in range(rng.randrange(2, 20))]
        at = rng.randrange(len(own))
        own[at:at] = shared if k % 3 else [long_line] if k % 2 else []
        texts.append("\n".join(own) + ("\n" if k % 2 else ""))
    docs = documents(texts)
    out = lines.remove(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got == brute_lines(list(enumerate(texts)))
    assert sum(shared[4] in (t or "") for t in got.values()) < 4 and sum(long_line in (t or "") for t in got.values()) == 1
    assert got[3] == "one line" and len(got[5].split("\n")) < 12
    twice = documents([long_line, long_line + "\n"])
    assert [r["text"] for r in lines.remove(twice).orderBy("doc_id").collect()] == [long_line, ""]
    assert [r["doc_id"] for r in lines.remove(twice, drop_emptied=True).collect()] == [0]


def test_line_chunks_of_odd_rows(documents):
    rng = random.Random(1)
    text = "\n".join(" ".join(words(rng, 9)) for _ in range(12))
    docs = documents([text, text, text, text], [2, 2, None, 9])
    got = sorted(((r["doc_id"] or 0), r["text"] == text) for r in lines.remove(docs).collect())
    assert got[:3] == [(0, True), (2, True), (2, True)] and got[3] == (9, False)
    assert lines.remove(documents([])).count() == 0


def brute_runs(texts):
    """Of every run of lines with 50 words or more, found without ``passages``, the first place stays, the rest goes."""
    places = {}
    for d, text in enumerate(texts):
        rows = text.split("\n")
        for i in range(len(rows)):
            for j in range(i + 1, len(rows) + 1):
                if len(" ".join(rows[i:j]).split()) >= 50:
                    places.setdefault("\n".join(rows[i:j]), []).append((d, i, j))
    gone = {}
    for (d, i, j), *later in places.values():
        for e, a, b in later:
            gone.setdefault(e, set()).update(range(max(a, j) if e == d else a, b))
    return ["".join(r + "\n" for k, r in enumerate(t.split("\n")) if k not in gone.get(d, ())) for d, t in enumerate(texts)]


def test_repeated_runs_go_whole_wherever_borders_fall(documents):
    rng = random.Random(8)
    line = lambda n: " ".join(words(rng, n))
    passages = [[line(n) for _ in range(k)] for k, n in ((6, 10), (5, 12), (3, 40), (12, 9), (12, 12), (1, 70), (2, 25))] + [[line(40), line(40), line(1)]]
    texts = []
    for passage in passages * 5:
        texts.append("\n".join([line(rng.randrange(3, 15)) for _ in range(rng.randrange(4))] + passage + [line(rng.randrange(3, 15)) for _ in range(rng.randrange(4))]))
    texts.append("\n".join([line(10)] * 9 + [line(7), line(9)]))
    texts.append("\n".join([line(9), line(8)] * 7))
    got = [r["text"] for r in lines.remove(documents(texts)).orderBy("doc_id").collect()]
    want = brute_runs(texts)
    assert [[x for x in t.split("\n") if x] for t in got] == [[x for x in t.split("\n") if x] for t in want]
    for passage in passages:
        assert all(sum(x in t.split("\n") for t in got) == 1 for x in passage)


def test_links_at_the_threshold_are_rarely_missed():
    """Of pairs at exactly the threshold, the share that meets in no cell; at several sizes."""
    for size in (16, 64):
        rng = np.random.default_rng(size)
        x = rng.normal(size=(6000, size))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y = rng.normal(size=x.shape)
        y -= (y * x).sum(1, keepdims=True) * x
        y /= np.linalg.norm(y, axis=1, keepdims=True)
        a, _ = embed.cells(x, 0.9)
        b, _ = embed.cells(0.9 * x + np.sqrt(1 - 0.81) * y, 0.9)
        assert (~(a == b).any(1)).mean() < 0.0075


def test_links_of_a_given_table_equal_brute_force(spark):
    """The table, and noisy copies of its rows around the threshold: all pairs in double precision, and components by search.

    Links between 0.9 and 0.905 may be missed with a small probability; these rows have none that is.
    """
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    rng = np.random.default_rng(11)
    noisy = [(10_000 + i, (np.array(r["embedding"]) + rng.normal(size=64) * rng.uniform(0.02, 0.07)).tolist()) for i, r in enumerate(vectors.limit(300).collect())]
    vectors = vectors.union(spark.createDataFrame(noisy, "vec_id bigint, embedding array<float>"))
    rows = vectors.collect()
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    ids = [r["vec_id"] for r in rows]
    component = {}
    for i in sorted(range(len(ids)), key=ids.__getitem__):
        if ids[i] not in component:
            left = [i]
            while left:
                j = left.pop()
                if ids[j] not in component:
                    component[ids[j]] = ids[i]
                    left += np.flatnonzero(near[j]).tolist()
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed.neighbours(vectors).collect()}
    found, there = sum(n for n, _ in got.values()), int(near.sum())
    assert got == {ids[i]: (int(near[i].sum()), component[ids[i]]) for i in range(len(ids))} and found == there > 0
