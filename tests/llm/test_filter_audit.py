from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

from gaugeline.llm import filter_audit as audit

SCHEMA = "doc_id bigint, text string, source string, part string, n bigint, mask string"  # the last three clash with result names


def rows(seed=3, n=160):
    rng = random.Random(seed)
    pool = ["", "a", "B" * 40, "x $ y", " ".join(f"w{i}" for i in range(250)), "same " * 300, "Z " * 3 + "w " * 20, " ".join(f"q{i} é　日" for i in range(260)) + " #", "w\x0bx\x0cy " * 120]
    pool += [" ".join(rng.choice("abcdefgh") * 3 for _ in range(rng.randrange(150, 260))) for _ in range(6)] + ["long " * 30_000 + "tail"]
    out = []
    for i in range(n):
        doc_id = rng.choice([None, i, i, i, i // 3])
        out.append((doc_id, rng.choice([None, *pool]), rng.choice([None, "s", "t", "hot", "hot"]), "x", 1, "y"))
    return out + out[:15]  # repeated rows


def labels(spark):
    values = [(i, i % 3 == 0, i % 7 == 0) for i in range(0, 160, 2)]
    given = [(i, int(q), int(t)) for i, q, t in values] + [(0, 0, 0), (None, 1, 1), (4, None, None)]
    return spark.createDataFrame(given, "doc_id bigint, quality int, toxic int"), {i: (int(q), int(t)) for i, q, t in values}


def expected(given, known):
    """Every order filter by filter, document by document."""
    least: dict[str, int] = {}
    for doc_id, text, *_ in given:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    docs = []
    for doc_id, text, source, *_ in given:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": doc_id is not None and doc_id > least[t],
        }
        docs.append((source or "", {k for k, v in fails.items() if v}, known.get(doc_id, (0, 0)) if doc_id is not None else (0, 0)))
    out, removed_by = {}, Counter()
    for order in permutations("ABCDE"):
        for step, name in enumerate(order, 1):
            for part in {d[0] for d in docs}:
                mine = [d for d in docs if d[0] == part]
                there = [d for d in mine if not d[1] & set(order[: step - 1])]
                gone = [d for d in there if name in d[1]]
                removed_by[part, name] += len(gone)
                out[part, "".join(order), step] = [
                    len(there) - len(gone), len(gone), sum(name in d[1] for d in mine) - len(gone), sum(d[1] == {name} for d in mine),
                    sum(d[2][0] for d in gone), sum(d[2][1] for d in gone),
                ]
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in df.collect()}
    assert df.count() == len(found)
    return found


def put(spark, given, path, files):
    """Files of descending ids, so that nearly every later file holds smaller ids of known texts."""
    order = sorted(given, key=lambda r: -(r[0] if r[0] is not None else 50))
    size = -(-len(order) // files)
    for at in range(0, len(order), size):
        spark.createDataFrame(order[at : at + size], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_every_order_equals_brute_force_over_many_batches(spark, tmp_path):
    known, flags = labels(spark)
    path = str(tmp_path / "docs")
    put(spark, rows(), path, 6)
    want = expected(rows(), flags)
    assert got(audit.audit(spark, path, known, batches=6)) == want
    assert got(audit.audit(spark, path, known, batches=1)) == want
    assert len(want) == 600 * len({k[0] for k in want}) and any(v[6] for v in want.values())


def test_later_files_retract_what_earlier_ones_counted(spark, tmp_path):
    known, flags = labels(spark)
    path, home = str(tmp_path / "docs"), str(tmp_path / "home")
    later = [(r[0], *r[1:]) for r in rows() if r[0] is not None and r[0] < 60]
    earlier = [r for r in rows() if r not in later]
    put(spark, earlier, path, 2)
    assert got(audit.audit(spark, path, known, home)) == expected(earlier, flags)
    put(spark, later, path, 2)
    assert got(audit.audit(spark, path, known, home)) == expected(earlier + later, flags)
    negative = spark.read.parquet(f"{home}/counters/batch=*").where("n < 0").count()
    assert negative > 0  # retractions were written
    assert got(audit.audit(spark, path, known, home)) == expected(earlier + later, flags)  # nothing new: nothing changes


def test_more_than_few_labels_are_not_broadcast(spark, tmp_path, monkeypatch):
    known, flags = labels(spark)
    path, made, plans = str(tmp_path / "docs"), audit.masked, []
    put(spark, rows(), path, 2)

    def planned(*args):
        plans.append(made(*args))
        return plans[-1]

    monkeypatch.setattr(audit, "masked", planned)
    want = expected(rows(), flags)
    for limit in (3, 1000):
        monkeypatch.setattr(audit, "FEW_IDS", limit, raising=False)
        assert got(audit.audit(spark, path, known)) == want
    many, few = (df._jdf.queryExecution().analyzed().toString() for df in plans)
    assert "strategy=merge" in many and "strategy=broadcast" not in many  # a small file is no reason for a broadcast
    assert "strategy=broadcast" in few


def test_state_keeps_the_smallest_id():
    texts: dict = {}
    assert audit.change(texts, iter([(b"t", "p", 1, 0, 9, 2, 3)])) == Counter({("p", 1, 0): 2, ("p", 17, 0): 3})
    assert audit.change(texts, iter([(b"t", "q", 1, 2, 4, 1, 0)])) == Counter({("p", 1, 0): -2, ("p", 17, 0): 2, ("q", 1, 2): 1})
    assert audit.change(texts, iter([(b"t", "p", 1, 0, 4, 1, 0), (b"t", "p", 1, 0, 7, 1, 0)])) == Counter({("p", 1, 0): 1, ("p", 17, 0): 1})
    assert texts == {b"t": (4, {("q", 2): 1, ("p", 0): 1})}


def test_a_hot_text_leaves_a_task_as_few_rows():
    import pyarrow as pa

    n = 5000
    batch = pa.RecordBatch.from_arrays([pa.array([b"d"] * n), pa.array(["a", "b"] * (n // 2)), pa.array([3] * n, pa.int32()), pa.array([0] * n, pa.int32()), pa.array(range(n, 0, -1), pa.int64())], ["digest", "part", "bits", "flags", "doc_id"])
    out = pa.Table.from_batches(audit.reduce_task(iter([batch]))).to_pylist()
    assert [(r["part"], r["doc_id"], r["n_first"], r["n_over"]) for r in out] == [("a", 1, 0, n // 2), ("b", 1, 1, n // 2 - 1)]


def test_no_rows(spark, tmp_path):
    known, _ = labels(spark)
    path = str(tmp_path / "none")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    assert audit.audit(spark, path, known).count() == 0
    assert audit.audit(spark, str(tmp_path / "missing"), known).count() == 0


def test_one_file_by_its_name(spark, tmp_path):
    import glob
    import shutil

    known, flags = labels(spark)
    put(spark, rows(n=30), str(tmp_path / "made"), 1)
    shutil.copy(glob.glob(str(tmp_path / "made" / "part-*"))[0], tmp_path / "docs.parquet")
    shutil.copy(tmp_path / "docs.parquet", tmp_path / "other.parquet")
    assert got(audit.audit(spark, str(tmp_path / "docs.parquet"), known)) == expected(rows(n=30), flags)
