from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from gaugeline.llm import factor_machine, quality_rules, toxicity
from gaugeline.llm.common import fold, fold_of


def brute_stats(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows: dict[tuple, list[int]] = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + d for places in windows.values() if len(places) > 1 for i in places for d in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_base_counts_equal_brute_force(documents):
    rng = random.Random(2)
    texts = [None, "", " \t\n\x0b\x0c\r", "a", "a b", "a b c", "a b c a b c", "a a a a", "x\n\nx\n x\nx", "é ü 　 z", "#*$%&|<>" * 3, "w " * 3000]
    texts += ["".join(rng.choice(["a", "b", "ab", " ", "  ", "\n", "\t", "#", "é"]) for _ in range(rng.randrange(120))) for _ in range(150)]
    rows = {r["doc_id"]: r for r in quality_rules.judge(documents(texts), []).collect()}
    for i, text in enumerate(texts):
        want = brute_stats(text)
        assert tuple(rows[i][c] for c in quality_rules.BASE) == want, text
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert (rows[i]["base_failed"], rows[i]["kept"]) == (failed, not failed)


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(n))


def corpus(n: int = 400):
    """Clean texts, shouting ones (quality 0) and insulting ones (toxic 1); one label in fifty is wrong."""
    rng = random.Random(9)
    texts, quality, toxic = [], [], []
    for _ in range(n):
        text, q, t = words(rng, rng.randrange(60, 140)), 1, 0
        kind = rng.randrange(4)
        if kind == 1:
            text, q = " ".join(w.upper() + "!!" for w in text.split()), 0
        elif kind == 2:
            parts = text.split()
            for _ in range(4):
                parts.insert(rng.randrange(len(parts)), rng.choice(["idiot", "grumpf", "zolkig", "zolkan"]))
            text, t = " ".join(parts), 1
        if rng.randrange(50) == 0:
            q, t = 1 - q, 1 - t
        texts.append(text)
        quality.append(q)
        toxic.append(t)
    return texts, quality, toxic


def labelled(spark, documents):
    texts, quality, toxic = corpus()
    labels = spark.createDataFrame([(i, q, t) for i, (q, t) in enumerate(zip(quality, toxic, strict=True))], "doc_id bigint, quality int, toxic int")
    return documents(texts), labels, quality, toxic


def test_decision_list_separates_and_is_one_expression(spark, documents):
    docs, labels, quality, _ = labelled(spark, documents)
    rules = quality_rules.fit(docs, labels)
    assert rules and all(len(r) <= 4 for r in rules)
    judged = quality_rules.judge(docs, rules)
    kept = {r["doc_id"]: r["kept"] for r in judged.collect()}
    assert np.mean([kept[i] == bool(q) for i, q in enumerate(quality)]) > 0.95
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    good = quality_rules.keep_good(docs, rules)
    assert good.columns == docs.columns and good.count() == sum(kept.values())


def test_held_out_accuracy_of_both_classifiers(spark, documents):
    docs, labels, quality, toxic = labelled(spark, documents)
    model = toxicity.fit(docs, labels, fold(F.col("doc_id"), 5) != 0)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [i for i in scores if fold_of(i, 5) == 0]
    assert len(held) > 50 and np.mean([(scores[i] >= 0.5) == bool(toxic[i]) for i in held]) > 0.9
    machine = factor_machine.fit(docs, labels, fold(F.col("doc_id"), 4) != 2, metadata=["n_chars"])
    scores = {r["doc_id"]: r["score"] for r in factor_machine.score(docs, machine, ["n_chars"]).collect()}
    held = [i for i in scores if fold_of(i, 4) == 2]
    assert np.mean([(scores[i] >= 0.5) == bool(quality[i]) for i in held]) > 0.9


def test_label_model_weighs_copies_of_a_voter_once():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 3000)
    weak = np.where(rng.random(3000) < 0.7, y, 1 - y)
    strong = [np.where(rng.random(3000) < 0.85, y, 1 - y) for _ in range(3)]
    model = toxicity.LabelModel()
    model.fit(np.stack([weak, weak, weak, weak, *strong], 1), y)
    assert sum(int(p in (0, 1, 2, 3)) for p in model.parent[:4]) >= 3
    agree = ((model.log_odds(np.stack([weak, weak, weak, weak, *strong], 1)) > 0) == (y == 1)).mean()
    assert agree > 0.9


def test_machine_equals_all_pairs():
    rng = np.random.default_rng(1)
    machine = factor_machine.Machine(0.3, rng.normal(size=30), rng.normal(size=(30, 4)))
    ids, vals = np.array([1, 5, 7, 29]), rng.normal(size=4)
    want = 0.3 + machine.linear[ids] @ vals
    for i in range(4):
        for j in range(i):
            want += machine.factors[ids[i]] @ machine.factors[ids[j]] * vals[i] * vals[j]
    assert abs(machine.margin(ids, vals) - want) < 1e-9


def test_words_that_share_a_bucket_are_one_feature():
    """A text with far more words than buckets: the score equals the sum over all pairs of distinct features."""
    text = " ".join(f"w{i}" for i in range(5000)) + " w1 w1 w2"
    ids, vals = factor_machine.features(text, [0.7], {})
    size = factor_machine.STATS + 1 + factor_machine.BUCKETS
    assert len(set(ids.tolist())) == len(ids) <= size < 5000
    first = factor_machine.STATS + 1
    counts = {w: text.split().count(w) for w in ("w1", "w2")} | {f"w{i}": 1 for i in (0, *range(3, 5000))}
    dense = np.zeros(size)
    dense[:first] = vals[:first]
    for w, c in counts.items():
        dense[first + factor_machine.zlib.crc32(w.encode()) % factor_machine.BUCKETS] += np.sqrt(c / 5003)
    rng = np.random.default_rng(4)
    machine = factor_machine.Machine(-0.2, rng.normal(size=size) / 10, rng.normal(size=(size, 8)) / 10)
    pairs = machine.factors @ machine.factors.T
    want = -0.2 + machine.linear @ dense + sum(pairs[i, j] * dense[i] * dense[j] for i in range(size) for j in range(i) if dense[i] and dense[j])
    assert abs(machine.margin(ids, vals) - want) < 1e-3


def test_no_labels_one_class_and_odd_rows(spark, documents):
    docs = documents([None, "", "some words", "long " * 20_000, "some words"], [1, 2, None, 4, 4])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 1), (4, 1, 1), (None, 0, 0), (2, None, None)], "doc_id bigint, quality int, toxic int")
    for labels, value in ((none, 0.0), (one, 1.0)):
        for module in (toxicity, factor_machine):
            scored = module.score(docs, module.fit(docs, labels, F.lit(True))).collect()
            assert len(scored) == 5 and all(abs(r["score"] - value) < 1e-6 for r in scored)
        assert quality_rules.judge(docs, quality_rules.fit(docs, labels)).count() == 5
    empty = documents([])
    assert toxicity.score(empty, toxicity.fit(empty, one, F.lit(True))).count() == 0
    assert factor_machine.score(empty, factor_machine.fit(empty, one, F.lit(True))).count() == 0
    assert quality_rules.judge(empty, []).count() == 0
