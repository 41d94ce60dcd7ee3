"""Quality rules: fixed base limits, then a decision list learned by sequential covering. DataFrame functions only.

A decision list is an ordered list of threshold conjunctions over text statistics. It is learned on the driver from a
bounded sample of labelled statistics (numbers only), and applied as one ordered conditional expression per row, without
shuffle or Python.

Defined cases: a null text counts as empty; an empty text has all counts 0 and fails the base limit on words; rows are
judged one by one, so repeated rows, ties and null ids each give their own row; extra columns are ignored by ``judge`` and
kept by ``keep_good``; without labels the list is empty and only the base limits decide.

Windows are compared by a 64-bit hash of their three words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from gaugeline.llm.common import BLANK, WORD, labelled_sample, let

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"
#: Most labelled rows used to learn a list.
FIT_ROWS = 20_000

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What rules may test, from the counts; all are defined for empty texts.
FEATURES = {
    "symbols_per_word": lambda s: s["n_symbols"] / F.greatest(s["n_words"], F.lit(1)),
    "bangs_per_word": lambda s: s["n_bangs"] / F.greatest(s["n_words"], F.lit(1)),
    "upper_share": lambda s: s["n_upper"] / F.greatest(s["word_chars"], F.lit(1)),
    "digit_share": lambda s: s["n_digits"] / F.greatest(s["word_chars"], F.lit(1)),
    "repeat_share": lambda s: s["n_repeat_words"] / F.greatest(s["n_words"], F.lit(1)),
    "distinct_share": lambda s: s["n_distinct_words"] / F.greatest(s["n_words"], F.lit(1)),
    "dup_line_share": lambda s: s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)),
    "mean_word": lambda s: s["word_chars"] / F.greatest(s["n_words"], F.lit(1)),
    "n_words": lambda s: s["n_words"].cast("double"),
}


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more; n log n in the words of a text."""
    n = F.greatest(F.size(words) - 2, F.lit(0))
    triples = F.arrays_zip(F.slice(words, 1, n), F.slice(words, 2, n), F.slice(words, 3, n))
    hashes = F.transform(triples, lambda t: F.xxhash64(t["0"], t["1"], t["2"]))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = lambda s, x, j: F.coalesce(x["h"] == F.get(s, j)["h"], F.lit(False))
        repeated = let(ordered, lambda s: F.filter(s, lambda x, j: same(s, x, j + 1) | same(s, x, j - 1)))
        places = F.flatten(F.transform(repeated, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
        return F.size(F.array_distinct(places))

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def with_stats(docs: DataFrame, text: str = "text", into: str = "__stats") -> DataFrame:
    """``docs`` with a struct of counts (long) added."""
    at = docs.select("*", F.coalesce(F.col(text), F.lit("")).alias("__text"))
    at = at.select("*", F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)).alias("__words"), F.filter(F.split("__text", "\n", -1), lambda x: x.rlike(f"[^{BLANK}]")).alias("__lines"))
    t, w, lines = F.col("__text"), F.col("__words"), F.col("__lines")
    counts = {
        "n_words": F.size(w),
        "word_chars": F.aggregate(w, F.lit(0), lambda a, x: a + F.char_length(x)),
        "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(w),
        "n_lines": F.size(lines),
        "n_distinct_words": F.size(F.array_distinct(w)),
        "n_bangs": F.regexp_count(t, F.lit("!")),
        "n_upper": F.char_length(F.regexp_replace(t, r"[^\p{Lu}]+", "")),
        "n_digits": F.char_length(F.regexp_replace(t, r"[^0-9]+", "")),
    }
    return at.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(*[c.cast("long").alias(k) for k, c in counts.items()]).alias(into))


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"])


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def column(self, stats: Column) -> Column:
        value = FEATURES[self.feature](stats)
        return value >= F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def mask(self, x: np.ndarray) -> np.ndarray:
        v = x[:, list(FEATURES).index(self.feature)]
        return v >= self.threshold if self.above else v <= self.threshold


Rule = tuple[Test, ...]


def _mask(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for test in rule:
        out &= test.mask(x)
    return out


def _best_test(x: np.ndarray, bad: np.ndarray, inside: np.ndarray) -> tuple[float, Test | None]:
    """The test with the largest FOIL gain among quantile thresholds."""
    p0, n0 = int((inside & bad).sum()), int((inside & ~bad).sum())
    before = np.log2(p0 / (p0 + n0))
    best: tuple[float, Test | None] = (1e-9, None)
    for k, name in enumerate(FEATURES):
        values = np.sort(x[inside & bad, k])
        cuts = np.unique(values[np.linspace(0, len(values) - 1, min(len(values), 24)).astype(int)])
        for above in (True, False):
            for cut in cuts:
                hit = inside & (x[:, k] >= cut if above else x[:, k] <= cut)
                p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
                if p and (gain := p * (np.log2(p / (p + n)) - before)) > best[0]:
                    best = (gain, Test(name, above, float(cut)))
    return best


def learn(x: np.ndarray, bad: np.ndarray, precision: float = 0.95, most_rules: int = 20) -> list[Rule]:
    """Sequential covering: grow a rule on two thirds of the rows, prune it on the rest, drop the rows it covers, repeat.

    Every third row, in the order given, prunes. A rule is accepted while it is right for ``precision`` of the pruning rows
    it covers, and for three rows at least over all.
    """
    rules: list[Rule] = []
    left = np.ones(len(x), dtype=bool)
    prunes = np.arange(len(x)) % 3 == 2
    while len(rules) < most_rules and (left & bad & ~prunes).sum() >= 3:
        rule: Rule = ()
        inside = left & ~prunes
        while (inside & ~bad).any() and len(rule) < 4:
            _, test = _best_test(x, bad, inside)
            if test is None:
                break
            rule += (test,)
            inside &= test.mask(x)
        if not rule:
            break

        def worth(r: Rule) -> float:
            hit = _mask(r, x) & left & prunes
            p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
            return (p - n) / (p + n) if p + n else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = _mask(rule, x) & left
        sure = hit & prunes if (hit & prunes).any() else hit
        if (hit & bad).sum() < 3 or (sure & bad).sum() < precision * sure.sum():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> list[Rule]:
    """A list that rejects what ``labels.quality`` marks 0, from at most about ``fit_rows`` labelled documents."""
    sample = with_stats(labelled_sample(docs, labels, "quality", F.lit(True), fit_rows))
    rows = sample.select("doc_id", "label", *[FEATURES[k](F.col("__stats")).alias(k) for k in FEATURES]).collect()
    rows.sort(key=lambda r: tuple(r))
    x = np.array([list(r)[2:] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    return learn(x, np.array([r["label"] == 0 for r in rows], dtype=bool))


def verdict(rules: list[Rule], stats: Column) -> Column:
    """The list as one ordered conditional: the first rule that holds rejects."""
    out = None
    for rule in rules:
        holds = rule[0].column(stats)
        for test in rule[1:]:
            holds = holds & test.column(stats)
        out = F.when(holds, F.lit(False)) if out is None else out.when(holds, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed`` and ``kept``."""
    s = F.col("__stats")
    counted = with_stats(docs.select("doc_id", "text")).select("doc_id", "__stats", base_failed(s).alias("base_failed"))
    return counted.select("doc_id", *[s[k].alias(k) for k in BASE], "base_failed", F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(rules, s)).alias("kept"))


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that neither the base limits nor the list reject, with their own columns."""
    s = F.col("__stats")
    return with_stats(docs).where(~base_failed(s) & verdict(rules, s)).select(*[F.col(f"`{c}`") for c in docs.columns])
