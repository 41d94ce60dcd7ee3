"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust a score.

DataFrame functions only, one pass per row, no shuffle. Positions count code points; the end is exclusive.

Base kinds (email, ip, card, phone) are fixed by contract and always reported. Added kinds (iban by mod-97, ssn by context)
are reported at a score of ``ACCEPT`` or more.

The patterns match what the contract's match, written so that Java's engine neither recurses nor rescans: possessive runs,
and starts only where no run of the same characters is already under way (or where the last match ended).

Defined cases: a null text counts as empty; an empty text has no spans; rows are judged one by one, so repeated rows, ties
and null ids each give their own row; other columns are ignored by ``find`` and kept by ``redact``. Overlapping spans of
different kinds are all reported; ``redact`` replaces their union once, by the tag of the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeline.llm.common import let

BASE = ["email", "ip", "card", "phone"]
ADDED = ["iban", "ssn"]
_LOCAL = "[A-Za-z0-9._%+-]"
#: Countries by the length of their IBAN.
IBANS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_KNOWN = f"(?:{'|'.join(' '.join(IBANS.values()).split())})[0-9]{{2}}"
_EXACT = "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBANS.items())
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # As long as the country's are; of unknown countries as long as it gets, but not into one of a known country.
    "iban": rf"(?=[A-Z]{{2}}[0-9]{{2}})(?<![A-Za-z0-9])(?:(?:{_EXACT})(?![A-Za-z0-9])|(?!{_KNOWN})[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]|\x20(?!{_KNOWN})[A-Z0-9]){{11,30}})",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
#: A cheap condition without which a kind can't occur.
GATES = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
#: Score of a confirmed span, and what a context word adds.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
CONTEXT_BONUS = 0.3
ACCEPT = 0.5
#: Code points looked at on either side, and words that raise the score there.
NEARBY = 40
#: So many matches, of four code points at least, fill ``NEARBY``.
_REACH = NEARBY // 4
CONTEXT = {
    "email": "mail|contact|reach",
    "ip": "address|host|server|login",
    "card": "card|visa|credit|payment|debit",
    "phone": "phone|call|mobile|tel",
    "iban": "iban|bank|account|transfer",
    "ssn": "ssn|social|security",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
_SPANS = "array<struct<s:int,k:int,e:int,score:double>>"


def _sum(items: Column, value) -> Column:
    return F.aggregate(items, F.lit(0), lambda a, x: a + value(x))


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, digit sums added, a multiple of ten."""

    def value(d: Column, i: Column) -> Column:
        twice = d * 2
        return F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return let(F.reverse(digits), lambda r: _sum(F.sequence(F.lit(1), F.char_length(r)), lambda i: value(F.substr(r, i, F.lit(1)).cast("int"), i)) % 10 == 0)


def _mod97(code: Column) -> Column:
    """The first four characters last, letters as 10 to 35, the number modulo 97 is 1."""
    moved = F.concat(F.substr(code, F.lit(5)), F.substr(code, F.lit(1), F.lit(4)))

    def step(a: Column, c: Column) -> Column:
        n = F.ascii(c)
        return F.when(n >= 65, (a * 100 + n - 55) % 97).otherwise((a * 10 + n - 48) % 97)

    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step) == 1


def _confirmed(kind: str, m: Column, before: Column, after: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return let(digits, lambda d: F.when(F.char_length(d).between(12, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    alone = ~F.substr(before, F.lit(-1), F.lit(1)).rlike("^[A-Za-z0-9]$") & ~F.substr(after, F.lit(1), F.lit(1)).rlike("^[A-Za-z0-9]$")
    if kind == "iban":
        return alone & _mod97(F.replace(m, F.lit(" "), F.lit("")))
    return alone if kind == "ssn" else F.lit(True)


def _with_context(parts: Column) -> Column:
    """``parts`` (piece, match, next piece) with ``near``: the text around a match, other matches included.

    As many neighbours are joined as ``NEARBY`` code points can hold, each cut to that length, so the work is linear.
    """
    last = lambda x: F.substr(x, F.lit(-NEARBY), F.lit(NEARBY))
    first = lambda x: F.substr(x, F.lit(1), F.lit(NEARBY))
    sides = F.transform(parts, lambda z: F.struct(F.concat(last(z["0"]), last(z["m"])).alias("l"), F.concat(first(z["m"]), first(z["2"])).alias("r")))

    def around(sides: Column) -> Column:
        def near(z: Column, i: Column) -> Column:
            reach = F.least(i, F.lit(_REACH))
            before = F.concat(F.array_join(F.slice(sides["l"], i - reach + 1, reach), ""), last(z["0"]))
            after = F.concat(first(z["2"]), F.array_join(F.slice(sides["r"], i + 2, F.lit(_REACH)), ""))
            return F.struct(z["0"].alias("0"), z["m"].alias("m"), z["2"].alias("2"), F.concat_ws(" ", last(before), first(after)).alias("near"))

        return F.transform(parts, near)

    return let(sides, around)


def _spans(text: Column, kind: str) -> Column:
    """Spans of a kind. The pieces between matches and the matches, laid end to end, give the positions."""
    pattern, none = PATTERNS[kind], F.expr(f"cast(array() as {_SPANS})")
    rank = (BASE + ADDED).index(kind)

    def step(acc: Column, z: Column) -> Column:
        start = acc["at"] + F.char_length(z["0"])
        end = start + F.char_length(z["m"])
        near = F.lower(z["near"])
        score = F.least(F.lit(1.0), F.lit(SCORES[kind]) + F.when(near.rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0))
        good = _confirmed(kind, z["m"], z["0"], z["2"]) & (F.lit(kind in BASE) | (score >= ACCEPT))
        span = F.struct(start.alias("s"), F.lit(rank).alias("k"), end.alias("e"), score.alias("score"))
        return F.struct(end.alias("at"), F.when(good, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    def walk(p: Column) -> Column:
        n = F.size(p["m"])
        parts = F.arrays_zip(F.slice(p["p"], 1, n), p["m"], F.slice(p["p"], 2, n))
        return F.aggregate(let(parts, _with_context), F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda a: a["out"])

    found = let(F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m")), walk)
    gate = text.contains(GATES[kind]) if kind in GATES else F.lit(True)
    return F.when(gate & text.rlike(pattern), found).otherwise(none)


def with_spans(docs: DataFrame, text: str = "text", into: str = "__spans") -> DataFrame:
    """``docs`` with an array of spans (start, rank of the kind, end, score) in order of start, then kind."""
    whole = docs.select("*", F.coalesce(F.col(text), F.lit("")).alias("__whole"))
    each = whole.select("*", *[_spans(F.col("__whole"), k).alias(f"__{k}") for k in BASE + ADDED])
    return each.select(*[F.col(f"`{c}`") for c in docs.columns], F.sort_array(F.concat(*[F.col(f"__{k}") for k in BASE + ADDED])).alias(into))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, the hash of the base spans, all spans, and their scores."""
    kinds = F.array(*[F.lit(k) for k in BASE + ADDED])
    s = F.col("__spans")
    base = F.filter(s, lambda x: x["k"] < len(BASE))
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"], x["e"])), ",")
    of_kind = lambda k: F.size(F.filter(s, lambda x: x["k"] == k)).cast("long")
    counts = [of_kind(k).alias(f"n_{kind}") for k, kind in enumerate(BASE)]
    scores = F.array_join(F.transform(s, lambda x: F.format_number(x["score"], 1)), ",")
    return with_spans(docs.select("doc_id", "text")).select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(s).alias("spans"), scores.alias("scores"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each span of ``text`` replaced by a tag such as ``[EMAIL]``. Texts without spans stay as they are."""
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in BASE + ADDED])

    def cut(t: Column, spans: Column) -> Column:
        def step(a: Column, x: Column) -> Column:
            fresh = x["s"] >= a["at"]
            gap = F.substr(t, a["at"] + 1, F.greatest(x["s"] - a["at"], F.lit(0)))
            return F.struct(F.greatest(a["at"], x["e"]).alias("at"), F.when(fresh, F.concat(a["out"], F.array(gap, F.get(tags, x["k"])))).otherwise(a["out"]).alias("out"))

        start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
        return F.aggregate(spans, start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substr(t, a["at"] + 1)))

    marked = with_spans(docs, text)
    clean = F.when(F.size("__spans") == 0, F.col(text)).otherwise(cut(F.col(text), F.col("__spans")))
    return marked.select(*[clean.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
