from __future__ import annotations

import hashlib
import random
import re

from gaugeline.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def good(kind: str, m: str) -> bool:
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 if kind == "phone" else True


def brute(text: str | None):
    spans = sorted((m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if good(kind, m[0]))
    return [f"{kind}:{s}:{e}" for s, _, e, kind in spans]


def texts() -> list[str | None]:
    rng = random.Random(4)
    out: list[str | None] = [
        None, "", "plain words only", "mail a.b+c@ex-ample.co.uk. or x@y", "a@b.c_d@e.f g@@h.i @j.k", "é x@y.zé 1.2.3.4.5.6.7.8", "256.1.1.1 0001.02.003.255 1.2.3",
        "card 4111 1111 1111 1111, 4111-1111-1111-1112", "5 4111111111111111 9", "+1 (269) 555-3296 call", "+12 +123456789012345678", "+1..........5 x +1 ( ", "4" * 200,
        "a" * 5000, "1 " * 3000, "." * 4000 + "+" * 200, "x@" * 2000, "1.2.3." * 1000, "IBAN GB82 WEST 1234 5698 7654 32 ok", "DE89370400440532013000 DE89370400440532013001", "ssn 123-45-6789 and 123-45-6788 far away from any such word, many words later 123-45-6787",
        "\U0001f600 a@b.co \U0001f600\U0001f600 4111111111111111",
    ]
    for _ in range(300):
        out.append("".join(rng.choice(["1", "23", "4", ".", " ", "-", "+", "@", "a", "b.c", "é", "(", ")", "255", "4111111111111111", "x@y.z"]) for _ in range(rng.randrange(40))))
    return out


def test_base_spans_equal_the_contract(documents):
    given = texts()
    rows = {r["doc_id"]: r for r in pii.find(documents(given)).collect()}
    assert len(rows) == len(given)
    for i, text in enumerate(given):
        want = brute(text)
        got = [x for x in rows[i]["spans"].split(",") if x.split(":")[0] in pii.BASE]
        assert got == want, (text, got, want)
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in pii.BASE] == [sum(x.startswith(k + ":") for x in want) for k in pii.BASE]


def test_checksums_and_context_decide_added_kinds(documents):
    rows = pii.find(documents(["IBAN GB82 WEST 1234 5698 7654 32 ok", "DE89370400440532013000", "DE89370400440532013001", "ssn 123-45-6789", "order 123-45-6789"])).orderBy("doc_id").collect()
    added = [[x for x in r["spans"].split(",") if x.split(":")[0] in pii.ADDED] for r in rows]
    assert added == [["iban:5:32"], ["iban:0:22"], [], ["ssn:4:15"], []]


def test_redaction_keeps_rows_columns_and_other_text(documents):
    docs = documents(["mail a@b.co now", None, "", "x 4111 1111 1111 1111 +12 345 678 901 y", "clean"], [1, 2, None, 4, 4])
    out = pii.redact(docs)
    assert out.columns == docs.columns
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in out.collect())
    assert [t for _, _, t in got] == ["mail [EMAIL] now", "", "clean", "x [CARD] [PHONE] y", ""]
    assert [r["text"] for r in out.where("doc_id is null").collect()] == [""] and out.where("text is null").count() == 1


def test_empty_table(documents):
    assert pii.find(documents([])).collect() == [] and pii.redact(documents([])).collect() == []


def test_ibans_before_capitals_and_numbers(documents):
    gb, de, no = "GB82 WEST 1234 5698 7654 32", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947"
    texts = [f"{gb} Please", f"{de} EUR", f"{de} 100", f"to {de} BIC COBADEFF", f"{gb} {de} {no}", f"AB12 {gb} PAY", f"X{gb}", f"{gb}X", f"{no} 12 A", "GB82 WEST 1234 5698 7654 33 OK", "DE89370400440532013000 EUR", "XX32 ABCD 1234 5678 901, GB"]
    rows = pii.find(documents(texts)).orderBy("doc_id").collect()
    found = [[t[int(s) : int(e)] for k, s, e in (x.split(":") for x in r["spans"].split(",") if x) if k == "iban"] for t, r in zip(texts, rows, strict=True)]
    assert found == [[gb], [de], [de], [de], [gb, de, no], [gb], [], [], [no], [], [de.replace(" ", "")], ["XX32 ABCD 1234 5678 901"]]
    clean = [r["text"] for r in pii.redact(documents(texts)).orderBy("doc_id").collect()]
    assert clean[0] == "[IBAN] Please" and clean[4] == "[IBAN] [IBAN] [IBAN]"


def test_context_reaches_over_other_matches(documents):
    far = "x" * 41
    texts = ["Social security numbers: 123-45-6789, 987-65-4321, 111-22-3333", "123-45-6789, 987-65-4321 (ssn)", f"ssn {far} 123-45-6789", f"987-65-4321 {far} 123-45-6789 ssn", "order 123-45-6789, 987-65-4321"]
    rows = pii.find(documents(texts)).orderBy("doc_id").collect()
    found = [[int(x.split(":")[1]) for x in r["spans"].split(",") if x.startswith("ssn:")] for r in rows]
    want = []
    for t in texts:
        near = lambda m: (t[max(0, m.start() - 40) : m.start()] + " " + t[m.end() : m.end() + 40]).lower()  # noqa: B023, E731
        want.append([m.start() for m in re.finditer(r"\d{3}-\d{2}-\d{4}", t) if re.search(pii.CONTEXT["ssn"], near(m))])
    assert found == want and list(map(len, want)) == [2, 2, 0, 1, 0]
