"""Spans of personal data against the fixed patterns and against a span-wise check."""

from __future__ import annotations

import hashlib
import random
import re
import time

from ledgerlake.llm import pii
from ledgerlake.llm.queries import QUERIES
from tests.llm.common import SF, no_docs, odd_docs

#: The base patterns in the contract's words.
FIXED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def passes(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text: str | None) -> list[str]:
    found = []
    for rank, (kind, pattern) in enumerate(FIXED.items()):
        found += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if passes(kind, m[0])]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def assert_base(rows, texts) -> None:
    for r in rows:
        expected = base_spans(texts[r.doc_id])
        own = [s for s in r.spans.split(",") if s.split(":")[0] in FIXED]
        assert own == expected, (texts[r.doc_id][:200], own, expected)
        assert r.base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(f"{k}:") for s in expected) for k in FIXED]


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op9_personal_data"](spark, SF).collect()
    assert len(rows) == len(texts)
    assert_base(rows, texts)


def test_adversarial_texts(spark):
    draw = random.Random(8)
    parts = ["a@b.c", "_d@e.f", "@", ".", "..", "-", " ", "  ", "+", "+1", "(", ")", "1.2.3.4", "255", "256.", "0001",
             "4539 1488 0343 6467", "4539148803436467", "79927398713", "0" * 13, "x", "é", "\U0001f600", "%", "\n", "12-3"]
    texts = {k: "".join(draw.choice(parts) for _ in range(draw.randint(1, 14))) for k in range(1500)}
    texts |= {k + 5000: "".join(draw.choices("12 -.+@a(", k=draw.randint(1, 40))) for k in range(1500)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert_base(pii.detected(docs).collect(), texts)


def test_long_runs(spark):
    def runs(n):
        return {1: "a" * n, 2: "1" * n, 3: "1." * n, 4: "+" * n + "1 " * n, 5: "a.b@" * (n // 20)}

    docs = spark.createDataFrame(list(runs(800).items()), "doc_id long, text string")
    assert_base(pii.detected(docs).collect(), runs(800))
    # Would take hours if each start within a run were tried.
    docs = spark.createDataFrame(list(runs(200_000).items())[:2], "doc_id long, text string")
    assert [r.spans for r in pii.detected(docs).collect()] == ["", ""]


def test_added_kinds_and_context(spark):
    texts = {
        1: "IBAN DE89 3704 0044 0532 0130 00 ok",
        2: "IBAN DE88 3704 0044 0532 0130 00 wrong digits",
        3: "4539148803436467 4539148803436467",
        4: "social security 123-45-6789",
        5: "number 123-45-6789 alone",
        6: 'token = "abcdef0123456789abcdef"',
        7: "mail me: a@b.co",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.detected(docs).collect()}
    assert rows[1].spans == "iban:5:32"
    assert rows[2].spans == ""
    assert rows[3].spans == "card_part:0:16,card_part:17:33" and rows[3].n_card == 0
    assert rows[4].spans == "ssn:16:27"
    assert rows[5].spans == ""
    assert rows[6].spans.startswith("secret:0:")
    assert rows[7].scored_spans == "email:9:15:1.00"


def test_masked(spark):
    rows = [(1, "call +1 (743) 555-3824 or mail a@b.co, \U0001f600 1.2.3.4", 3), (2, None, 4), (3, "clean", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found int")
    masked = {r.doc_id: r for r in pii.masked(docs).collect()}
    assert masked[1].text == "call [PHONE] or mail [EMAIL], \U0001f600 [IP]"
    assert masked[2].text is None and masked[3].text == "clean" and masked[3].found == 5


def test_odd_rows(spark):
    rows = pii.detected(odd_docs(spark)).collect()
    assert len(rows) == 11 and all(r.spans == "" for r in rows)
    assert {r.base_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert pii.detected(no_docs(spark)).count() == 0
    assert pii.masked(odd_docs(spark)).drop("text").exceptAll(odd_docs(spark).drop("text")).count() == 0


def test_native(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = pii.detected(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan


def test_account_number_before_a_word(spark):
    """Numbers of whole groups of four, followed by a short word, a number or another account number."""
    numbers = ["ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "BE68 5390 0754 7034", "SE45 5000 0000 0583 9825 7466",
               "PL61 1090 1014 0000 0712 1981 2874", "CZ65 0800 0000 1920 0014 5399", "NO93 8601 1117 947", "DE89 3704 0044 0532 0130 00"]
    numbers += [number.replace(" ", "") for number in numbers]
    # A country that is not listed: check digits for 24 characters.
    other = "ZZ" + str(98 - int("1234" * 5 + "353500") % 97).zfill(2) + " 1234" * 5
    texts, expected = {}, {}
    for k, number in enumerate([*numbers, other]):
        for j, after in enumerate((" BIC CAIXESBB", " 7", " ABCD x", " 2024 ONE", ",", "")):
            texts[10 * k + j], expected[10 * k + j] = f"IBAN {number}{after}", f"iban:5:{5 + len(number)}"
    texts[999], expected[999] = f"{numbers[0]} {numbers[1]}", "iban:0:29,iban:30:54"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: ",".join(s for s in r.spans.split(",") if s.startswith("iban")) for r in pii.detected(docs).collect()} == expected
    assert pii.masked(docs.where("doc_id = 0")).first().text == "IBAN [IBAN] BIC CAIXESBB"


def test_many_spans_cost_linear_time(spark):
    """Contact lists: beyond several stretches and pieces, with marks over their borders."""
    people = [f"Büro {k}: call +49 30 {1000000 + k}, mail p{k}@host.example 𝒜" for k in range(30_000)]
    docs = spark.createDataFrame([(1, "; ".join(people)), (2, "ab@cd.ef, " * 257), (3, "x" * 256 + " a@b.cd")], "doc_id long, text string")
    texts = {r.doc_id: r.text for r in docs.collect()}
    begun = time.monotonic()
    rows = pii.detected(docs).collect()
    masked = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert time.monotonic() - begun < 60
    assert_base(rows, texts)
    assert {r.doc_id: (r.n_email, r.n_phone) for r in rows} == {1: (30_000, 30_000), 2: (257, 0), 3: (1, 0)}
    assert masked[1] == "; ".join(f"Büro {k}: call [PHONE], mail [EMAIL] 𝒜" for k in range(30_000))
    assert masked[2] == "[EMAIL], " * 257
    assert masked[3] == "x" * 256 + " [EMAIL]"
    scores = {s.split(":")[-1] for r in rows if r.doc_id == 1 for s in r.scored_spans.split(",")}
    assert scores == {"1.00"}  # the words before each span count, right to the last one
