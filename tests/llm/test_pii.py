"""Spans equal Python's regular expressions with the same checks."""

import hashlib
import random
import re

import pytest
from cases import ALL_IDS, documents, ids
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def holds(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    return kind == "email" or (9 <= len(digits) <= 15 if kind == "phone" else 13 <= len(digits) <= 19 and luhn(digits))


def plain(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "") if holds(k, m[0])]


TEXTS = [
    "a@b.c_x@y.z.. é1.2.3.4.5.6.7.8 999.1.1.1 4111 1111 1111 1111 +1 (234) 567-8901-",
    "x" * 3000 + "@a.b", "1 " * 50 + "\U0001f600 4111-1111-1111-1111", "00255.1.1.1 0256.1.1.1 1.2.3", "@@a@b.@c.d a@b..c a@-.-", "+1 +22222222222222222 +123456789 +12345678", "5500005555555559x5500 0055 5555 5559", "", None,
]


def random_texts(n):
    rnd = random.Random(4)
    return ["".join(rnd.choice(["a", "@", ".", "1", "23", "456", " ", "-", "+", "(", ")", "é", "4111111111111111", "b.c", "_"]) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


def test_equal_to_python(spark, small):
    texts = TEXTS + random_texts(1500) + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = pii.digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in got:
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in want) for k in PLAIN]
        assert set(want) <= set(r.spans.split(",")) or not want


def test_checksums(spark):
    df = spark.createDataFrame([("GB82 WEST 1234 5698 7654 32", True), ("DE89370400440532013000", True), ("DE88370400440532013000", False)], "x string, want boolean")
    assert all(r.got == r.want for r in df.select("want", pii.mod97(F.col("x")).alias("got")).collect())


@given(st.text("0123456789", min_size=13, max_size=19))
def test_luhn_model(digits):
    check = next(d for d in "0123456789" if luhn(digits + d))
    assert sum(luhn(digits + d) for d in "0123456789") == 1 and luhn(digits + check)


def test_context_raises_the_score(spark):
    texts = [(1, "call me: +420 123 456 789"), (2, "xxxxxxx: +420 123 456 789"), (3, "IBAN DE89370400440532013000.")]
    got = {r.doc_id: (r.spans, r.scores) for r in pii.digests(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {1: ("phone:9:25", "0.7"), 2: ("phone:9:25", "0.5"), 3: ("iban:5:27", "1.1")}


def test_account_numbers_before_other_words(spark):
    de, gb = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    texts = [f"Pay {de} Please", f"Pay {gb} I paid", f"Pay {gb} 5 days", f"Pay {de} {gb} NOW", f"Pay {de}x", f"Pay {gb}9", f"Pay {gb[:-1]}3 Please", f"{de} PLEASE PAY THE 12 BILLS OF 2024 AT ONCE", "XX" + "89370400440532013000 Please"]
    got = {r.doc_id: r.spans for r in pii.digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    accounts = {i: [x for x in s.split(",") if x.startswith("iban")] for i, s in got.items()}
    assert accounts == {0: ["iban:4:26"], 1: ["iban:4:31"], 2: ["iban:4:31"], 3: ["iban:4:26", "iban:27:54"], 4: [], 5: [], 6: [], 7: ["iban:0:22"], 8: []}
    text = pii.redacted(spark.createDataFrame([(1, texts[3])], "doc_id long, text string")).first().text
    assert text == "Pay [IBAN] [IBAN] NOW"


def test_redaction(spark):
    docs = documents(spark, [(1, "Mail me@x-y.co.uk or 4111 1111 1111 1111.", "en", "a", 9), (2, None, None, None, None), (3, "", "en", "a", 0), (4, "\U0001f600 1.2.3.4 end", "en", "a", 3)])
    out = pii.redacted(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {1: ("Mail [EMAIL] or [CARD].", 23), 2: (None, None), 3: ("", 0), 4: ("\U0001f600 [IP] end", 10)}


def plain_redacted(text, found):
    at, out = 0, ""
    for s, e, kind in sorted(found):
        if s >= at:
            out += text[at:s] + f"[{kind.upper()}]"
        at = max(at, e)
    return out + text[at:]


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_redaction_by_blocks_equals_plain(spark, monkeypatch, block):
    monkeypatch.setattr(pii, "BLOCK", block)
    rnd = random.Random(block)
    pieces = ["me@x.org", "1.2.3.4", "+420 123 456 789", "4111 1111 1111 1111", "DE89370400440532013000", "\U0001f600", "é ", "\n", "word ", ", ", "mail ", "call ", "7"]
    rows = [(i, "".join(rnd.choice(pieces) + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 60)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [(x.s, x.e, x.kind) for k in pii.PATTERNS for x in r[k]] for r in pii.spans(docs).collect()}
    assert {r.doc_id: r.text for r in pii.redacted(docs, 0.0).collect()} == {i: plain_redacted(t, found[i]) for i, t in rows}
    assert sum(map(len, found.values())) > 500


def test_redaction_of_many_spans_is_quick(spark):
    import time

    text = "call 1.2.3.4 or write to me@x.org now\n" * 10_000
    start = time.time()
    out = pii.redacted(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().text
    assert out == "call [IP] or write to [EMAIL] now\n" * 10_000 and time.time() - start < 60


def test_no_python_in_the_plan(spark, capsys):
    pii.digests(documents(spark)).explain()
    assert "Python" not in (said := capsys.readouterr().out) and "Arrow" not in said


def test_awkward_rows(spark):
    got = pii.digests(documents(spark)).collect()
    assert ids(got) == ALL_IDS
    assert all(r.spans == "" for r in got)
    assert pii.digests(documents(spark, [])).isEmpty()


def test_long_runs_are_linear(spark):
    texts = [(1, "a" * 400_000), (2, "1" * 400_000), (3, "1." * 150_000), (4, "a@" + "b." * 150_000), (5, "+1" + " " * 400_000), (6, "1 " * 200_000)]
    got = {r.doc_id: r for r in pii.digests(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got[4].n_email == 1 and got[3].n_ip == 37_500
    assert got[3].spans == ",".join(f"ip:{at}:{at + 7}" for at in range(0, 300_000, 8))  # placed in many parts
