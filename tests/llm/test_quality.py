"""Quality rules against plain counts; the classifier's score against its formula and on held-out labels."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import ALL_IDS, documents, ids
from pyspark.sql import functions as F

from sluice.llm import quality_classifier as qc
from sluice.llm import quality_rules as qr

WORD = r"[^\x20\x09-\x0D]+"


def plain_counts(text):
    w = re.findall(WORD, text or "")
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_plain(spark, tiny):
    rnd = random.Random(2)
    texts = [r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()] + ["".join(rnd.choice(["a ", "b ", "c\n", "#", "é ", "\x0b", "\x85", "\xa0"]) for _ in range(rnd.randint(0, 80))) for _ in range(400)] + ["a b " * 5000, ""]
    for t in texts:
        assert qr.counts(t.encode())[:5] == plain_counts(t)


def test_thresholds_adapt(spark):
    rnd = random.Random(1)
    clean = lambda n, mark: " ".join(f"w{rnd.randint(0, 10**6)}{mark if rnd.random() < 0.5 else ''}" for _ in range(n))
    rows = [(i, clean(60, "#"), "en", "marked", 1) for i in range(200)] + [(1000 + i, clean(60, ""), "en", "plain", 1) for i in range(200)]
    rows += [(5000, clean(60, "#"), "en", "plain", 1), (5001, clean(60, "#"), "en", "marked", 1), (5002, clean(60, ""), "en", "rare", 1)]
    got = {r.doc_id: r for r in qr.judged(documents(spark, rows)).collect()}
    assert not got[5000].kept and got[5000].failed == ["symbol_ratio"] and got[5001].kept and got[5002].kept
    assert sum(r.kept for r in got.values()) >= 395


def plain_kept(spark, rows, least_rows):
    """Thresholds from exact groups: rows of doc_id, text, lang, source."""
    ratios = {}
    for i, text, lang, source in rows:
        n, chars, symbols, dup, repeat, lines, capitals, stutters = qr.counts((text or "").encode())
        over = lambda a, b: a / b if b else 0.0
        ratios[i] = (lang, source, [over(symbols, chars), over(capitals, chars), over(repeat, n), over(dup, lines), over(stutters, n), over(chars, n)], n < 20 or 100 * repeat > 30 * n)
    def quartiles(values):
        v = sorted(values)
        rank = lambda q: v[max(0, -(-int(q * 4) * len(v) // 4) - 1)]  # the inclusive rank of a sketch that holds all values
        return rank(0.25), rank(0.75)
    out = {}
    for i, (lang, source, x, base) in ratios.items():
        own = [r for r in ratios.values() if r[:2] == (lang, source)]
        same = [r for r in ratios.values() if r[0] == lang]
        group = own if len(own) >= least_rows else same if len(same) >= least_rows else list(ratios.values())
        good = not base
        for k, rule in enumerate(qr.RULES):
            low, high = quartiles([r[2][k] for r in group])
            spread = max(high - low, rule.floor)
            good &= not (rule.lower and x[k] < low - rule.reach * spread) and not (rule.upper and x[k] > high + rule.reach * spread)
        out[i] = good
    return out


def test_kept_equals_exact_thresholds(spark, tiny):
    """Up to 200 values a sketch holds them all, so its quantiles are exact."""
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text", "lang", F.concat(F.lit("s"), F.col("doc_id") % 3).alias("source"))
    rows = [tuple(r) for r in docs.collect()]
    assert len(rows) <= 200
    for least_rows in (20, 60):
        got = {r.doc_id: r.kept for r in qr.judged(docs, least_rows=least_rows).collect()}
        assert got == plain_kept(spark, rows, least_rows) and len(set(got.values())) == 2


def test_repeated_windows_need_equal_words():
    w = [b"a", b"b", b"c", b"d", b"e", b"f", b"g", b"h"]
    assert qr.repeated_words(w * 10 + [b"z"] * 3) == 80


def test_shares_stay_positive_at_any_size():
    from sluice.llm.common import STEPS, share_of

    for n in (10**4, 10**11, 10**15):
        for sample in (1600, 12_000):
            assert abs(n * share_of(sample, n) / STEPS - min(sample, n)) < 0.01 * sample


def test_rules_on_awkward_rows(spark):
    docs = documents(spark)
    got = qr.judged(docs).collect()
    assert ids(got) == ALL_IDS
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.kept and r.base_failed)
    by = {r.doc_id: r for r in got}
    assert (by[3].n_words, by[4].n_words, by[5].n_words) == (0, 0, 0) and by[6].n_repeat_words == 60_000
    assert qr.judged(documents(spark, [])).isEmpty()


def test_pairs_in_linear_time():
    rng = np.random.default_rng(1)
    m = qc.Machine(0.3, rng.normal(size=qc.SIZE).astype(np.float32), rng.normal(size=(qc.SIZE, qc.FACTORS)).astype(np.float32))
    ids_, x = np.array([3, 70, 500, 501]), np.array([0.5, 1, 0.25, 0.1], np.float32)
    z = m.w0 + sum(m.w[i] * v for i, v in zip(ids_, x, strict=True)) + sum(float(m.v[ids_[a]] @ m.v[ids_[b]]) * x[a] * x[b] for a in range(4) for b in range(a + 1, 4))
    assert m.score(ids_, x) == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-4)


def test_held_out_quality(spark, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    got = qc.scores(docs, qc.learn(docs, labels))
    known = got.filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in known]) > 0.95
    assert np.mean([r.predicted for r in known if r.quality == 1]) > 0.95


def test_classifier_on_awkward_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (5, None, 0), (None, 1, 1), (6, 0, None), (99, 1, 0)], "doc_id long, quality int, toxic int")
    m = qc.learn(docs, labels)
    got = qc.scores(docs, m).collect()
    assert ids(got) == ALL_IDS and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    none = qc.learn(docs, labels.limit(0))
    assert {r.score for r in qc.scores(docs, none).collect()} == {0.5}
    kept = qc.kept(docs, none)
    assert kept.columns == docs.columns and ids(kept.collect()) == ALL_IDS
    assert qc.scores(documents(spark, []), none).isEmpty()
