"""Learning samples stay within their bounds whatever the ids; letter models equal plain Kneser-Ney; hostile lines."""

import math
from collections import Counter

import numpy as np
import pytest
from cases import documents
from pyspark.sql import functions as F

from sluice.llm import language_id as li
from sluice.llm import license_scan
from sluice.llm import quality_classifier as qc


def corpus(spark, doc_id):
    n = 6000
    english = spark.range(n).select(F.expr(doc_id).alias("doc_id"), F.concat(F.lit("the house and the garden number "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    german = spark.range(300).select((F.col("id") + 10**6).alias("doc_id"), F.concat(F.lit("das Haus und der Garten mit der Nummer "), F.col("id").cast("string")).alias("text"), F.lit("de").alias("lang"))
    return english.unionByName(german)


@pytest.mark.parametrize("doc_id", ["7L", "cast(null as long)", "id"], ids=["one id", "null ids", "own ids"])
def test_language_sample_is_drawn_among_texts(spark, doc_id, monkeypatch):
    taken = []
    plain = li.kneser_ney
    monkeypatch.setattr(li, "kneser_ney", lambda codes, counts, languages: taken.append((counts.sum(0), languages)) or plain(codes, counts, languages))
    model = li.learn(corpus(spark, doc_id), sample=400)
    assert model.languages == ["de", "en"]
    grams = taken[0][0][1]
    assert 200 * 30 < grams < 500 * 45  # three quarters of some 400 texts of some 36 symbols
    said = li.predicted(documents(spark, [(1, "the garden", None, "a", 1), (2, "der Garten", None, "a", 1)]), model).collect()
    assert {r.doc_id: r.lang_pred for r in said} == {1: "en", 2: "de"}


def test_rows_repeated_as_a_whole_count_once(spark, monkeypatch):
    taken = []
    plain = li.kneser_ney
    monkeypatch.setattr(li, "kneser_ney", lambda codes, counts, languages: taken.append(counts.sum(0)) or plain(codes, counts, languages))
    li.learn(spark.range(5000).select(F.lit(1).alias("doc_id"), F.lit("one and the same").alias("text"), F.lit("en").alias("lang")), sample=100)
    assert taken[0][0] == len(li.grams(b"one and the same"))


def test_repeated_ids_of_labelled_rows(spark):
    docs = spark.range(3000).select(F.lit(2).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(2, 1)], "doc_id long, quality int")
    seen = []
    plain = qc.train
    qc.train = lambda rows, *a, **b: seen.append(len(rows)) or plain(rows, *a, **b)
    try:
        qc.learn(docs, labels)
    finally:
        qc.train = plain
    assert seen in ([1], [0])


def test_letter_models_equal_plain_kneser_ney():
    texts = {"en": ["the cat sat on the mat", "a dog and a cat", "the end"], "de": ["die katze sitzt auf der matte", "ein hund und eine katze"]}
    languages = sorted(texts)
    symbols = lambda g: tuple(int(g) >> 16 * i & 0xFFFF for i in reversed(range(li.ORDER)))
    own = {k: Counter(int(g) for t in texts[k] for g in li.grams(t.encode())) for k in languages}
    codes = np.array(sorted(set().union(*own.values())), np.uint64)
    model = li.kneser_ney(codes, np.array([[own[k][int(c)] for k in languages] for c in codes], float), languages)
    levels = {}
    for k in languages:
        level = Counter({symbols(g): n for g, n in own[k].items()})
        levels[k] = [level]
        for _ in range(li.ORDER - 1):
            level = Counter(g[1:] for g in level)
            levels[k].insert(0, level)
    n_symbols = len(set().union(*(levels[k][0] for k in languages))) + 1

    def parts(k, n):
        c = levels[k][n - 1]
        once, twice = (sum(x == v for x in c.values()) for v in (1, 2))
        return c, min(max(once / max(once + 2 * twice, 1), 0.1), 0.95)

    def probability(k, gram):
        n = len(gram)
        if not n:
            return 1 / n_symbols
        c, d = parts(k, n)
        same = {g: x for g, x in c.items() if g[:-1] == gram[:-1]}
        total = sum(same.values())
        return probability(k, gram[1:]) if not total else max(c[gram] - d, 0) / total + d * len(same) / total * probability(k, gram[1:])

    # a symbol that no language knows has the least of the languages' probabilities
    known = {g[-1] for k in languages for g in levels[k][0]}
    floor = min(probability(k, (0xFFFF,)) for k in languages)
    for text in ("the mat", "eine matte", "zebra xyz", "katze cat"):
        g = li.grams(text.encode())
        for k, h in zip(languages, model.entropies(g), strict=True):
            want = 0.0
            for gram in map(symbols, g):
                if gram[-1] in known:
                    want -= math.log(probability(k, gram))
                else:
                    weight = 1.0
                    for n in range(li.ORDER, 1, -1):
                        c, d = parts(k, n)
                        same = [x for q, x in c.items() if q[:-1] == gram[-n:-1]]
                        weight *= d * len(same) / sum(same) if same else 1.0
                    want -= math.log(weight * floor)
            assert math.isclose(h * len(g), want, rel_tol=1e-5), (text, k)


@pytest.mark.parametrize("text", ["Copyright " + "Ab " * 333_333, "Copyright " + "A" * 999_990, "Copyright Ab Cd\n" * 62_500], ids=["names", "capitals", "lines"])
def test_long_copyright_lines(spark, text):
    rows = spark.createDataFrame([(1, f"{text}\nSPDX-License-Identifier: MIT")], "doc_id long, text string")
    got = license_scan.scanned(rows, license_scan.known_texts(spark), license_scan.long_texts(spark)).collect()
    assert got[0].notices == "MIT"
