"""Language models: probabilities sum to one, counts equal plain ones, held-out texts are known."""

import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from cases import ALL_IDS, documents, ids

from sluice.llm import language_id as li
from sluice.llm import lm_scoring as lm

WORD = r"[^\x20\x09-\x0D]+"


def split(text):
    return [*re.findall(WORD, "".join(c.lower() if c.isascii() else c for c in text or "")), None]


def plain_base(docs):
    out = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2
    c = Counter(w for i, t in docs if not out(i) for w in split(t))
    n, v = sum(c.values()), len(c)
    return n, [(i, len(split(t)), sum(c[w] > 0 for w in split(t)), sum(math.log10((c[w] + 1) / (n + v + 1)) for w in split(t)), out(i)) for i, t in docs]


def scored(docs, **settings):
    model = lm.learn(docs.filter(~lm.held_out(docs)), **settings)
    got = lm.scored(docs, model)
    return model, got.withColumn("held_out", lm.held_out(got)).collect()


def same_base(got, docs):
    n, want = plain_base(docs)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    for r, w in zip(sorted(((x.doc_id, x.n_tokens, x.n_known, x.base_score, x.held_out) for x in got), key=key), sorted(want, key=key), strict=True):
        assert r[:3] == w[:3] and r[4] == w[4] and math.isclose(r[3], w[3], rel_tol=1e-9)
    assert {x.train_tokens for x in got} <= {n}


def test_base_equals_plain_with_rare_words(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    model, got = scored(docs, head_words=300)
    assert 0 < len(model.head) <= 300
    same_base(got, [(r.doc_id, r.text) for r in docs.collect()])


def plain_scores(model, docs):
    """The score of each text by its definition, one token at a time."""
    v, p = model.vocabulary, model.parameters
    counts = {bytes(r.w): r.c for r in model.counts.collect()}
    vector = lambda row: p.table[row, :-1].astype(float)
    out = []
    for _, text in docs:
        rows, total = [], 0.0
        for w in [*(x.encode() for x in split(text)[:-1]), None]:
            row = v.end if w is None else v.row.get(w, v.rest + zlib.crc32(w[:3]) % lm.CLASSES)
            q = sum((vector(rows[-i - 1] if i < len(rows) else v.start) * p.position[i] for i in range(lm.CONTEXT)), np.zeros(lm.WIDTH))
            if rows:
                q = q + np.mean([vector(r) for r in rows[-lm.MEMORY :]], 0) * p.position[lm.CONTEXT]
            score = lambda r, q=q: vector(r) @ q + p.table[r, -1]
            share = lambda r, among, score=score: score(r) - np.log(sum(math.exp(score(x)) for x in among))
            k = v.class_of[row]
            total += share(row if k < 0 else v.classes + k, range(v.n_first))
            if k >= 0:
                total += share(row, np.flatnonzero(v.class_of == k))
            if w is not None and w not in v.row:
                c = counts.get(w, 0)
                kinds = sum(x not in v.row and lm.word_class(x) == k for x in counts if x)
                if model.rest[k]:
                    total += math.log((c - model.discount if c else model.discount * kinds) / model.rest[k])
            rows.append(row)
        out.append(total / math.log(10))
    return out


def test_score_equals_plain(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").filter("length(text) < 500")
    model = lm.learn(docs.filter(~lm.held_out(docs)), head_words=200)
    some = sorted((r.doc_id, r.text) for r in docs.collect())[:12] + [(-1, ""), (-2, None), (-3, "neverseen words ofcourse the the")]
    got = {r.doc_id: r.score for r in lm.scored(documents(spark, [(i, t, None, None, 0) for i, t in some]), model).collect()}
    for (i, _), want in zip(some, plain_scores(model, some), strict=True):
        assert math.isclose(got[i], want, rel_tol=1e-4)


def test_scores_do_not_depend_on_partitions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    ways = [docs, docs.repartition(8), docs.repartition(3, "source").sortWithinPartitions("text")]
    scores = []
    for way in ways:
        _, got = scored(way, shard_tokens=100_000)
        scores.append({r.doc_id: r.score for r in got})
    for other in scores[1:]:
        assert other.keys() == scores[0].keys()
        assert max(abs(other[i] / scores[0][i] - 1) for i in other) < 1e-6


def test_model_beats_counts_on_held_out(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model, got = scored(docs)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.95 * sum(r.base_score for r in held)
    fewer, _ = scored(docs.filter("doc_id % 4 = 0"))
    assert model.vocabulary.n_rows > 1.5 * fewer.vocabulary.n_rows - 600  # words with vectors grow with the corpus


def a_vocabulary(n=3000):
    return lm.Vocabulary([(b"w%d" % i, n - i + 4) for i in range(n)], 50, np.full(lm.CLASSES, 7.0))


def test_probabilities_sum_to_one():
    v = a_vocabulary()
    p = lm.Parameters.fresh(v)
    p.table += np.random.default_rng(3).normal(0, 0.5, p.table.shape).astype(np.float32)
    start = [v.row[b"w7"], v.rest + 3, v.row[b"w2000"]]
    # every word and every rest, each after the same words; END alone of the other rows ends a text
    symbols = [r for r in range(v.n_rows) if r != v.start and not v.classes <= r < v.n_first]
    total = 0.0
    for r in symbols:
        lp = lm.log_probabilities(v, p, lm.Line([np.array([*start, r])], v.start))
        total += math.exp(lp[-1])
    assert math.isclose(total, 1, rel_tol=1e-4)
    # a class's rest is shared by its words and the unseen one
    counts, discount = np.array([5, 1, 1]), 0.6
    assert math.isclose(((counts - discount).sum() + discount * len(counts)) / counts.sum(), 1)


def test_blocks_do_not_change_probabilities():
    v = a_vocabulary(400)
    p = lm.Parameters.fresh(v)
    rng = np.random.default_rng(2)
    texts = [np.append(rng.choice(list(v.row.values()), n), v.end) for n in (0, 1, 3, 70, 300)]
    whole = lm.log_probabilities(v, p, lm.Line(texts, v.start))
    assert np.allclose(whole, lm.log_probabilities(v, p, lm.Line(texts, v.start), block=37), rtol=1e-5)
    assert np.allclose(whole, np.concatenate([lm.log_probabilities(v, p, lm.Line([t], v.start)) for t in texts]), rtol=1e-5)


def plain_log_probabilities(v, p, line):
    """Sums down the columns of float64 rows, powers of e, biases added apart, classes in blocks of 2 million scores."""
    vectors, bias = np.ascontiguousarray(p.table[:, : lm.WIDTH]), np.ascontiguousarray(p.table[:, lm.WIDTH])
    at, row = np.arange(len(line.target)), line.target
    sums = np.zeros((len(row) + 1, lm.WIDTH))
    np.cumsum(vectors[row], axis=0, out=sums[1:])
    mean = ((sums[at] - sums[at - line.back]) / np.maximum(line.back, 1)[:, None]).astype(np.float32)
    q = sum(x * p.position[i] for i, x in enumerate([*(vectors[c] for c in line.contexts), mean]))

    def normalised(q, rows, target):
        s = q @ vectors[rows].T
        s += bias[rows]
        true = s[np.arange(len(s)), target]
        return true - np.log(np.exp(s, out=s) @ np.ones(s.shape[1], np.float32))

    kind, out = v.class_of[row], np.empty(len(row))
    target = np.where(kind < 0, row, v.classes + kind)
    for i in range(0, len(row), 512):
        out[i : i + 512] = normalised(q[i : i + 512], slice(0, v.n_first), target[i : i + 512])
    for k in range(lm.CLASSES):
        members, here = v.order[v.bounds[k] : v.bounds[k + 1]], np.flatnonzero(kind == k)
        if len(here):
            out[here] += normalised(q[here], members, np.searchsorted(members, row[here]))
    return out


def test_probabilities_cost_less_than_plain_ones():
    v = a_vocabulary(30_000)
    p = lm.Parameters.fresh(v)
    rng = np.random.default_rng(4)
    line = lm.Line([np.append(rng.choice(list(v.row.values()), 400), v.end) for _ in range(300)], v.start)

    def seconds(f):
        start = time.process_time()
        f(v, p, line)
        return time.process_time() - start

    assert np.allclose(lm.log_probabilities(v, p, line), plain_log_probabilities(v, p, line), rtol=1e-5)
    ours, theirs = (min(seconds(f) for _ in range(5)) for f in (lm.log_probabilities, plain_log_probabilities))
    assert ours < 0.7 * theirs


SPACED = ["", None, "  ", " A b\x0b\x0ca\tB \r\n", "one", "x\x1cy \x85 É é\xa0Z", "a" * 70_000, "ſ İ 日本 a", "b"]


def test_words_of_a_part_equal_plain():
    got = lm.Words(lm._pieces(pa.array(SPACED)))
    want = [[w.encode() for w in split(t)[:-1]] for t in SPACED]
    assert got.sizes.tolist() == [len(w) for w in want]
    lines = got.ended(np.arange(len(got.different)), -1)
    assert [[got.different[i] for i in line[:-1]] for line in lines] == want and all(line[-1] == -1 for line in lines)


def test_counts_in_tasks_equal_plain(monkeypatch):
    monkeypatch.setattr(lm, "HELD_WORDS", 3)
    rng = np.random.default_rng(1)
    texts = [*SPACED, *(" ".join(f"w{i}" for i in rng.integers(0, 40, 9)) for _ in range(2000))]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 700])], ["text"]) for i in range(0, len(texts), 700)]
    found, want = Counter(), Counter(w.encode() if w is not None else b"" for t in texts for w in split(t))
    for b in lm._counted(iter(batches)):
        for w, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            found[w] += c
    assert found == want


def test_noise_contrast_learns():
    rng = np.random.default_rng(0)
    v = lm.Vocabulary([(b"w%d" % i, 1000) for i in range(lm.OWN_WORDS + 200)], 40, np.zeros(lm.CLASSES))
    names = [v.row[b"w0"], v.row[b"w1"], *(v.row[b"w%d" % i] for i in range(lm.OWN_WORDS, lm.OWN_WORDS + 6))]
    line, at = [], 0
    for _ in range(60_000):
        at = (at + 1) % 8 if rng.random() < 0.9 else int(rng.integers(0, 8))
        line.append(names[at])
    texts = [np.array([*line[i : i + 99], v.end]) for i in range(0, len(line), 99)]
    t = lm.Trainer(v, lm.Parameters.fresh(v), 1)
    for _ in range(3):
        t.learn(texts)
    before = lm.log_probabilities(v, lm.Parameters.fresh(v), lm.Line(texts[:50], v.start)).mean()
    # better than to know the eight words alone
    assert lm.log_probabilities(v, t.p, lm.Line(texts[:50], v.start)).mean() > -math.log(8) > before


def test_lm_awkward_rows(spark):
    docs = documents(spark)
    _, got = scored(docs, head_words=10)
    assert ids(got) == ALL_IDS and all(r.score <= 0 and math.isfinite(r.score) for r in got)
    same_base(got, [(r.doc_id, r.text) for r in docs.collect()])
    empty = lm.learn(docs.limit(0))
    assert {r.base_score for r in lm.scored(docs, empty).collect()} == {0.0}
    assert lm.scored(documents(spark, []), empty).isEmpty()


def test_end_outside_the_head_is_known(spark):
    many = " ".join(f"{w} {w}" for w in map(str, range(40)))
    docs = documents(spark, [(2, many, "en", "a", 1), (1, "3 4 unseen", "en", "a", 1)])
    model, got = scored(docs, head_words=20)
    assert lm.END_WORD not in model.head
    same_base(got, [(2, many), (1, "3 4 unseen")])


def test_kneser_ney_sums_to_one():
    texts = [b"the cat sat on the mat", b"a dog ate the cat", "le chat est sur l'été".encode()]
    g = [li.grams(t) for t in texts]
    codes = np.unique(np.concatenate(g))
    counts = np.stack([np.isin(codes, np.concatenate(x)).astype(float) for x in (g[:2], g[2:])], 1)
    m = li.kneser_ney(codes, counts, ["en", "fr"])
    letters = [int(x) for x in np.unique(codes & np.uint64(0xFFFF))]
    for context in [int(c) >> 16 for c in codes[:25]]:
        for k in range(2):
            total = sum(math.exp(-m.entropies(np.array([context << 16 | x], np.uint64))[k]) for x in letters)
            assert 0.9 < total <= 1.0001


def test_grams():
    assert len(li.grams(b"123 !")) == 0
    a, b = li.grams("Été  -- x".encode()), li.grams("été x".encode())
    assert a.tolist() == b.tolist() and len(a) == 6 or a[1:].tolist() == b[1:].tolist()


def test_held_out_languages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = li.predicted(docs, li.learn(docs.filter(~li.held_out(docs))))
    rows = got.withColumn("out", li.held_out(got)).filter("out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_awkward_rows(spark):
    docs = documents(spark)
    m = li.learn(docs)
    assert m.languages == ["de", "en", "fr"]
    got = li.predicted(docs, m).collect()
    assert ids(got) == ALL_IDS
    by = {r.doc_id: r for r in got}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (3, 4, 5, 9))
    assert all(by[i].lang_pred in m.languages for i in (1, 6, 7, 8))
    none = li.learn(docs.limit(0))
    assert none is None and {r.lang_pred for r in li.predicted(docs, none).collect()} == {"und"}
    assert li.predicted(documents(spark, []), m).isEmpty()
