"""Components equal those of all pairs; codewords and keys keep their promises."""

import random

import numpy as np
import pytest
import xxhash
from cases import ALL_IDS, documents, ids
from pyspark.sql import functions as F

from sluice.llm import simhash


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if grams and 2 * sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) > len(grams))


def plain_components(prints):
    """{id: smallest id within reach} over links of at most four bits."""
    out = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 4 and out[b] < out[a]:
                    out[a], changed = out[b], True
    return out


def test_fingerprint_and_xxhash_agree_with_spark(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] == np.uint64(xxhash.xxh64_intdigest(b"a b c d", 42)).astype(np.int64)
    for t in ("", "one", "One two three four five six", "a b c d " * 50_000):
        assert simhash.fingerprint(t.encode()) == plain_fingerprint(t) or len(t) > 10_000
    assert simhash.fingerprint(b"a b c d " * 40_000) == plain_fingerprint("a b c d " * 40_000)


def test_close_segments_share_a_codeword():
    rnd = random.Random(1)
    x = np.array([rnd.getrandbits(23) for _ in range(2000)], np.int64)
    flips = np.array([sum(1 << b for b in rnd.sample(range(23), rnd.randint(0, 2))) for _ in x], np.int64)
    a, b = simhash.codewords(x), simhash.codewords(x ^ flips)
    assert all(set(p[p >= 0]) & set(q[q >= 0]) for p, q in zip(a, b, strict=True))
    assert {int((p >= 0).sum()) for p in a} == {1, 6}


@pytest.mark.parametrize("errors", [1, 2, 3, 4])
def test_keys_meet_within_four_bits(errors):
    rnd = random.Random(errors)
    f = np.array([rnd.getrandbits(64) for _ in range(1500)], np.uint64)
    g = np.array([int(x) ^ sum(1 << b for b in rnd.sample(range(64), errors)) for x in f], np.uint64)
    left, right = simhash.keys(f.view(np.int64)), simhash.keys(g.view(np.int64))
    assert all(set(p[p >= 0]) & set(q[q >= 0]) for p, q in zip(left, right, strict=True))


def test_keys_are_wide():
    for a in simhash.HALVES:
        assert sum(w for _, w in a) in (21, 22)
    # bits of a key besides its kind: a segment or two halves as they are, and a codeword's twelve
    assert min(a[1] + b[1] + 12 for _, a, b in simhash._HALVES) >= 32 and len(simhash._HALVES) == 12
    k = simhash.keys(np.array([random.Random(5).getrandbits(63) for _ in range(500)], np.int64))
    assert (k >= 0).sum(1).max() <= 108 and (k >= 0).sum(1).min() >= 18


def prints_frame(spark, prints):
    return spark.createDataFrame([(i, int(np.uint64(f).astype(np.int64))) for i, f in prints.items()], "doc_id long, f long")


def test_links_equal_all_pairs(spark):
    rnd = random.Random(9)
    base = [rnd.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    every = {b ^ sum(1 << x for x in rnd.sample(range(64), rnd.randint(0, 5))) for b in base for _ in range(12)}
    prints = dict(enumerate(every))
    got = {frozenset((np.int64(r.a).astype(np.uint64).item(), np.int64(r.b).astype(np.uint64).item())) for r in simhash.links(prints_frame(spark, prints)).collect()}
    assert got == {frozenset((a, b)) for a in every for b in every if a != b and (a ^ b).bit_count() <= 4}


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)] + [(200, 201)]
    random.Random(3).shuffle(edges)
    got = {r.node: r.component for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 120), 100), 200: 200, 201: 200}
    assert simhash.components(spark.createDataFrame([], "u long, v long")).isEmpty()


def test_whole_table_equals_all_pairs(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    got = {r.doc_id: r for r in simhash.groups(docs).collect()}
    prints = {r.doc_id: plain_fingerprint(r.text) for r in docs.collect()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == plain_components(prints)


def test_awkward_rows(spark):
    got = simhash.groups(documents(spark)).collect()
    assert ids(got) == ALL_IDS
    by = {r.doc_id: r for r in got if r.doc_id}
    assert by[1].component_id == by[2].component_id == 1
    assert by[3].fingerprint == "0" * 16 and by[3].component_id == by[4].component_id == by[5].component_id == 3
    assert simhash.groups(documents(spark, [])).isEmpty()


def test_deduplicated_keeps_one_of_each(spark):
    docs = documents(spark)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert ids(kept.collect()) == [1, 3, 6, 7, 8, 9, None, None]
    twice = documents(spark, [(1, "a b c", "en", "a", 1), (1, "a b c", "en", "a", 1)])
    assert simhash.deduplicated(twice).count() == 1


def mixed(seed, n, words, low, high):
    """Copies of one text with a few words changed in each."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rnd.randint(low, high)):
            own[rnd.randrange(words)] = f"x{rnd.randint(0, 10**9)}"
        out.append(" ".join(own))
    return out


def plain_groups(texts):
    """Number of groups by all pairs."""
    sets = [frozenset(simhash.shingles(t.encode()).tolist()) for t in texts]
    of = list(range(len(texts)))

    def top(i):
        while of[i] != i:
            i = of[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if top(i) != top(j) and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                of[top(i)] = top(j)
    return len({top(i) for i in range(len(texts))})


@pytest.mark.parametrize(("words", "low", "high", "least"), [(100, 1, 3, 0.985), (200, 2, 5, 0.96), (100, 1, 2, 0.995)])
def test_large_mixed_groups(spark, words, low, high, least):
    texts = mixed(1, 1200, words, low, high)
    got = simhash.similar_groups(documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])).collect()
    removed, by_all = len(texts) - len({r.component_id for r in got}), len(texts) - plain_groups(texts)
    print("removed", removed, "of", by_all)
    assert least * by_all <= removed <= by_all


@pytest.mark.parametrize("order_texts", [0, simhash.ORDER_TEXTS])
def test_mixed_groups_equal_all_pairs(spark, monkeypatch, order_texts):
    monkeypatch.setattr(simhash, "BLOCK", 64)
    common = simhash.common_shingles
    monkeypatch.setattr(simhash, "common_shingles", lambda docs: common(docs, order_texts))
    texts = mixed(1, 600, 100, 1, 3) + mixed(2, 600, 200, 2, 5) + mixed(3, 40, 12, 1, 2) + mixed(4, 40, 5, 0, 1)
    got = simhash.similar_groups(documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])).collect()
    assert len({r.component_id for r in got}) == plain_groups(texts)


def test_prefixes_of_similar_sets_meet():
    rnd, common = np.random.default_rng(4), np.arange(0, 400, 3, dtype=np.uint64)
    ranks, met = rnd.permutation(len(common)) + 1, 0
    for _ in range(3000):
        a = rnd.choice(400, rnd.integers(1, 40), replace=False).astype(np.uint64)
        b = np.unique(np.append(rnd.permutation(a)[: max(1, len(a) - rnd.integers(0, 6))], rnd.integers(0, 400, rnd.integers(0, 5)).astype(np.uint64)))
        if len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)):
            met += 1
            assert set(simhash.prefix(np.sort(a), common, ranks)) & set(simhash.prefix(b, common, ranks))
    assert met > 300


def test_one_id_with_very_many_texts(spark):
    rows = [(7, f"text number {i} of one id with words {i * 31} and {i * 17} and more", "en", "a", 1) for i in range(1500)] + [(8, "text number 3 of one id with words 93 and 51 and more", "en", "a", 1), (9, "quite another text that nothing here is like in any way", "en", "a", 1)]
    got = {(r.doc_id, r.component_id) for r in simhash.similar_groups(documents(spark, rows)).collect()}
    assert got == {(7, 7), (8, 7), (9, 9)}


def test_parities_never_differ_in_more_bits_than_sets_in_shingles():
    rnd = np.random.default_rng(5)
    for size in (1, 3, 40, 300, 5000):
        a = np.unique(rnd.integers(0, 1 << 63, size, dtype=np.uint64))
        for kept in (0, size // 2, size - 1, size):
            b = np.unique(np.append(a[:kept], rnd.integers(0, 1 << 63, size // 4, dtype=np.uint64)))
            differing = int(np.bitwise_count((simhash.parities(a) ^ simhash.parities(b)).view(np.uint64)).sum())
            assert differing <= len(np.setxor1d(a, b))
    assert not simhash.parities(np.zeros(0, np.uint64)).any()


def test_texts_that_share_rare_shingles_only_do_not_meet(spark):
    """Before, 12 shared shingles among the first were enough for all pairs of these to be told apart by their texts."""
    rnd = np.random.default_rng(6)
    none, rare = np.zeros(0, np.uint64), np.arange(1, 13, dtype=np.uint64)
    sets = [np.sort(np.append(rare, rnd.integers(1 << 40, 1 << 62, 88, dtype=np.uint64))) for _ in range(30)]
    near = np.sort(np.append(sets[0][:95], rnd.integers(1 << 40, 1 << 62, 5, dtype=np.uint64)))
    rows = [(i, i, i, len(h), [int(x) for x in simhash.prefix(h, none, none.astype(np.int64))], [int(x) for x in simhash.parities(h)]) for i, h in enumerate([*sets, near])]
    nodes = spark.createDataFrame(rows, "node long, least long, of long, n int, ps array<long>, odd array<long>")
    assert [(r.u, r.v) for r in simhash.missed_pairs(nodes, 0.8).collect()] == [(0, 30)]
