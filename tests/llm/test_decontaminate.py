"""Tiling against a plain greedy version; whole tables against trying every pair."""

import random

from cases import documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import decontaminate as d


def plain_tiles(doc, item, least):
    """Greedy string tiling by trying every pair of positions."""
    used_d, used_i, covered = set(), set(), 0
    while True:
        best, where = least - 1, []
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n] and a + n not in used_d and b + n not in used_i:
                    n += 1
                if n > best:
                    best, where = n, [(a, b)]
                elif n == best and n >= least:
                    where.append((a, b))
        if not where:
            return covered
        for a, b in where:
            if not used_d & set(range(a, a + best)) and not used_i & set(range(b, b + best)):
                used_d |= set(range(a, a + best))
                used_i |= set(range(b, b + best))
                covered += best


words = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=18)


@settings(max_examples=150, deadline=None)
@given(words, words)
def test_tiles_equal_plain(doc, item):
    found = d.tiles(doc, item, 3)
    assert sum(n for *_, n in found) == plain_tiles(doc, item, 3)
    for a, b, n in found:
        assert doc[a : a + n] == item[b : b + n] and n >= 3
    assert len({x for a, _, n in found for x in range(a, a + n)}) == sum(n for *_, n in found) == len({x for _, b, n in found for x in range(b, b + n)})


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c", b"d", b"x"]), max_size=60), st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), max_size=30), st.integers(1, 4))
def test_longer_tiles_equal_plain(doc, item, least):
    assert sum(n for *_, n in d.tiles(doc, item, least)) == plain_tiles(doc, item, least)


def test_repetitive_texts_in_bounded_memory_and_time():
    import time
    import tracemalloc

    def texts(n):
        yield b"word " * n, b"word " * 500, 1.0
        yield b"one two three four five six seven " * (n // 7), b"one two three four five six seven " * 20 + b"two one three four five " * 60, 0.3

    for doc, item, least_share in texts(1_000_000):
        words, other = d.tokens(doc), d.tokens(item)
        start = time.time()
        assert d.coverage(words, other) >= least_share and time.time() - start < 5
    for doc, item, _ in texts(100_000):
        words, other = d.tokens(doc), d.tokens(item)
        tracemalloc.start()
        d.coverage(words, other)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 10 << 20  # in proportion: 100 MB for a million words


def test_spared_windows_lose_no_pair(spark):
    rnd = random.Random(4)
    head = [f"h{i}" for i in range(20)]
    items = [(i, " ".join(head + [f"i{i}w{k}" for k in range(30)])) for i in range(60)]
    docs = [(i, " ".join(head)) for i in range(100, 140)] + [(i, t) for i, t in items[:20]]
    for i in range(200, 260):
        w = rnd.choice(items)[1].split()
        docs.append((i, " ".join(w[: rnd.randint(5, 50)] + ["x"] + w[rnd.randint(0, 40) :])))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = plain_pairs(docs, items)
    for hot in (0, 3, 16, 10**6):
        assert {(r.doc_id, r.item_id): r.coverage for r in d.contaminated(*frames, hot_items=hot).collect()} == want
    kept = d.needed_windows(frames[1].mapInArrow(d._seeds(5, None), "id long, h long, n int, times int"), 5, 0.6, 16).groupBy("id").agg(F.count("*").alias("n"), F.max("spared").alias("spared")).collect()
    assert len(kept) == 60 and {(r.n, r.spared) for r in kept} == {(41, 5)}


def test_reordered_passages_count():
    rnd = random.Random(1)
    item = [b"w%d" % i for i in range(40)]
    parts = [item[i : i + 10] for i in range(0, 40, 10)]
    rnd.shuffle(parts)
    assert d.coverage([x for p in parts for x in [*p, b"other"]], item) == 1.0
    assert d.coverage(item[:20], item) == 0.5
    assert d.coverage([x for i in range(0, 40, 4) for x in item[i : i + 4] + [b"z"]], item) == 0.0


def test_tokens_ignore_case_and_marks():
    assert d.tokens("Don't STOP, É-b!".encode()) == [b"don", b"t", b"stop", "É".encode(), b"b"]


def plain_pairs(docs, items):
    out = {}
    for i, text in docs:
        for j, item in items:
            c = d.coverage(d.tokens((text or "").encode()), d.tokens((item or "").encode()))
            if i is not None and j is not None and c >= d.COVERAGE:
                out[i, j] = max(c, out.get((i, j), 0))
    return out


def test_whole_tables_equal_every_pair(spark, tiny):
    docs, items = spark.read.parquet(f"{tiny}/documents.parquet"), spark.read.parquet(f"{tiny}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.coverage for r in d.contaminated(docs, items).collect()}
    assert got == plain_pairs([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got


def test_awkward_rows(spark):
    docs = documents(spark)
    items = spark.createDataFrame([(1, "the cat sat on the mat and then it ran away"), (2, None), (3, ""), (4, "one two"), (None, "the cat sat on the mat"), (5, "the cat sat on the mat and then it ran away"), (6, "word word word word word word"), (7, "word " * 30)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in d.contaminated(docs, items).collect())
    assert got == [(1, 1), (1, 5), (2, 1), (2, 5), (6, 6), (6, 7)]
    kept = d.cleaned(docs, items)
    assert kept.columns == docs.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 3, 4, 5, 7, 8, 9]
    assert d.contaminated(documents(spark, []), items).isEmpty() and d.contaminated(docs, items.limit(0)).isEmpty()
