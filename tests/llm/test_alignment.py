"""Alignments equal those of whole texts by the tokenizers' own libraries, token by token."""

import hashlib
import random
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import ROWS, documents

from sluice.llm import common
from sluice.llm import token_alignment as align
from sluice.llm.bpe import byte_alphabet


@pytest.fixture(scope="module")
def files():
    return align.file_contents(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def spans(parts):
    ends = [sum(map(len, parts[: i + 1])) for i in range(len(parts))]
    return [(e - len(p), e) for p, e in zip(parts, ends, strict=True)]


def plain(files, texts):
    both = align.Tokenizers(*files)
    byte = {c: b for b, c in enumerate(byte_alphabet())}
    names = {i: t for t, i in both.a.get_vocab(with_added_tokens=True).items()}
    found, count = [], Counter()
    for text in texts:
        whole = f" {text}".encode()
        ids = [both.a.encode(f" {text}", add_special_tokens=False).ids, both.b.encode(text or "", num_threads=1)]
        parts = [[bytes(byte[c] for c in names[i]) for i in ids[0]], [bytes([int(p[3:5], 16)]) if both.b.is_byte(i) else p.replace("▁", " ").encode() for i in ids[1] for p in [both.b.id_to_piece(i)]]]
        if not text or b"".join(parts[0]) != whole or b"".join(parts[1]) != whole:
            found.append(None)
            continue
        a, b = map(spans, parts)
        groups, x, y = [], 0, 0
        for cut in sorted({e for _, e in a} & {e for _, e in b}):
            own = [[], []]
            while x < len(a) and a[x][1] <= cut:
                own[0].append(ids[0][x])
                x += 1
            while y < len(b) and b[y][1] <= cut:
                own[1].append(ids[1][y])
                y += 1
            groups.append("|".join(",".join(map(str, o)) for o in own))
        links, first = [], 0
        for i, (start, end) in enumerate(a):
            while b[first][1] <= start:
                first += 1
            j = first
            while j < len(b) and b[j][0] < end:
                links.append((ids[0][i], ids[1][j]))
                j += 1
        count.update(links)
        found.append((len(a), len(b), len(groups), links, ";".join(groups)))
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    out = [(0,) * 6 + ("",) if f is None else (*f[:3], len(f[3]), sum(count[x] == most[x[1]] for x in f[3]), sum(count[x] for x in f[3]), hashlib.sha256(f[4].encode()).hexdigest()) for f in found]
    return out, count


def rows(df):
    return sorted(((r.doc_id, *(r[f] for f in align.FIGURES), r.groups_sha256) for r in align.digests(df).collect()), key=str)


def test_awkward_documents(spark, files):
    said = [r for r in ROWS if r[0] != 6] + [(30, "▁ here", "en", "a", 1), (31, " ", "en", "a", 1), (32, "  two  spaces ", "en", "a", 1), (33, "<s> <|endoftext|> <0x41> it 's", "en", "a", 1), (34, "a\x00b \x1c c　d   e", None, None, 1), (35, "日本 語 👩‍👩‍👧 é", "de", "b", 1)]
    texts, _ = align.aligned(documents(spark, said).repartition(3), *files)
    expected, _ = plain(files, [r[1] for r in said])
    assert rows(texts) == sorted(((r[0], *e) for r, e in zip(said, expected, strict=True)), key=str)


def test_cuts_equal_the_pattern_and_cost_less():
    rnd = random.Random(5)
    texts = ["", " ", "a", *("".join(rnd.choices(["a", "é", "\U0001f469", " ", " ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u2028", "\u200d"], weights=[9, 3, 2, 8, 8, 2, *[rnd.choice([0, 0, 1])] * 6], k=rnd.randint(1, 30))) for _ in range(20_000))]
    assert all(align.cut_words(t) == align.CUT.split(t) for t in texts)
    numbers = align.numbering()
    assert [numbers[w] for w in "b a b c a".split()] == [0, 1, 0, 2, 1] and list(numbers) == ["b", "a", "c"]
    long = "some words of a text\nand of its next line " * 20_000 + "end"

    def seconds(f):
        start = time.process_time()
        f(long)
        return time.process_time() - start

    assert min(seconds(align.cut_words) for _ in range(5)) < 0.7 * min(seconds(align.CUT.split) for _ in range(5))


def test_a_very_long_text_and_empty_tables(spark, files):
    text = "word  " * 30_000 + "end " + "ab" * 20_000
    texts, _ = align.aligned(documents(spark, [(1, text, "en", "a", 1)]), *files)
    r = align.digests(texts).collect()[0]
    both = align.Tokenizers(*files)
    assert (r.n_a, r.n_b) == tuple(map(len, both.of(text))) and r.n_links == r.n_a + r.n_b - r.n_groups
    texts, pairs = align.aligned(documents(spark, []), *files)
    assert texts.collect() == [] == pairs.collect()


def test_random_texts_in_small_blocks_and_counts(spark, files):
    rnd = random.Random(7)
    letters = "abcdeé  \n\t'’sß日ñ.,-0123😀 \u0085"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(300)] + ["the same text again"] * 200
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    expected, count = plain(files, texts)
    found, pairs = align.aligned(df, *files, most_different=50, most_words=300)
    assert rows(found) == sorted(((i, *e) for i, e in enumerate(expected)), key=str)
    assert {(r.a, r.b): r["count"] for r in pairs.collect()} == dict(count)


def test_words_equal_whole_texts(files):
    both, rnd = align.Tokenizers(*files), random.Random(9)
    assert both.separable
    for _ in range(2000):
        text = "".join(rnd.choice("ab 'st.\n \x1cé1—  ") for _ in range(rnd.randint(1, 40)))
        for whole, (ids, of) in zip(both.of(text), both.flat(both.words(text)), strict=True):
            assert whole.tolist() == ids[np.argsort(of, kind="stable")].tolist()


def test_batches_of_texts_are_short(spark):
    """Before, Spark's 10,000 rows a batch stood in each task's memory twice."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for set_to, expected in (("10000", common.BATCH_ROWS), ("0", common.BATCH_ROWS), ("7", 7)):
            spark.conf.set(key, set_to)
            common.short_batches(spark)
            sizes = spark.range(0, 5000, 1, 1).mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()
            assert max(r.n for r in sizes) == expected
    finally:
        spark.conf.set(key, before)
