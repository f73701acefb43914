"""Windows read back to the turns, masks hold each assistant text once, budgets hold; licence forms and lookups."""

import hashlib
import random

import duckdb
import pytest
from cases import ALL_IDS, documents, ids
from hypothesis import given
from hypothesis import strategies as st

from sluice.llm import chat_format as cf
from sluice.llm import license_scan as ls

SCHEMA = "conv_id long, turn long, role string, text string, block long, kind int, place int, loss string"
PIECES = ["</s>", "[INST]", "\\", "\n", "<|end|>", "<|turn|>", "a b c", "é", "<<SYS>>", "<\\|end|>", "\\n", "<", "|end|>"]
texts = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)


def plain(rows):
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        said = "".join(t for *_, r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, 7, 7, "clash") for r in rows], SCHEMA)


@given(texts, texts)
def test_template_is_reversible(role, text):
    made = cf.rendered((role, text))
    assert cf.read_back(made + cf.rendered(("x", "y"))) == [(role, text), ("x", "y")]
    assert not any(c in cf.escape(text) for c in cf.CONTROL) and cf.unescape(cf.escape(text)) == text


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]), st.integers(0, 30)), max_size=30), st.integers(12, 60))
def test_plan_covers_each_turn_once(turns, budget):
    line = [(r, "w " * n) for r, n in turns]
    system = line[0] if line and line[0][0] == "system" else None
    made = cf.plan(line, [], system, budget)
    assert [t for _, own in made for t in own] == line
    for repeated, own in made:
        assert own and len(repeated) <= cf.HISTORY + 1
        assert sum(map(cf.tokens, repeated + own)) <= budget or len(own) == 1


@pytest.mark.parametrize("budget", [60, cf.BUDGET])
def test_digests_equal_plain(spark, budget):
    rnd = random.Random(3)
    rows = []
    for c in range(20):
        for t in range(rnd.choice([0, 1, 3, 260, 600])):
            rows.append((c if c else None, rnd.choice([t, t, None, t // 2]), rnd.choice(["user", "assistant", "system", "we\nird</s>", None, "a\\n"]) if t else "system", None if rnd.random() < 0.05 else "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 30)))))
    rows += [(99, 0, "user", "same"), (99, 0, "user", "same"), (98, 0, "assistant", "w " * 5000)]
    made = cf.windows(frame(spark, rows), budget).cache()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in cf.digests(made).collect()}
    assert got == plain(rows)
    for w in made.collect():
        own = cf.read_back(w.text)[w.repeats :]
        assert w.n_tokens <= budget or len(own) == 1
        assert [cf.unescape(w.text[x.s : x.e]) for x in w.loss] == [t for r, t in own if r == "assistant"]


def test_system_turn_is_repeated(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, i, "user" if i % 2 else "assistant", "w " * 20) for i in range(1, 600)]
    made = cf.windows(frame(spark, rows), 100).collect()
    assert all(cf.read_back(w.text)[0] == ("system", "be kind") for w in made)
    assert sum(len(cf.read_back(w.text)) - w.repeats for w in made) == 600


def test_gaps_in_numbers_change_nothing(spark):
    rnd = random.Random(8)
    turns = [(1, i, "user" if i % 2 else "assistant", "w " * rnd.randint(1, 60)) for i in range(700)]
    key = lambda w: (w.block, w.place, w.text, w.repeats, w.n_tokens)
    dense, sparse = (sorted(map(key, cf.windows(frame(spark, [(c, i * step - 5, r, t) for c, i, r, t in turns]), 300).collect())) for step in (1, 1000))
    assert dense == sparse
    assert sum(repeats > 0 for *_, repeats, _ in sparse) >= len(sparse) - 1 and any(len(cf.read_back(text)) > 5 for _, _, text, *_ in sparse)


def test_many_turns_of_one_number(spark):
    rows = [(1, 5, "user", f"text {i:04d}") for i in range(600)]
    made = cf.windows(frame(spark, rows), 100).orderBy("block", "place").collect()
    assert [t for w in made for _, t in cf.read_back(w.text)[w.repeats :]] == [f"text {i:04d}" for i in range(600)]


def test_budget_counts_bpe_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rnd = random.Random(4)
    rows = [(c, i, "user" if i % 2 else "assistant", "".join(rnd.choice([*PIECES, "tokenization ", "ünï ", "12345 "]) for _ in range(rnd.randint(0, 40)))) for c in range(3) for i in range(40)]
    for w in cf.windows(frame(spark, rows), 200, path).collect():
        assert w.n_tokens == len(library.encode(w.text, add_special_tokens=False).ids)
        assert w.n_tokens <= 200 or len(cf.read_back(w.text)) - w.repeats == 1


def test_empty_conversations(spark):
    assert cf.digests(cf.windows(frame(spark, []))).isEmpty()


def test_canonical_forms(spark):
    mit = dict(ls.KNOWN)["MIT"]
    whole = next(t for i, t in ls.KNOWN if i == "MIT" and t.startswith("Permission"))
    rows = [(1, "Copyright (c) 2020 Someone\n\n" + whole.upper(), "en", "a", 1), (2, whole.replace("sublicense", "sub-license").replace("\n", "  "), "en", "a", 1), (3, whole + " more", "en", "a", 1), (4, "Some text.\nReleased under the MIT licence\nLicensed under CC BY-NC 4.0.\nend", "en", "a", 1)]
    got = {r.doc_id: (r.license_id, r.notices) for r in ls.scanned(documents(spark, rows), ls.known_texts(spark)).collect()}
    assert got[1][0] == got[2][0] == "MIT" and got[3][0] is None and got[4] == (None, "CC-BY-NC-4.0,MIT")
    assert mit


def test_licences_equal_duckdb(spark, tiny):
    c = duckdb.connect()
    c.execute(f"create view documents as select * from read_parquet('{tiny}/documents.parquet')")
    got = ls.scanned(spark.read.parquet(f"{tiny}/documents.parquet"), ls.known_texts(spark), ls.long_texts(spark)).select("doc_id", "digest", "license_id", "notices").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, c.execute(ls.oracle()).fetchall()))


def test_notices_without_the_word_licence(spark):
    known = spark.createDataFrame([("reserved", "All rights reserved."), ("MIT", "SPDX-Identifier: MIT")], "license_id string, text string")
    rows = [(1, "Some prose.\nAll Rights Reserved\nMore.", "en", "a", 1), (2, "spdx identifier - MIT\nAll rights reserved!", "en", "a", 1), (3, "All rights reserved here.", "en", "a", 1)]
    got = {r.doc_id: r.notices for r in ls.scanned(documents(spark, rows), known).collect()}
    assert got == {1: "reserved", 2: "MIT,reserved", 3: None}


def test_licence_awkward_rows(spark):
    docs = documents(spark)
    got = ls.scanned(docs, ls.known_texts(spark)).collect()
    assert ids(got) == ALL_IDS
    by = {r.doc_id: r for r in got}
    assert by[3].digest == by[4].digest == by[5].digest == hashlib.sha256(b"").hexdigest()
    assert ls.scanned(documents(spark, []), ls.known_texts(spark)).isEmpty()
    assert {r.license_id for r in ls.scanned(docs, ls.known_texts(spark).limit(0)).collect()} == {None}


def test_wrapped_licences_are_known(spark):
    import textwrap

    def wrapped(text, width):
        return "\n\n".join("\n".join(textwrap.wrap(p, width)) for p in text.split("\n\n"))

    long = [(i, t) for i, t in ls.KNOWN if len(t) > 200]
    rows, want = [], {}
    for i, t in long:
        for width in range(40, 121):
            want[len(rows)] = i
            head = ("", "Copyright (c) 2021 Some One\n\n", "Copyright Jane Doe\nCopyright 2019, 2020 The Others, Inc.\n\n", "(C) 2001 X\n")[width % 4]
            rows.append((len(rows), head + wrapped(t, width), "en", "a", 1))
    got = {r.doc_id: r.license_id for r in ls.scanned(documents(spark, rows), ls.known_texts(spark)).collect()}
    assert got == want


def test_long_licences_by_digest(spark):
    import os

    folder = "/usr/share/common-licenses"
    names = {"Apache-2.0": "Apache-2.0", "GPL-3.0": "GPL-3", "GPL-2.0": "GPL-2", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    texts = {i: open(f"{folder}/{n}", encoding="utf-8").read() for i, n in names.items() if os.path.exists(f"{folder}/{n}")}
    rows = [(n, change(t), i, "a", 1) for n, (i, t, change) in enumerate((i, t, c) for i, t in texts.items() for c in (str, str.upper, lambda t: "\n".join(" * " + x.strip() for x in t.split("\n"))))]
    for r in ls.scanned(documents(spark, rows).select("doc_id", "text"), ls.known_texts(spark), ls.long_texts(spark)).collect():
        assert r.license_id == rows[r.doc_id][2]


def test_many_known_texts_are_joined(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").union(spark.createDataFrame([(-1, ls.KNOWN[0][1], "en", "a", 1), (-2, "x\nAll rights reserved\nReleased under the MIT licence", "en", "a", 1)], "doc_id long, text string, lang string, source string, n_chars long"))
    inside, joined = (sorted(map(str, ls.scanned(docs, ls.known_texts(spark), ls.long_texts(spark), n).collect())) for n in (2000, 3))
    assert inside == joined
