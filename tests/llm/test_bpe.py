"""Encoding equals the tokenizers library's, and decoding too."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
from cases import ALL_IDS, documents, ids
from tokenizers import Tokenizer

from sluice.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    return bpe.WordBpe(bpe.vocabulary(PATH)), Tokenizer.from_file(PATH)


def same(both, text):
    ours, theirs = both
    packed, decoded = ours.encode(text)
    e = theirs.encode(text, add_special_tokens=False)
    return list(struct.unpack(f"<{len(packed) // 4}I", packed)) == e.ids and decoded == theirs.decode(e.ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["", "<|endoftext|>hi <|startoftext|><|endoftext|>x", "it's DON'T 12 3x!!!", "ΑΣ ΣΑΣ.", "<|endoftext|", "a'sb 'Tis we'll", "é ẛ̣ İ", "<|endoftext|>'ś", "a" * 3000, "x9" * 200 + "hello" * 300, "裰 ՘ \U00010943"])
def test_cases(both, text):
    assert same(both, text)


def test_random(both):
    rnd, letters = random.Random(1), "abcdefgh '’sTtREveLLd<|>ofendtx0123é ñ\n\t \u0085Σß‘…日本\U0001f600‍́"
    assert all(same(both, "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60)))) for _ in range(3000))


def test_every_common_letter(both):
    assert all(same(both, f"a{chr(c)}b {chr(c)}") for c in range(1, 0x3000))


def test_side_by_side_equals_single(both):
    rnd = random.Random(2)
    pieces = [bytes(rnd.choice(b"thereandisingx") for _ in range(rnd.randint(1, 33))) for _ in range(500)]
    found = both[0].learn(list(dict.fromkeys(pieces)))
    for p in pieces:
        alone = both[0].merged([*(both[0].inner[b] for b in p[:-1]), both[0].final[p[-1]]])
        assert list(struct.unpack(f"<{len(found[p][0]) // 4}I", found[p][0])) == alone


def test_bounded_table(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 3)
    kept = bpe.Kept()
    for i in range(10):
        kept.put(f"w{i}", (i,))
    assert len(kept.new) + len(kept.old) <= 6 and kept.get("w9") == (9,) and kept.get("w0") is None


def test_awkward_rows(spark, both):
    got = bpe.encode_digests(documents(spark), PATH).collect()
    assert ids(got) == ALL_IDS
    by = {r.doc_id: r for r in got}
    empty = hashlib.sha256(b"").hexdigest()
    assert (by[3].n_tokens, by[3].ids_sha256, by[3].decoded_sha256) == (0, empty, empty) == (by[4].n_tokens, by[4].ids_sha256, by[4].decoded_sha256)
    assert by[6].n_tokens == 60_001
    assert bpe.encode_digests(documents(spark, []), PATH).isEmpty()


def test_ids_round_trip(spark, both):
    r = bpe.encode(documents(spark).filter("doc_id = 1"), PATH).first()
    assert r.decoded == both[1].decode(list(r.ids), skip_special_tokens=False) and r.n_tokens == len(r.ids)
