"""The Merkle manifest equals a plain tree over all rows; forests form a commutative monoid."""

import hashlib
import random
import zlib

import pytest
from cases import ROWS, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import merkle


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def plain(digests, arity=2):
    """The root and each leaf's siblings."""
    proofs, level, place = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(level) > 1:
        for leaf, i in enumerate(place):
            first = i - i % arity
            proofs[leaf] += [level[j] for j in range(first, min(first + arity, len(level))) if j != i]
        level, place = [sha("".join(level[i : i + arity])) for i in range(0, len(level), arity)], [i // arity for i in place]
    return level[0], proofs


def expected(rows):
    def leaf(r, more=0):
        doc_id, text, lang, source, n = r
        said = (doc_id, source, lang, None if n is None else n + more, text)
        return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in said))

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = own, *plain([leaf(r) for r in own])
    root, upper = plain([trees[lang][1] for lang in langs])
    out = []
    for lang, above in zip(langs, upper, strict=True):
        own, subroot, proofs = trees[lang]
        for r, proof in zip(own, proofs, strict=True):
            tampered = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            out.append((r[0], leaf(r), subroot, root, sha("".join(proof + above)), not tampered))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in df.collect()), key=str)


def test_awkward_rows(spark):
    found = merkle.verified(documents(spark))
    assert got(found) == expected([r[:5] for r in ROWS])
    assert all((r.folded_root == r.root) == r.verified for r in found.collect())


def test_empty_and_single(spark):
    assert merkle.verified(documents(spark, [])).collect() == []
    r = merkle.verified(documents(spark, [(1, "x", "en", "a", 1)])).collect()[0]
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == sha("")


def test_many_blocks_and_a_hot_id(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(-50, 2000), f"text {rnd.randint(0, 9)}", rnd.choice(["en"] * 20 + ["de", "ÿ", None]), "a", rnd.randint(0, 5)) for _ in range(1500)] + [(7, "copy", "en", "a", 4)] * 700
    assert got(merkle.verified(documents(spark, rows).repartition(9))) == expected(rows)


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_other_arities(spark, arity):
    rows = [("t" if i % 3 else None, i, sha(str(i))) for i in range(400)]
    found, trees = merkle.proven(spark.createDataFrame(rows, "tree string, id long, leaf string").repartition(5), "tree", ["id"], "leaf", arity, 16, 8)
    roots = {r.tree: r.root for r in trees.collect()}
    for tree in ("t", None):
        own = [r for r in rows if r[0] == tree]
        root, proofs = plain([r[2] for r in own], arity)
        assert roots[tree] == root
        met = {r.id: r for r in found.filter("tree is null" if tree is None else "tree = 't'").collect()}
        assert len(met) == len(own)
        for r, proof in zip(own, proofs, strict=True):
            assert "".join(x or "" for s in met[r[1]]["__proof"] for x in s) == "".join(proof)
            h = r[2]
            for left, right in met[r[1]]["__proof"]:
                h = sha((left or "") + h + (right or ""))
            assert h == root == met[r[1]]["__root"]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 80), st.integers(2, 4), st.randoms())
def test_forests_are_a_commutative_monoid(n, arity, rnd):
    leaves = [sha(str(i)) for i in range(n)]
    order = list(range(n))
    rnd.shuffle(order)
    forests = [({}, {}) for _ in range(rnd.randint(1, 6))]
    for i in order:
        merkle.add(rnd.choice(forests), ("t", n, 0, i), leaves[i], arity)
    while len(forests) > 1:
        a, b = forests.pop(rnd.randrange(len(forests))), forests.pop(rnd.randrange(len(forests)))
        forests.append(merkle.joined(a, b, arity))
    open_, closed = forests[0]
    assert list(open_.values()) == [plain(leaves, arity)[0]]
    assert sum(1 for x in closed if x[2] == 0) == (n if n > 1 else 0)


def test_two_forests_of_a_partition_cost_no_more_than_their_nodes():
    open_, closed = {}, {}
    for i in range(1000):
        merkle.add((open_, closed), (None, 1000, 0, i), sha(str(i)))
    assert len(open_) == 1 and len(closed) == sum(merkle.width(1000, level) for level in range(merkle.height(1000)))
