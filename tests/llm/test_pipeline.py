"""Each stage on the rows before it, against plain versions."""

import corpus_pipeline
import public_tokenizers
from cases import documents
from tokenizers import Tokenizer

from sluice.llm import decontaminate, pii, simhash


def plain_groups(texts):
    """{id: smallest id within reach} over all pairs of five-word shingle sets with a similarity of 0.8 or more."""

    def grams(text):
        w = text.encode().lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = {i: grams(t or "") for i, t in texts.items()}
    least, order = {i: i for i in sets}, sorted(sets)

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for n, a in enumerate(order):
        for b in order[n + 1 :]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) < 0.8 * max(len(x), len(y)):
                continue
            both = len(x & y)
            if x == y or both >= 0.8 * (len(x) + len(y) - both):
                u, v = sorted((root(a), root(b)))
                least[v] = u
    return {i: root(i) for i in sets}


def test_near_copies_equal_all_pairs(spark):
    import random

    rnd = random.Random(12)
    texts = {}
    for base in range(60):
        w = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.choice([6, 12, 30, 60, 64, 130, 300]))]
        for _ in range(rnd.randint(1, 8)):
            v = list(w)
            for _ in range(rnd.randint(0, max(1, len(w) // 40))):
                v[rnd.randrange(len(v))] = "edited" + str(rnd.random())
            texts[len(texts)] = " ".join(v + ["more"] * rnd.randint(0, len(w) // 20))
    texts |= {1000: "", 1001: None, 1002: "a b", 1003: "A  b", 1004: "a b c"}
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(documents(spark, [(i, t, "en", "a", 1) for i, t in texts.items()])).collect()}
    want = plain_groups(texts)
    assert len(set(want.values())) < 0.6 * len(want)
    assert got == want


def test_large_group_of_near_copies(spark):
    import random

    rnd = random.Random(5)
    w = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(1500):
        v = list(w)
        v[rnd.randrange(100)] = f"x{i}"
        rows.append((i, " ".join(v), "en", "a", 1))
    assert [r.doc_id for r in simhash.deduplicated(documents(spark, rows)).collect()] == [0]


def test_stages(spark, small, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "decontamination", "personal_data", "encoding"]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, small).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = {r.doc_id: r for r in docs.collect()}
        assert name == "encoding" or docs.columns == columns
        assert docs.count() == len(seen[name])
    kept = seen["quality"]
    assert sum(labels[i] == 1 for i in kept if i in labels) > 0.97 * sum(q == 1 for q in labels.values())
    assert sum(labels[i] == 0 for i in kept if i in labels) < 0.1 * sum(q == 0 for q in labels.values())
    assert set(seen["near_dedup"]) == {i for i, m in plain_groups({i: r.text for i, r in kept.items()}).items() if i == m}
    items = [decontaminate.tokens(r.text.encode()) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    clean = {i for i, r in seen["near_dedup"].items() if all(decontaminate.coverage(decontaminate.tokens(r.text.encode()), x) < decontaminate.COVERAGE for x in items)}
    assert set(seen["decontamination"]) == clean and clean < set(seen["near_dedup"])
    assert set(seen["personal_data"]) == clean
    left = pii.digests(spark.read.parquet(str(tmp_path / "personal_data"))).filter("spans <> ''")
    assert left.isEmpty() and any(before[i].text != r.text for i, r in seen["personal_data"].items())
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert all(list(r.ids) == library.encode(seen["personal_data"][i].text, add_special_tokens=False).ids for i, r in seen["encoding"].items())


def test_stages_take_awkward_rows(spark, small):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        out.collect()
        assert name == "encoding" or out.columns == docs.columns
        assert stage(spark, docs.limit(0), small).isEmpty()


def test_run(spark, tiny):
    assert corpus_pipeline.run(spark, tiny).count() > 0 and corpus_pipeline.ORACLE_SQL is None
