"""Merkle manifest: a root over all rows, a subroot for each group of rows, and for each row the siblings that prove it.

A row's leaf is the SHA-256 of its fields, a group's leaves stand in a fixed order, and every ARITY consecutive nodes
(the last run may have fewer, even one) become their hash until one node remains. Subroots give the root likewise.

Partitions sort the leaves and number them within their group; blocks of ARITY^k consecutive leaves are hashed up
where they lie. What a partition can't finish is a sparse forest: nodes keyed by tree, level and index. Forests form a
commutative monoid: to join two is to add the nodes of one to the other, and a run of siblings whose number the
tree's size tells becomes their parent as soon as it is complete. treeReduce joins the partitions' forests. k grows
with the table, so all blocks of trees of several blocks together are at most 2 x BLOCKS, whatever the input: that
bounds the forests, and the nodes of the upper levels that go back to the blocks for their proofs.

Defined results: a null field is `-`, other fields their length in bytes, a colon and their value; null groups and ids
come first; rows that repeat an id go by their leaf, and equal rows are leaves one after another; an empty table has
no row and no root; columns that aren't named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import cut, small

ARITY = 2
#: Leaves of a block at least; a tree of fewer is one block.
LEAST_BLOCK = 256
#: Blocks of a table, about, at most.
BLOCKS = 1 << 16
#: A node: the tree and its number of leaves, the level (leaves: 0) and the index within the level.
Node = tuple[str | None, int, int, int]
#: Unresolved nodes, and those that have become part of a parent, with their digests.
Forest = tuple[dict[Node, str], dict[Node, str]]
STEP = "array<struct<left: string, right: string>>"


def hashed(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """A field so that no two rows have the same sequence of fields."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def width(leaves: int, level: int, arity: int = ARITY) -> int:
    """Nodes of a level."""
    return -(-leaves // arity**level)


def add(forest: Forest, node: Node, digest: str, arity: int = ARITY) -> None:
    """Adds a node; while it completes a run of siblings, the run closes and its parent is added."""
    open_, closed = forest
    tree, n, level, index = node
    while True:
        open_[tree, n, level, index] = digest
        nodes, first = width(n, level, arity), index - index % arity
        run = [(tree, n, level, i) for i in range(first, min(first + arity, nodes))]
        if nodes == 1 or any(x not in open_ for x in run):
            return
        closed.update((x, open_.pop(x)) for x in run)
        digest = hashed([closed[x] for x in run])
        level, index = level + 1, index // arity


def joined(a: Forest, b: Forest, arity: int = ARITY) -> Forest:
    """The monoid's operation; the empty forest is neutral, and neither order nor grouping matters."""
    a[1].update(b[1])
    for node, digest in b[0].items():
        add(a, node, digest, arity)
    return a


def beside(run: list[str | None], at: int) -> tuple[str | None, str | None]:
    """What stands left and right of a node in its run, joined; null for nothing."""
    return "".join(run[:at]) or None, "".join(run[at + 1 :]) or None


def levels(digests: list[str], up: int, arity: int) -> list[list[str]]:
    """The block's nodes level by level, `up` levels above its leaves or up to one node of a lone block."""
    out = [digests]
    while len(out) <= up:
        below = out[-1]
        out.append([hashed(below[i : i + arity]) for i in range(0, len(below), arity)])
    return out


def height(leaves: int, arity: int = ARITY) -> int:
    h = 0
    while width(leaves, h, arity) > 1:
        h += 1
    return h


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str | None, int, int, list[pa.RecordBatch], list[str]]]:
    """Tree, its leaves, block, the rows and their digests, of batches sorted by tree and index; the first columns are known."""
    at, held, digests = None, [], []
    for batch in batches:
        tree, n, block = batch.column(0).to_pylist(), batch.column(1).to_pylist(), [i // size for i in batch.column(2).to_pylist()]
        start = 0
        for i in range(batch.num_rows + 1):
            key = (tree[i], n[i], block[i]) if i < batch.num_rows else None
            if i == batch.num_rows or key != at:
                if i > start:
                    held.append(batch.slice(start, i - start))
                    digests += batch.column(3).slice(start, i - start).to_pylist()
                if i < batch.num_rows:
                    if held:
                        yield *at, held, digests
                    at, held, digests, start = key, [], [], i
    if held:
        yield *at, held, digests


def _tops(size: int, k: int, arity: int):
    """Each block's highest node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for tree, n, block, _, digests in _blocks(batches, size):
            up = min(k, height(n, arity))
            found.append((tree, n, up, block, levels(digests, up, arity)[-1][0]))
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds)], ["tree", "n", "level", "index", "digest"])

    return run


def _proofs(size: int, k: int, arity: int, upper: dict[Node, str], roots: dict[tuple[str | None, int], str]):
    """The rows with their tree's root and their siblings, from the leaf's own run up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, n, block, held, digests in _blocks(batches, size):
            up = min(k, height(n, arity))
            own = levels(digests, up, arity)
            above, index, level = [], block, up
            while width(n, level, arity) > 1:
                first = index - index % arity
                above.append(beside([upper[tree, n, level, i] for i in range(first, min(first + arity, width(n, level, arity)))], index - first))
                level, index = level + 1, index // arity
            root = roots[tree, n] if above else own[-1][0]
            done = 0
            for part in held:
                steps, ends = [], [0]
                for i in range(done, done + part.num_rows):
                    for level in range(up):
                        first = i - i % arity
                        steps.append(beside(own[level][first : first + arity], i - first))
                        i //= arity
                    steps += above
                    ends.append(len(steps))
                done += part.num_rows
                struct = pa.StructArray.from_arrays([pa.array([s[0] for s in steps], pa.string()), pa.array([s[1] for s in steps], pa.string())], ["left", "right"])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([root] * part.num_rows, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct)], [*part.schema.names, "__root", "__proof"])

    return run


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """rows with `__at`, their place in their tree, and `__n`, its number of rows; ties of the order are dealt out too.

    Rows are dealt by ranges of tree and order, so that the rows of one tree are many tasks' work; only a row for each
    partition and tree is summed up in order.
    """
    keys = [F.col(tree).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order), F.col("__row")]
    laid = rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid = cut(laid.drop("__row").withColumn("__part", F.spark_partition_id()).withColumn("__in_part", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    parts = laid.groupBy(F.col("__part").alias("p"), F.col(tree).alias("t")).agg(F.count("*").alias("__here"), F.min("__in_part").alias("__first"))
    whole = Window.partitionBy("t")
    before = F.coalesce(F.sum("__here").over(whole.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("p", "t", (before - F.col("__first")).alias("__shift"), F.sum("__here").over(whole).alias("__n"))
    met = laid.join(small(parts), (F.col("__part") == F.col("p")) & F.col(tree).eqNullSafe(F.col("t")))
    return met.withColumn("__at", F.col("__in_part") + F.col("__shift")).drop("p", "t", "__part", "__in_part", "__shift")


def proven(rows: DataFrame, tree: str, order: list[str], digest: str, arity: int = ARITY, least_block: int = LEAST_BLOCK, blocks: int = BLOCKS) -> tuple[DataFrame, DataFrame]:
    """rows with `__root` and `__proof` of their tree, and a row for each tree: `tree` and `root`."""
    spark = rows.sparkSession
    placed = numbered(rows, tree, order)
    total, k = rows.count(), 0
    while arity**k < max(least_block, total / blocks):
        k += 1
    size = arity**k
    dealt = placed.select(tree, "__n", "__at", digest, *(c for c in rows.columns if c not in (tree, digest)))
    dealt = dealt.repartition(F.col(tree), F.floor(F.col("__at") / size)).sortWithinPartitions(tree, "__at")
    known = dealt.select(tree, "__n", "__at", digest)
    tops = cut(known.mapInArrow(_tops(size, k, arity), "tree string, n long, level int, index long, digest string"))
    lone = F.col("n") <= size

    def forest(found: Iterator[tuple]) -> Iterator[Forest]:
        own: Forest = ({}, {})
        for t, n, level, index, d in found:
            add(own, (t, n, level, index), d, arity)
        yield own

    split = tops.filter(~lone).rdd
    open_, closed = split.mapPartitions(forest).treeReduce(lambda a, b: joined(a, b, arity)) if split.getNumPartitions() else ({}, {})
    roots = {(t, n): d for (t, n, _, _), d in open_.items()}
    if any(width(n, level, arity) > 1 for _, n, level, _ in open_):
        raise RuntimeError("a tree has nodes without their siblings")
    kind = T.StructType([*dealt.schema.fields, T.StructField("__root", T.StringType()), *T._parse_datatype_string(f"__proof {STEP}").fields])
    made = dealt.mapInArrow(_proofs(size, k, arity, closed, roots), kind)
    every = tops.filter(lone).select("tree", F.col("digest").alias("root"))
    if roots:
        every = every.unionByName(spark.createDataFrame([(t, d) for (t, _), d in roots.items()], "tree string, root string"))
    return made, every


def manifest(rows: DataFrame, digest: str, group: str, order: str, keep: list[str]) -> DataFrame:
    """The kept columns, leaf, subroot, root and proof (steps from the leaf up: what stands left and right, joined)."""
    taken = cut(rows.select(F.col(group).cast("string").alias("__tree"), F.col(order).alias("__id"), F.col(digest).alias("__leaf"), *(F.col(c).alias(f"__kept_{i}") for i, c in enumerate(keep))))
    found, trees = proven(taken, "__tree", ["__id", "__leaf"], "__leaf")
    trees = trees.select(F.lit("").alias("__all"), F.col("tree").alias("__name"), F.col("root").alias("__subroot"))
    upper, _ = proven(trees, "__all", ["__name"], "__subroot")
    upper = small(cut(upper.select("__name", "__subroot", F.col("__root").alias("__top"), F.col("__proof").alias("__upper"))))
    met = found.join(upper, F.col("__tree").eqNullSafe(F.col("__name")))
    kept = [F.col(f"__kept_{i}").alias(c) for i, c in enumerate(keep)]
    return met.select(*kept, F.col("__leaf").alias("leaf"), F.col("__subroot").alias("subroot"), F.col("__top").alias("root"), F.concat("__proof", "__upper").alias("proof"))


def proof_digest(proof: Column) -> Column:
    """The hash of a proof's siblings, from the leaf up and from left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(proof, lambda s: F.array(s["left"], s["right"]))), ""), 256)


def folded(digest: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, digest, lambda h, s: F.sha2(F.concat(F.coalesce(s["left"], F.lit("")), h, F.coalesce(s["right"], F.lit(""))), 256))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows whose id's CRC-32 this number divides are tampered with.
TAMPERED = 7


def tampering(docs: DataFrame) -> Column:
    """Which rows of documents are tampered with; a null id or a null n_chars isn't."""
    return F.coalesce(F.crc32(docs["doc_id"].cast("string")) % TAMPERED == 0, F.lit(False)) & docs["n_chars"].isNotNull()


def verified(docs: DataFrame) -> DataFrame:
    """The manifest of documents by language, and whether each row, tampered with or not, still leads to the root."""
    own = {c: docs[c] for c in FIELDS}
    changed = leaf(*(own | {"n_chars": docs["n_chars"].cast("decimal(20,0)") + 1}).values())
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["lang"].alias("lang"), leaf(*own.values()).alias("leaf"), F.when(tampering(docs), changed).alias("tampered"))
    found = manifest(rows, "leaf", "lang", "doc_id", ["doc_id", "tampered"])
    found = found.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: The same in SQL for DuckDB, for arity 2.
ORACLE = """
with recursive d as (select doc_id, lang, n_chars, concat(
    case when doc_id is null then '-' else concat(strlen(doc_id::varchar), ':', doc_id) end, case when source is null then '-' else concat(strlen(source), ':', source) end,
    case when lang is null then '-' else concat(strlen(lang), ':', lang) end) as head, case when text is null then '-' else concat(strlen(text), ':', text) end as tail from documents),
fields as (select *, case when n_chars is null then '-' else concat(strlen(n_chars::varchar), ':', n_chars) end as own,
    concat(strlen((n_chars::hugeint + 1)::varchar), ':', n_chars::hugeint + 1) as other,
    xor(list_reduce([4294967295::bigint] || list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint),
        lambda crc, b: list_reduce([xor(crc, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::bigint) as crc from d),
hashes as (select doc_id, lang, sha256(concat(head, own, tail)) as leaf, case when crc % 7 = 0 and n_chars is not null then sha256(concat(head, other, tail)) end as tampered from fields),
placed as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by lang) as n from hashes),
tree as (select lang, 0 as level, idx, n, leaf as h from placed
    union all select lang, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' order by idx)) from tree where n > 1 group by lang, level, idx // 2, n),
subroots as (select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as idx, count(*) over () as n from tree where n = 1),
top as (select 0 as level, idx, n, subroot as h from subroots
    union all select level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' order by idx)) from top where n > 1 group by level, idx // 2, n),
steps as (select p.doc_id, p.leaf, p.lang, p.idx as place, 0 as part, t.level, t.n > 1 as goes_on, s.h as sibling, s.idx < (p.idx >> t.level) as is_left
        from placed p join tree t on t.lang is not distinct from p.lang and t.idx = p.idx >> t.level and t.n > 1
        left join tree s on s.lang is not distinct from p.lang and s.level = t.level and s.idx = xor(p.idx >> t.level, 1)
    union all select p.doc_id, p.leaf, p.lang, p.idx, 1, t.level, true, s.h, s.idx < (r.idx >> t.level)
        from placed p join subroots r on r.lang is not distinct from p.lang join top t on t.idx = r.idx >> t.level and t.n > 1
        left join top s on s.level = t.level and s.idx = xor(r.idx >> t.level, 1)),
proofs as (select lang, place, list({'s': coalesce(sibling, ''), 'l': coalesce(is_left, false)} order by part, level) as proof from steps group by 1, 2),
climbs as (select p.lang, p.idx as place, 1 as i, coalesce(p.tampered, p.leaf) as h, coalesce(proof, []) as proof from placed p left join proofs q on q.lang is not distinct from p.lang and q.place = p.idx
    union all select lang, place, i + 1, sha256(case when proof[i].l then proof[i].s || h else h || proof[i].s end), proof from climbs where i <= len(proof))
select p.doc_id, p.leaf, r.subroot, (select h from top where n = 1) as root, sha256(list_aggregate(list_prepend('', list_transform(c.proof, lambda x: x.s)), 'string_agg', '')) as proof_sha256,
    c.h as folded_root, c.h = (select h from top where n = 1) as verified
from placed p join subroots r on r.lang is not distinct from p.lang join climbs c on c.lang is not distinct from p.lang and c.place = p.idx and c.i = len(c.proof) + 1"""
