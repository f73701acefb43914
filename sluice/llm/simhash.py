"""SimHash near-duplicates through Golay-code fuzzy hashing.

A 64-bit fingerprint has three segments of 21, 21 and 22 bits, each padded to the 23 bits of the perfect Golay code.
The code decodes a segment to the codewords within distance 4: one where the nearest lies within 2, six where it lies
at 3. Two segments that differ in at most 2 bits share such a codeword (the one next to the word half-way between
them), and two that differ in at most 1 bit have the nearest codeword of either one among those of the other.

Four errors over three segments leave (pigeonhole) either one segment without an error and another with at most two,
or an error in each, where two segments have just one (so one half of each is as it was) and the third at most two. So
every fingerprint gets these keys:

* for each ordered pair of segments: the first as it is, with each codeword near the second (33 bits),
* for each segment: each codeword near it, with one half of each other segment as it is (32 to 34 bits).

A join on the keys meets every pair of different fingerprints within four bits and counts their differing bits; a pair
counts only at the first kind of key that suits it. Equal fingerprints are never paired: they have one node. Links
become components by alternating star contraction, wholly in joins and grouped minima.

groups() is that rule. Four bits of 64 are far less than the difference of near copies (texts of 0.8 similarity differ
in some ten), so deduplicated() has a rule of its own: five-word shingle sets with a Jaccard similarity of 0.8 or more.
Its candidates are the fingerprints' links and texts that share a class of shingles (class_keys); the sets decide.
A pair of similar texts shares no key in fewer than one of 10,000 cases. Within a key's group a text is compared with
one or two others a round (ROUNDS), the most central ones first (those whose keys most texts share: they carry the fewest changes
of their own), and texts that no round has linked yet go on to the next. So work grows with the keys, never with the
square of a group. That joins nearly all copies, and finds no link between groups that only less central members share.

So a last step is exact (missed_links()). Put all shingles in one order, rare ones first: two sets as similar as 0.8
must share one of the first fifth of either one (else too few are left to share). Texts with such a shingle in common
that aren't in one group yet are compared, all of them, without any bound on a shingle's texts. What is in one group by
then needs no comparison, so copies are never expanded into pairs. Which shingles are rare is estimated on a sample; any
order gives the same groups. A shingle's texts are cut into blocks, so a frequent one is many tasks' work.

Defined results: a null or empty text, or one without a word, has fingerprint zero and is linked like any other; rows
with a null id get their group's smallest id (null if the group has none); repeated rows are repeated in the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from itertools import combinations, permutations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import cut, draw, lower, share_of, short_batches, slices, small, swept, thrifty, words

SHINGLE_WORDS = 4
MOST_BITS = 4
#: Near copies: words of a shingle, and the similarity of the shingle sets.
COPY_WORDS, LEAST_SIMILAR = 5, 0.8
#: Classes of a text's shingles that give keys.
CLASSES = 24
#: Members of a key's group, by place, that others are compared with in each round: the most central one first, as most
#: texts of a group of copies are similar to it and need no other. What they don't join is left to missed_links().
ROUNDS = ((1, 1), (2, 3))
#: Bits that fingerprints of similar sets differ in at most: some ten are to be expected, more than this in fewer than one
#: of 10,000 pairs (sets of five shingles; far fewer of larger ones), and unrelated sets differ in some 32.
MOST_APART = 24
#: Texts whose shingles are counted to tell common ones, the least count in there, and how many common ones are told apart.
#: They order shingles and decide nothing else: any order gives the same links.
ORDER_TEXTS, ORDER_COUNT, MOST_COMMON = 1 << 14, 3, 1 << 17
#: Shared shingles up to which they are broadcast (some 10 MB); more are joined by shuffle.
MOST_GROUPS = 200_000
#: Longs of a set's parities (parities()): enough to tell sets of up to a thousand shingles apart.
PARITIES = 8
#: Texts of a shingle that one block of comparisons holds.
BLOCK = 4096
SEED = 42
#: Low bit and width of each segment.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: Low bit and width of the halves of each segment; and a segment with one half of each other.
HALVES = tuple(((lo, w // 2), (lo + w // 2, w - w // 2)) for lo, w in SEGMENTS)
_HALVES = tuple((r, a, b) for r, p, q in ((2, 0, 1), (1, 0, 2), (0, 1, 2)) for a in HALVES[p] for b in HALVES[q])
#: Generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY = 0xAE3


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """A bit is 1 if it is set in over half the shingles' XXH64; no word: zero."""
    w = words(lower(text))
    if not w:
        return 0
    if len(w) > shingle:
        grams = map(b" ".join, zip(*(w[i:] for i in range(shingle)), strict=False))
        n = len(w) - shingle + 1
    else:
        grams, n = iter((b" ".join(w),)), 1
    set_in = np.zeros(64, np.int64)
    for start in range(0, n, 1 << 16):  # bounded memory for very long texts
        size = min(1 << 16, n - start)
        h = np.fromiter(map(xxhash.xxh64_intdigest, (next(grams) for _ in range(size)) if n > 1 << 16 else grams, repeat(seed)), np.uint64, size)
        set_in += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int32)
    return int(np.packbits(2 * set_in > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches):
        f = np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(f)], ["doc_id", "f"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and f, the fingerprint as a signed long."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(_fingerprints, "doc_id long, f long")


@cache
def golay() -> tuple[np.ndarray, np.ndarray]:
    """For 12 message bits the check bits; for each syndrome the error patterns of at most 4 bits, least first, then -1."""

    def rest(x: int) -> int:
        for bit in range(22, 10, -1):
            if x >> bit & 1:
                x ^= GOLAY << (bit - 11)
        return x

    checks = np.array([rest(m << 11) for m in range(1 << 12)], np.int64)
    near: list[list[int]] = [[] for _ in range(1 << 11)]
    for weight in range(5):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            near[rest(e)].append(e)
    wide = max(map(len, near))
    return checks, np.array([e + [-1] * (wide - len(e)) for e in near], np.int64)


def codewords(x: np.ndarray) -> np.ndarray:
    """Message indices of the codewords within distance 4 of 23-bit words, nearest first, -1 where there are no more."""
    checks, near = golay()
    e = near[checks[x >> 11] ^ (x & 0x7FF)]
    return np.where(e < 0, -1, (x[:, None] ^ e) >> 11)


def keys(f: np.ndarray) -> np.ndarray:
    """Keys of each fingerprint; -1: none."""
    seg = [(f >> lo & ((1 << w) - 1)).astype(np.int64) for lo, w in SEGMENTS]
    near = [codewords(s) for s in seg]
    out = []
    for kind, (p, q) in enumerate(permutations(range(3), 2)):
        out.append(np.where(near[q] < 0, -1, kind << 40 | seg[p][:, None] << 12 | near[q]))
    for kind, (r, a, b) in enumerate(_HALVES, 6):
        halves = (f >> a[0] & ((1 << a[1]) - 1)) << 11 | (f >> b[0] & ((1 << b[1]) - 1))
        out.append(np.where(near[r] < 0, -1, kind << 40 | halves[:, None] << 12 | near[r]))
    return np.concatenate(out, 1)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            f = batch.column(0).slice(start, 4096).to_numpy(zero_copy_only=False)
            k = keys(f)
            good = k >= 0
            yield pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(f[:, None], k.shape)[good]), pa.array(k[good])], ["f", "k"])


def _differing(x: Column, low: int, width: int) -> Column:
    return F.bit_count(x.bitwiseAND(F.lit(((1 << width) - 1) << low if low + width < 64 else -(1 << low))))


def _suits(x: Column, kind: Column) -> Column:
    """True where the kind of key is the first that must bring together fingerprints with the given differing bits."""
    d = [_differing(x, *s) for s in SEGMENTS]
    first = F
    for i, (p, q) in enumerate(permutations(range(3), 2)):
        first = first.when((d[p] == 0) & (d[q] <= 2), i)
    for i, (r, a, b) in enumerate(_HALVES, 6):
        first = first.when((d[r] <= 2) & (_differing(x, *a) == 0) & (_differing(x, *b) == 0), i)
    return first == kind


def links(prints: DataFrame) -> DataFrame:
    """Pairs a < b of fingerprints (column f, each of which stands once) that differ in at most four bits, each once."""
    keyed = prints.select("f").mapInArrow(_keyed, "f long, k long")
    # a fingerprint has about a hundred keys, more than Spark expects of a map, so neither side may be broadcast
    left, right = keyed.toDF("a", "k").hint("merge"), keyed.toDF("b", "j")
    x = F.col("a").bitwiseXOR(F.col("b"))
    met = left.join(right, (F.col("k") == F.col("j")) & (F.col("a") < F.col("b")) & (F.bit_count(x) <= MOST_BITS) & _suits(x, F.shiftright("k", 40)))
    return met.select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) for every node of the edges u, v."""
    e = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    mark = None
    while True:
        seen = e.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if seen == mark:
            break
        mark = seen
        # large star: larger neighbours move to the least of the neighbourhood
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours and the node itself move to the least smaller one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        e = cut(large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(e.select("v", "v").distinct())


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable over links."""
    return grouped(cut(fingerprints(docs)))


def grouped(prints: DataFrame) -> DataFrame:
    """The same from doc_id and f."""
    least = cut(prints.groupBy("f").agg(F.min("doc_id").alias("least")))
    met = links(least.filter("least is not null"))
    edges = met.join(least.select(F.col("f").alias("a"), F.col("least").alias("u")), "a").join(least.select(F.col("f").alias("b"), F.col("least").alias("v")), "b").select("u", "v")
    found = components(edges)
    of = least.join(found, least["least"] == found["node"], "left").select("f", F.coalesce("component", "least").alias("component_id"))
    return prints.join(of, "f").select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


def shingles(text: bytes, size: int = COPY_WORDS) -> np.ndarray:
    """The sorted different XXH64 of a text's shingles; a shorter text is one shingle, one without a word has none."""
    w = words(lower(text))
    if not w:
        return np.zeros(0, np.uint64)
    n = max(1, len(w) - size + 1)
    grams = map(b" ".join, zip(*(w[i:] for i in range(size)), strict=False)) if len(w) > size else iter((b" ".join(w),))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n))


def class_keys(h: np.ndarray, least: float = LEAST_SIMILAR, most: int = CLASSES) -> np.ndarray:
    """Keys of a set of shingles: a mixed sum for each of its classes by hash.

    Two sets as similar as `least` differ in at most (1 - least) / least of the smaller one's size; there are as many
    classes as that, so (pigeonhole, as for the segments of a fingerprint) each class stays whole with a chance of a
    third or more. The first `most` classes give keys. Class counts go by powers of two of the set's size, and a set
    whose partner may have the next power has keys for both.
    """
    out = []
    level = len(h).bit_length() - 1
    for b in (level, level + 1) if len(h) >= least * (2 << level) else (level,):
        n_classes = max(1, int((2 << b) * (1 - least) / least + 0.5))
        of = h >> np.uint64(20)
        of = of % np.uint64(n_classes) if n_classes > 1 else np.zeros(len(h), np.uint64)
        chosen = of < most
        g, of = h[chosen], of[chosen]
        order = np.argsort(of, kind="stable")
        g, of = g[order] * np.uint64(0x9E3779B97F4A7C15), of[order]
        g ^= g >> np.uint64(29)
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))[: len(of)]
        if len(first):
            sums = np.add.reduceat(g * np.uint64(0xBF58476D1CE4E5B9), first)
            out.append((sums ^ (of[first] + np.uint64(1)) * np.uint64(0x94D049BB133111EB)) + np.uint64(b + 1) * np.uint64(0xD6E8FEB86659FD93))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def prefix(h: np.ndarray, common: np.ndarray, ranks: np.ndarray, least: float = LEAST_SIMILAR) -> np.ndarray:
    """The first of a set's shingles, rare ones first: sets as similar as `least` share one of the first of each.

    common: sorted shingles that many texts have, ranks: their places in the order. All others come before, by number.
    """
    rank = np.full(len(h), -1, np.int64)
    if len(common):
        at = np.searchsorted(common, h).clip(0, len(common) - 1)
        rank = np.where(common[at] == h, ranks[at], -1)
    # as sets share `least` of the larger one at least; the margin keeps rounding from raising that
    return h[np.lexsort((h, rank))][: len(h) - int(np.ceil(least * len(h) - 1e-6)) + 1]


def parities(h: np.ndarray) -> np.ndarray:
    """For each class of hashes whether a set has an odd number of its shingles, a bit each.

    Each shingle that is in one of two sets only changes one bit, so two sets differ in at least as many shingles as
    their parities differ in bits.
    """
    bits = np.bincount((h >> np.uint64(7)).astype(np.int64) & (64 * PARITIES - 1), minlength=64 * PARITIES) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _listed(lists: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, lists)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *(x.view(np.int64) for x in lists)])))


def _copy_prints(common: np.ndarray, ranks: np.ndarray, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            sets = [shingles(t) for t in texts]
            f = np.fromiter(map(_majority, sets), np.uint64, len(sets)).view(np.int64)
            ks = [np.append(class_keys(h, least), x.view(np.uint64)) if len(h) else np.zeros(0, np.uint64) for h, x in zip(sets, f, strict=True)]
            ps = [prefix(h, common, ranks, least) for h in sets]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([xxhash.xxh3_128_hexdigest(h.tobytes()) for h in sets], pa.string()), pa.array(f), pa.array([len(h) for h in sets], pa.int32()), _listed(ks), _listed(ps), _listed([parities(h) for h in sets])], ["doc_id", "t", "c", "f", "n", "ks", "ps", "odd"])

    return run


def _all_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts in slices(batches):
        for t in texts:
            yield pa.RecordBatch.from_arrays([pa.array(shingles(t).view(np.int64))], ["h"])


def common_shingles(docs: DataFrame, most: int = ORDER_TEXTS) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many of a sample's texts have, sorted, and their places in the order, rarer ones first."""
    sample = docs.filter(draw("doc_id", "text") < share_of(most, docs.count())).select("text")
    often = sample.mapInArrow(_all_shingles, "h long").groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= ORDER_COUNT)
    got = often.orderBy(F.desc("n"), "h").limit(MOST_COMMON).select("h").toArrow().column("h").to_numpy()
    h = np.asarray(got, np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], len(h) - order


def _majority(h: np.ndarray) -> int:
    """The fingerprint of a set of shingles."""
    if not len(h):
        return 0
    set_in = sum(np.unpackbits(h[i : i + (1 << 16)].view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64) for i in range(0, len(h), 1 << 16))
    return int(np.packbits(2 * set_in > len(h), bitorder="little").view(np.uint64)[0])


def _similar(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for part, texts in slices(batches, "u_text"):
            (others,) = (x for _, x in slices(iter([part]), "v_text"))
            good = []
            for t, other in zip(texts, others, strict=True):
                if t != last[0]:
                    last = (t, shingles(t))
                a, b = last[1], shingles(other)
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(both >= least * (len(a) + len(b) - both))
            yield part.filter(pa.array(good, pa.bool_())).select(["u", "v", "u_least", "v_least"])

    return run


#: What is carried of a node beside its number: its smallest id, fingerprint and number of shingles.
_OF_NODE = ("least", "f", "n")


def shared_keys(nodes: DataFrame) -> DataFrame:
    """k, size and the node (node, least, f, n) for the keys that several nodes have."""
    each = nodes.select("node", *_OF_NODE, F.explode("ks").alias("k"))
    return each.join(each.groupBy("k").agg(F.count("*").alias("size")).filter("size > 1"), "k")


def leaders(shared: DataFrame, most: int) -> DataFrame:
    """k, place and each key's most central nodes (leader, l_least, l_f, l_n): those whose keys most nodes share."""
    weight = shared.groupBy("node").agg(F.sum(F.round(F.log2("size") * 1000).cast("long")).alias("weight"))
    place = F.row_number().over(Window.partitionBy("k").orderBy(F.desc("weight"), "node"))
    ranked = shared.join(weight, "node").withColumn("place", place).filter(F.col("place") <= most)
    return ranked.select("k", "place", F.col("node").alias("leader"), *(F.col(c).alias(f"l_{c}") for c in _OF_NODE))


def likely(met: DataFrame, least: float) -> DataFrame:
    """u, v and their least ids of the pairs node, leader whose sizes allow the similarity and whose fingerprints are near enough."""
    sized = (F.col("n") >= F.col("l_n") * least) & (F.col("l_n") >= F.col("n") * least)
    near = F.bit_count(F.col("f").bitwiseXOR(F.col("l_f"))) <= MOST_APART
    a, b = F.struct("node", "least"), F.struct(F.col("leader").alias("node"), F.col("l_least").alias("least"))
    pairs = met.filter((F.col("node") != F.col("leader")) & sized & near).select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y"))
    return pairs.select(F.col("x.node").alias("u"), F.col("y.node").alias("v"), F.col("x.least").alias("u_least"), F.col("y.least").alias("v_least")).distinct()


def _node(doc_id: Column, text_hash: Column) -> Column:
    """The number of a text of an id."""
    return F.xxhash64(doc_id, text_hash)


def verified(pairs: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """The pairs whose whole texts' sets are similar."""
    texts = docs.select(_node(docs["doc_id"].cast("long"), F.xxhash64(docs["text"])).alias("node"), docs["text"])
    held = texts.join(small(pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()), "node", "left_semi").dropDuplicates(["node"])
    # v is a group's member mostly and u its leader, so rows of a hot u are spread by v first
    told = pairs.join(held.toDF("v", "v_text"), "v").join(held.toDF("u", "u_text"), "u").select("u", "v", "u_least", "v_least", "u_text", "v_text")
    return told.mapInArrow(thrifty(_similar(least)), "u long, v long, u_least long, v_least long")


def similar_links(nodes: DataFrame, docs: DataFrame, least: float = LEAST_SIMILAR) -> DataFrame:
    """u, v: ids of similar nodes (node, least, f, n, ks), enough of them to join the groups."""
    shared = cut(shared_keys(nodes))
    led = cut(leaders(shared, ROUNDS[-1][1]))
    # of the nodes with one fingerprint the key groups take care; one of them stands for all beside other fingerprints
    stand = cut(nodes.groupBy("f").agg(F.min(F.struct("node", "least", "n")).alias("s")).select("f", "s.*"))
    close = links(stand.select("f")).toDF("f", "l_f").join(stand, "f").join(stand.toDF("l_f", "leader", "l_least", "l_n"), "l_f")
    found, tested, left = [], [], shared
    for at, (first, last) in enumerate(ROUNDS):
        met = left.join(led.filter(F.col("place").between(first, last)), "k")
        names = ["node", *_OF_NODE, "leader", *(f"l_{c}" for c in _OF_NODE)]
        pairs = likely(met.select(names) if at else met.select(names).union(close.select(names)), least)
        if tested:
            pairs = pairs.join(reduce(DataFrame.union, tested), ["u", "v"], "left_anti")
        pairs = cut(pairs)
        if pairs.isEmpty():
            break
        tested.append(pairs.select("u", "v"))
        found.append(cut(verified(pairs, docs, least)))
        linked = found[-1].select(F.col("u").alias("node")).union(found[-1].select("v")).distinct()
        left = cut(left.filter(F.col("size") > last).join(small(linked), "node", "left_anti"))
    if not found:
        return nodes.select(F.col("least").alias("u"), F.col("least").alias("v")).limit(0)
    return reduce(DataFrame.union, found).select(F.col("u_least").alias("u"), F.col("v_least").alias("v"))


def missed_pairs(nodes: DataFrame, least: float) -> DataFrame:
    """u, v, their groups, and `shared`, of all nodes of different groups that may be similar.

    nodes: node, of (its group), n, ps, odd. Of two sets, take the one whose first shingles (prefix()) end earlier in
    the order: what it shares is among the first of both, or comes after its own first ones. So the shingles shared among
    the first and the rest of one set must be enough together. And wherever a shared shingle stands, what can be shared
    before it and after it must be enough with it, so texts that differ in many rare shingles don't meet at common ones.
    Nor do texts meet whose parities differ in more bits than similar sets of their sizes differ in shingles.
    """
    each = nodes.select("node", "of", F.posexplode("ps").alias("at", "k"))
    spread = cut(each.groupBy("k").agg(F.min("of").alias("low"), F.max("of").alias("high")).filter("low <> high").select("k"))
    swept(nodes.sparkSession)
    # most shingles are a single group's, so only what is needed to meet is shuffled before they are gone
    shared = cut(each.join(small(spread, MOST_GROUPS), "k"))
    swept(nodes.sparkSession)
    groups = shared.groupBy("k", "of").agg(F.count("*").alias("m")).groupBy("k").agg(F.sum("m").alias("size"), F.max_by("of", F.struct("m", "of")).alias("major"))
    groups = groups.select("k", "major", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    odd = [F.col("odd")[i].alias(f"odd{i}") for i in range(PARITIES)]
    met = shared.join(nodes.select("node", "n", (F.col("n") - F.size("ps")).alias("after"), *odd), "node").join(groups, "k")
    # of two groups' members one isn't in the largest group, so members of that are compared with the others only
    minor = met.filter("of <> major").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    every = met.withColumn("part", F.pmod(F.hash("node"), F.col("blocks")))
    names = ["node", "of", "n", "after", "at", *(f"odd{i}" for i in range(PARITIES))]
    x, y = minor.select("k", "part", *(F.col(c).alias(f"x_{c}") for c in names)), every.select("k", "part", "major", *(F.col(c).alias(f"y_{c}") for c in names))
    once = (F.col("y_of") == F.col("major")) | (F.col("x_node") < F.col("y_node"))
    sized = (F.col("x_n") >= F.col("y_n") * least - 1e-6) & (F.col("y_n") >= F.col("x_n") * least - 1e-6)
    both = F.col("x_n") + F.col("y_n")
    required = F.lit(least / (1 + least)) * both - 1e-6
    enough = F.least("x_at", "y_at") + F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at")) >= required
    apart = reduce(Column.__add__, (F.bit_count(F.col(f"x_odd{i}").bitwiseXOR(F.col(f"y_odd{i}"))) for i in range(PARITIES)))
    pairs = x.hint("merge").join(y, (x["k"] == y["k"]) & (x["part"] == y["part"]) & (F.col("x_of") != F.col("y_of")) & once & sized & enough & (apart <= both - 2 * required))
    a, b = (F.struct(*(F.col(f"{side}_{c}").alias(c) for c in ("node", "of"))) for side in "xy")
    pairs = pairs.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"), (required - F.greatest("x_after", "y_after")).alias("needed")).groupBy("u", "v").agg(F.count("*").alias("shared"), F.first("needed").alias("needed")).filter("shared >= needed")
    return pairs.select(F.col("u.node").alias("u"), F.col("v.node").alias("v"), F.col("u.of").alias("u_of"), F.col("v.of").alias("v_of"), "shared")


def missed_links(nodes: DataFrame, docs: DataFrame, least: float = LEAST_SIMILAR) -> DataFrame | None:
    """u, v: ids of similar nodes of different groups (node, least, of, n, ps, odd), enough of them to join all groups; None: none."""
    pairs, found = missed_pairs(nodes, least), []
    for side in "uv":
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("least").alias(f"{side}_least")), side)
    pairs = cut(pairs)
    swept(docs.sparkSession)
    names = ["u", "v", "u_least", "v_least"]
    # first the likeliest pair of a node and another group, which joins most of what there is to join; then all the rest
    ranked = pairs.withColumn("place", F.row_number().over(Window.partitionBy("u", "v_of").orderBy(F.desc("shared"), "v")))
    first = cut(ranked.filter("place = 1").select(*names, "u_of", "v_of"))
    if first.isEmpty():
        return None
    found.append(cut(verified(first.select(names), docs, least)))
    joined = components(found[0].join(pairs, names).select(F.col("u_of").alias("u"), F.col("v_of").alias("v")))
    rest = pairs.join(first.select("u", "v"), ["u", "v"], "left_anti")
    for side in "uv":
        rest = rest.join(joined.toDF(f"{side}_of", f"{side}_in"), f"{side}_of", "left").withColumn(f"{side}_in", F.coalesce(f"{side}_in", f"{side}_of"))
    rest = cut(rest.filter("u_in <> v_in").select(names))
    if not rest.isEmpty():
        found.append(cut(verified(rest, docs, least)))
    return reduce(DataFrame.union, found).select(F.col("u_least").alias("u"), F.col("v_least").alias("v"))


def similar_groups(docs: DataFrame, least: float = LEAST_SIMILAR) -> DataFrame:
    """doc_id and component_id, the smallest doc_id reachable over links, of all rows with an id.

    Texts with the same set of five-word shingles are linked, and texts whose sets have a Jaccard similarity of `least`
    or more: similar_links() and missed_links() propose, the whole texts' sets decide. Texts of one id are one document.
    """
    short_batches(docs.sparkSession)
    prints = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("t"), docs["text"])
    prints = cut(prints.mapInArrow(thrifty(_copy_prints(*common_shingles(docs), least)), "doc_id long, t long, c string, f long, n int, ks array<long>, ps array<long>, odd array<long>").filter("doc_id is not null"))
    nodes = prints.groupBy("c").agg(F.min(F.struct("doc_id", "t")).alias("rep"), F.first("f").alias("f"), F.first("n").alias("n"), F.first("ks").alias("ks"), F.first("ps").alias("ps"), F.first("odd").alias("odd"))
    nodes = cut(nodes.select("c", _node(F.col("rep.doc_id"), F.col("rep.t")).alias("node"), F.col("rep.doc_id").alias("least"), "f", "n", "ks", "ps", "odd"))
    prints = cut(prints.select("doc_id", "c"))
    same_id = prints.groupBy("doc_id").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high").select("doc_id")
    # a document of several texts joins their groups
    of_one = prints.join(same_id, "doc_id", "left_semi").select("doc_id", "c").distinct().join(nodes.select("c", "least"), "c").select(F.col("doc_id").alias("u"), F.col("least").alias("v"))
    edges = cut(similar_links(nodes, docs, least).union(of_one))
    swept(docs.sparkSession)
    found = cut(components(edges).toDF("least", "component"))
    nodes = cut(nodes.join(found, "least", "left").select("c", "node", "least", F.coalesce("component", "least").alias("of"), "n", "ps", "odd"))
    swept(docs.sparkSession)
    missed = missed_links(nodes, docs, least)
    swept(docs.sparkSession)
    if missed is not None:
        found = cut(components(edges.union(missed)).toDF("least", "component"))
    of = nodes.select("c", "least").join(found, "least", "left").select("c", F.coalesce("component", "least").alias("component_id"))
    return prints.select("doc_id", "c").join(of, "c").select("doc_id", "component_id")


def deduplicated(docs: DataFrame, least: float = LEAST_SIMILAR) -> DataFrame:
    """One document of each group of similar_groups(), the one with the smallest id; a row whose id is null stays.

    All columns of docs are returned as they came. Of rows with the same id one stays.
    """
    found = cut(similar_groups(docs, least))
    gone = small(cut(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("__id")).distinct()))
    left = docs.join(gone, docs["doc_id"] == gone["__id"], "left_anti")
    # ids of repeated rows, of which one row stays; mostly there are none, and texts need no shuffle
    twice = cut(found.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("__id")))
    if twice.isEmpty():
        return left
    twice = small(twice)
    again = left.join(twice, left["doc_id"] == twice["__id"], "left_semi")
    one = again.groupBy(F.col("doc_id").alias("__id")).agg(F.min_by(F.struct(*(again[c] for c in docs.columns)), F.xxhash64("text")).alias("__row")).select("__row.*")
    return left.join(twice, left["doc_id"] == twice["__id"], "left_anti").unionByName(one)
