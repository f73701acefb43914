"""Benchmark decontamination by greedy string tiling.

1. Words (lower case, punctuation apart) of items and documents are hashed; Karp-Rabin hashes of every window of
   `least` words are the seeds. A bitmap of all the items' seeds (2 to 32 MB, whatever the number of items) lets
   documents drop windows that no item has.
2. Remaining windows join the items' seeds, and a pair of document and item goes on if the item's windows that were
   met could cover the threshold. Windows that many items share (boilerplate) aren't joined where an item can spare
   them: so few that a document which covers the threshold is met by another window.
3. For each such pair the tiling repeats: find the longest unmarked common run by running Karp-Rabin hashes, mark it,
   until no run of `least` words is left. Runs may stand in any order, so passages that were shuffled still count.
4. The covered share of the item's words is compared with the threshold.

Defined results: null and empty texts and items of fewer than `least` words never match; an item that stands twice is
reported under each id, repeated document rows are reported once; other columns are ignored. Ids may be null (such
rows are never reported). An empty benchmark gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.llm.common import cut, slices, small

LEAST_WORDS = 5
COVERAGE = 0.6
#: The seed bitmap has at least and at most two to these powers of bits (2 and 32 MB).
BITMAP_BITS = (24, 28)
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Two primes below 2^31 for the hashes of runs.
MODULI = (np.uint64(2**31 - 1), np.uint64(2**31 - 19))
#: A window that more items than this have needn't be joined where an item can spare it.
HOT_ITEMS = 16
#: Items that a document is compared with at a time, about.
ITEMS_AT_A_TIME = 32
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def tokens(text: bytes) -> list[bytes]:
    """Words in lower case; every ASCII character but letters and digits parts them."""
    return text.lower().translate(_PLAIN).split()


def windows(words: list[bytes], least: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of `least` words, as signed 64-bit numbers."""
    n = len(words) - least + 1
    if n < 1:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(crc32, words), np.uint64, len(words))
    out = h[:n].copy()
    for i in range(1, least):
        out *= BASE
        out += h[i : i + n]
    out ^= out >> np.uint64(29)
    return (out * BASE).view(np.int64)


class Runs:
    """Karp-Rabin hashes of all runs of a sequence of word numbers: one of any length from two sums of prefixes."""

    def __init__(self, numbers: np.ndarray, powers: list[np.ndarray]):
        self.powers, n = powers, len(numbers)
        self.sums = []
        for p, power in zip(MODULI, powers, strict=True):
            s = np.cumsum(power[:n] * numbers.astype(np.uint64) % p)
            self.sums.append(np.concatenate([[0], s % p]).astype(np.uint32))

    def hashes(self, starts: np.ndarray, length: int) -> np.ndarray:
        out = None
        for p, power, s in zip(MODULI, self.powers, self.sums, strict=True):
            # a later start has higher powers of the base; all are brought to the highest
            h = (s[starts + length] + p - s[starts]) * power[len(power) - 1 - starts] % p  # p makes these 64 bits wide
            out = h if out is None else out << np.uint64(32) | h
        return out


def _powers(n: int) -> list[np.ndarray]:
    """The powers of the base from 0 to n, for each modulus."""
    out = []
    for p in MODULI:
        x = np.ones(n + 1, np.uint64)
        size, step = 1, int(BASE) % int(p)
        while size <= n:
            more = min(size, n + 1 - size)
            x[size : size + more] = x[:more] * np.uint64(step) % p
            size, step = size * 2, step * step % int(p)
        out.append(x.astype(np.uint32))
    return out


def _reach(free: np.ndarray, place: np.ndarray) -> np.ndarray:
    """How many free words stand side by side from each one on."""
    if not len(free):
        return np.zeros(0, np.int64)
    ends = np.append(np.flatnonzero((np.diff(place) != 1) | ~free[1:] | ~free[:-1]) + 1, len(free))
    out = np.repeat(ends, np.diff(np.concatenate([[0], ends]))) - np.arange(len(free))
    return np.where(free, out, 0)


def tiles(doc: list[bytes], item: list[bytes], least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in doc, start in item, words) of non-overlapping common runs, longest first.

    Each round finds the longest length that any common run of unmarked words has, by halving over lengths with sorted
    sets of Karp-Rabin hashes, and marks the runs of that length. Pairs of places are never listed, so memory is that
    of both texts and a round takes time in proportion to them; the rounds' lengths all differ, so there are at most
    about the square root of twice the item's words.
    """
    number = {w: i for i, w in enumerate(dict.fromkeys(item), 1)}
    y = np.fromiter(map(number.__getitem__, item), np.int64, len(item))
    x = np.fromiter(map(number.get, doc, repeat(0)), np.int32, len(doc))
    place = np.flatnonzero(x)
    place = place[_in_runs(place, least)]
    x = x[place].astype(np.int64)
    if len(x) < least or len(y) < least:
        return []
    powers = _powers(max(len(x), len(y)))
    in_doc, in_item = Runs(x, powers), Runs(y, powers)
    free_doc, free_item, line = np.ones(len(x), bool), np.ones(len(y), bool), np.arange(len(y))
    out: list[tuple[int, int, int]] = []
    top = len(y)
    while True:
        reach_doc, reach_item = _reach(free_doc, place), _reach(free_item, line)

        def common(length: int, within: np.ndarray, reach_doc: np.ndarray = reach_doc, reach_item: np.ndarray = reach_item) -> tuple[np.ndarray, np.ndarray]:
            """Starts in the document, among those given, of runs that the item has too, and their hashes."""
            known = np.unique(in_item.hashes(np.flatnonzero(reach_item >= length), length))
            found = [(within[:0], known[:0])]
            for i in range(0, len(within) if len(known) else 0, 1 << 16):
                starts = within[i : i + (1 << 16)]
                starts = starts[reach_doc[starts] >= length]
                h = in_doc.hashes(starts, length)
                there = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
                found.append((starts[there], h[there]))
            return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])

        starts, h = common(least, np.arange(len(x)))
        if not len(starts):
            return out
        low, high = least, min(top, int(reach_doc.max()), int(reach_item.max()))
        while low < high:
            middle = (low + high + 1) // 2
            longer = common(middle, starts)
            if len(longer[0]):
                low, (starts, h) = middle, longer
            else:
                high = middle - 1
        at: dict[int, list[int]] = defaultdict(list)
        places = np.flatnonzero(reach_item >= low)
        for k, b in zip(in_item.hashes(places, low)[::-1].tolist(), places[::-1].tolist(), strict=True):
            at[k].append(b)
        alive, done, marked = len(np.unique(h)), 0, bytearray(len(y))
        for d, k in ((d, k) for i in range(0, len(h), 1 << 14) for d, k in zip(starts[i : i + (1 << 14)].tolist(), h[i : i + (1 << 14)].tolist(), strict=True)):
            left = at.get(k)
            if d < done or not left:
                continue
            # runs of a round are equally long, so one that overlaps another holds one of its ends
            while left and (marked[left[-1]] or marked[left[-1] + low - 1]):
                left.pop()
            same = next((i for i in range(len(left) - 1, -1, -1) if not marked[left[i]] and not marked[left[i] + low - 1] and np.array_equal(x[d : d + low], y[left[i] : left[i] + low])), None) if left else None
            if same is not None:  # hashes propose, the words decide
                b = left.pop(same)
                marked[b : b + low] = b"\1" * low
                free_doc[d : d + low] = free_item[b : b + low] = False
                out.append((int(place[d]), b, low))
                done = d + low
            if not left:
                alive -= 1
                if not alive:
                    break
        top = low - 1
        if top < least:
            return out


def _in_runs(place: np.ndarray, least: int) -> np.ndarray:
    """Which of the ascending places stand in a run of at least so many."""
    if not len(place):
        return np.zeros(0, bool)
    ends = np.append(np.flatnonzero(np.diff(place) != 1) + 1, len(place))
    sizes = np.diff(np.concatenate([[0], ends]))
    return np.repeat(sizes >= least, sizes)


def coverage(doc: list[bytes], item: list[bytes], least: int = LEAST_WORDS) -> float:
    """The share of the item's words that tiles cover."""
    return sum(n for _, _, n in tiles(doc, item, least)) / len(item) if item else 0.0


def _seeds(least: int, bitmap: bytes | None):
    bits = np.frombuffer(bitmap, np.uint8) if bitmap is not None else None
    mask = np.int64(len(bitmap) * 8 - 1) if bitmap is not None else np.int64(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            ids, all_ids, found, sizes, times = part.column(0).to_pylist(), [], [], [], []
            for x, text in zip(ids, texts, strict=True):
                if x is None:
                    continue
                w = tokens(text)
                h = windows(w, least)
                if bits is not None:
                    low = h & mask
                    h = h[bits[low >> 3] >> (low & 7).astype(np.uint8) & 1 == 1]
                h, n = np.unique(h, return_counts=True)
                if len(h):
                    all_ids.append(np.full(len(h), x, np.int64))
                    found.append(h)
                    sizes.append(np.full(len(h), len(w), np.int32))
                    times.append(n.astype(np.int32))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(all_ids)), pa.array(np.concatenate(found)), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(times))], ["id", "h", "n", "times"])

    return run


def _bitmap(seeds: DataFrame) -> bytes:
    """One bit for each low part of a seed, some 64 bits a seed within bounds; gathered in pieces of 4 KB (8192 at most)."""
    power = min(BITMAP_BITS[1], max(BITMAP_BITS[0], (64 * seeds.count()).bit_length()))
    low = F.col("h").bitwiseAND(F.lit((1 << power) - 1))
    out = bytearray(1 << (power - 3))
    for row in seeds.select(F.shiftright(low, 15).alias("part"), (low % (1 << 15)).alias("bit")).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        out[row.part << 12 : (row.part << 12) + len(row.bits)] = row.bits
    return bytes(out)


def _tiled(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            rows = []
            for x, t, items in zip(part.column(0).to_pylist(), texts, part.column(part.schema.get_field_index("items")), strict=True):
                doc = tokens(t)
                rows += [(x, i["item_id"], coverage(doc, tokens((i["item_text"] or "").encode()), least)) for i in items.as_py()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["doc_id", "item_id", "coverage"])

    return run


def needed_windows(seeds: DataFrame, least: int, threshold: float, hot_items: int = HOT_ITEMS) -> DataFrame:
    """Windows of items (id, h, n, times) without the hottest that an item can spare; spared is how many it did.

    Windows met cover at most `least` words each, so a document that covers the threshold has so many of the item's
    windows that at least one is left when fewer are gone.
    """
    items = seeds.groupBy("h").agg(F.count("*").alias("items"))
    order = Window.partitionBy("id").orderBy(F.desc("items"), "h").rowsBetween(Window.unboundedPreceding, 0)
    spare = (F.col("items") > hot_items) & (F.sum("times").over(order) <= F.ceil(F.col("n") * threshold / least) - 1)
    ranked = seeds.join(items, "h").withColumn("spare", spare)
    gone = F.sum(F.when(F.col("spare"), F.col("times")).otherwise(0)).over(Window.partitionBy("id"))
    return ranked.withColumn("spared", gone).filter(~F.col("spare")).select("id", "h", "n", "times", "spared")


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = LEAST_WORDS, threshold: float = COVERAGE, hot_items: int = HOT_ITEMS) -> DataFrame:
    """doc_id, item_id and coverage of every pair in which the document holds at least the threshold of the item."""
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"])
    ours = cut(needed_windows(items.mapInArrow(_seeds(least, None), "id long, h long, n int, times int"), least, threshold, hot_items))
    met = texts.mapInArrow(_seeds(least, _bitmap(ours)), "id long, h long, n int, times int").select(F.col("id").alias("doc_id"), "h")
    pairs = met.join(ours.withColumnRenamed("id", "item_id"), "h").groupBy("doc_id", "item_id").agg(F.sum("times").alias("met"), F.min("n").alias("n"), F.max("spared").alias("spared"))
    # every run of r words has r - least + 1 windows, so m windows cover at most m * least words
    pairs = cut(pairs.filter((F.col("met") + F.col("spared")) * least >= F.col("n") * threshold).select("doc_id", "item_id"))
    held = texts.join(small(pairs.select("doc_id").distinct()), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    # a text travels once for about ITEMS_AT_A_TIME items
    parts = pairs.groupBy("doc_id").agg(F.ceil(F.count("*") / ITEMS_AT_A_TIME).alias("parts"))
    told = pairs.join(parts, "doc_id").withColumn("part", F.pmod(F.xxhash64("item_id"), F.col("parts"))).join(items.select("item_id", F.col("text").alias("item_text")).distinct(), "item_id")
    grouped = told.groupBy("doc_id", "part").agg(F.collect_list(F.struct("item_id", "item_text")).alias("items"))
    share = grouped.join(held, "doc_id").select("doc_id", "text", "items").mapInArrow(_tiled(least), "doc_id long, item_id long, coverage double")
    return share.filter(F.col("coverage") >= threshold).groupBy("doc_id", "item_id").agg(F.max("coverage").alias("coverage"))


def cleaned(docs: DataFrame, benchmark: DataFrame, least: int = LEAST_WORDS, threshold: float = COVERAGE) -> DataFrame:
    """docs without the contaminated ones; a row whose id is null stays. All columns are returned as they came."""
    gone = small(cut(contaminated(docs, benchmark, least, threshold).select(F.col("doc_id").alias("__gone")).distinct()))
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
