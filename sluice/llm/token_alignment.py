"""Alignment of two tokenizers' tokens: groups between common ends, links of overlapping tokens, counts of linked ids.

Tokens cover the same bytes twice. The alignment is relational: tokens are exploded with their places, a windowed sum
of their lengths gives each its end, tokens of both sides meet by text and end (a cut is where both end), running counts
of cuts number the groups, and each stretch between neighbouring ends is one link, of the two tokens that cover it. The
sides meet by grouping on (text, end), a full outer equi-join of two sides that have an end once at most: unlike the
join it keeps the partitions by text, so that nothing is shuffled after the tokens were exploded. Neighbours come from
the window that counts cuts; a range join would pair all tokens of a group that has no common end within.

Neither tokenizer's tokens cross a single space between two words, and what stands before it doesn't change what comes
after; so a text's alignment is the chain of its words' alignments, and each different word is tokenised and aligned
once. Texts are coded into blocks first: a block holds its different words once, with their counts, and each text as
numbers of words. A word is a row a block then, however frequent, so nothing that is joined by word has a hot key, and
no text is shuffled as tokens. Tokenizers for which that doesn't hold (see separable()) get whole texts for words.

Defined results: a null or empty text, and one whose tokens' bytes aren't those of a space and the text, has no tokens
and counts for nothing; repeated rows are repeated and count each time; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import uuid
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import give_back, shared_folder, short_batches, small, swept, thrifty

#: Before a single space between two characters that aren't white space.
CUT = re.compile(r" (?<=\S )(?=\S)")
#: Different words, and words, after which a block is closed.
MOST_DIFFERENT, MOST_WORDS = 1 << 18, 1 << 22
#: Words, and texts, of a block that one row holds.
ROW_WORDS, ROW_TEXTS = 1 << 13, 1 << 7
#: Words that are tokenised in one call, and characters of the output that are held.
CALL_WORDS, OUT_CHARS = 2048, 1 << 24
#: Counted pairs of ids up to which they are broadcast (some 80 MB); more are joined by shuffle.
MOST_PAIRS = 2_000_000
FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
CODED = "block long, start int, words array<string>, counts array<long>, doc_ids array<long>, codes array<array<int>>"
DICTIONARY = "seg long, word string, n long, tokens array<int>"
#: A token in one number: id, length (bits below) and side (0: A, 1: B; one bit).
ID_BITS, LENGTH_BITS = 18, 12


def cut_words(text: str) -> list[str]:
    """As CUT.split(text).

    Printable text has no white space but spaces; then, and with line feeds that touch no space, every space is a cut.
    """
    if text[:1] == " " or text[-1:] == " " or "  " in text or " \n" in text or "\n " in text or not text.replace("\n", "").isprintable():
        return CUT.split(text)
    return text.split(" ")


def numbering() -> defaultdict[str, int]:
    """Numbers words in the order in which they are first looked up."""
    numbers: defaultdict[str, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    return numbers


class Splitter:
    """Cuts texts into words; it needs B alone."""

    def __init__(self, b: bytes, separable: bool):
        from sentencepiece import SentencePieceProcessor

        self.b, self.separable = SentencePieceProcessor(model_proto=b), separable

    def words(self, text: str | None) -> list[str] | None:
        """The words of a text, or None if it has no tokens by definition."""
        if not text or "▁" in text or self.b.normalize(text).replace("▁", " ") != " " + text:
            return None
        return cut_words(text) if self.separable else [text]


class Tokenizers(Splitter):
    """A (a byte-level BPE of the tokenizers library) and B (a sentencepiece model), from their files' contents."""

    def __init__(self, a: str, b: bytes):
        from tokenizers import Tokenizer

        super().__init__(b, False)
        self.a = Tokenizer.from_str(a)
        self.a.encode_special_tokens = True
        names = self.a.get_vocab(with_added_tokens=True)
        self.a_lens = np.zeros(max(names.values()) + 1, np.int64)
        for name, i in names.items():
            self.a_lens[i] = len(name)  # a character stands for a byte
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_lens = np.array([1 if self.b.is_byte(i) else len(p.replace("▁", " ").encode()) for i, p in enumerate(pieces)], np.int64)
        if max(len(self.a_lens), len(self.b_lens)) > 1 << ID_BITS or max(self.a_lens.max(), self.b_lens.max()) >= 1 << LENGTH_BITS:
            raise ValueError("the vocabularies are larger, or their tokens longer, than a number holds")
        before = json.loads(a)["pre_tokenizer"] or {}
        self.separable = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not any("▁" in p.lstrip("▁") for p in pieces)

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, np.int64), np.array(self.b.encode(text, num_threads=1), np.int64)

    def flat(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and B, the ids of all words' tokens in order within a word, and the number of each one's word.

        Words that can stand side by side are tokenised in one call.
        """
        alone = [i for i, w in enumerate(words) if not self.separable or w[0].isspace() or w[-1].isspace()]
        apart = set(alone)
        chain = [i for i in range(len(words)) if i not in apart] if alone else range(len(words))
        text = " ".join([words[i] for i in chain]) if alone else " ".join(words)
        ends = np.cumsum([len(words[i].encode()) + 1 for i in chain], dtype=np.int64)
        one_by_one = [self.of(words[i]) for i in alone]
        out = []
        for side, (ids, lens) in enumerate(zip(self.of(text) if len(ends) else (np.zeros(0, np.int64),) * 2, (self.a_lens, self.b_lens), strict=True)):
            token_ends = np.cumsum(lens[ids])
            of = np.searchsorted(ends, token_ends)
            if len(ends) and not np.array_equal(token_ends.take(np.searchsorted(token_ends, ends), mode="clip"), ends):
                raise ValueError("tokens cross a word's end")
            own = [pair[side] for pair in one_by_one]
            out.append((np.concatenate([ids, *own]), np.concatenate([np.array(chain, np.int64)[of], np.repeat(np.array(alone, np.int64), [len(x) for x in own])])))
        return out


def _code(b: bytes, separable: bool, most_different: int, most_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, made = Splitter(b, separable), 0
        part = TaskContext.get().partitionId()
        numbers = numbering()
        ids: list[int | None] = []
        codes: list[array | None] = []
        n_words = 0

        def row(start: int, words: pa.Array, counts: pa.Array, doc_ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
            listed = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (words, counts, doc_ids, texts)]
            return pa.RecordBatch.from_arrays([pa.array([part << 24 | made], pa.int64()), pa.array([start], pa.int32()), *listed], [x.split()[0] for x in CODED.split(", ")])

        def block() -> Iterator[pa.RecordBatch]:
            counts, every = np.zeros(len(numbers), np.int64), pa.list_(pa.int32())
            for at in range(0, len(ids), ROW_TEXTS):
                own = codes[at : at + ROW_TEXTS]
                flat = np.concatenate([np.zeros(0, np.int32), *(np.frombuffer(c, np.int32) for c in own if c is not None)])
                counts += np.bincount(flat, minlength=len(numbers))
                ends = np.cumsum([0, *(0 if c is None else len(c) for c in own)]).astype(np.int32)
                texts = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=pa.array([c is None for c in own]))
                yield row(0, pa.array([], pa.string()), pa.array([], pa.int64()), pa.array(ids[at : at + ROW_TEXTS], pa.int64()), texts)
            words = list(numbers)
            for at in range(0, len(words), ROW_WORDS):
                yield row(at, pa.array(words[at : at + ROW_WORDS], pa.string()), pa.array(counts[at : at + ROW_WORDS]), pa.array([], pa.int64()), pa.array([], every))

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                    words = both.words(text)
                    ids.append(doc_id)
                    codes.append(None if words is None else array("i", map(numbers.__getitem__, words)))
                    n_words += len(words or ())
                    if len(numbers) >= most_different or n_words >= most_words or len(ids) >= most_words:
                        yield from block()
                        numbers, ids, codes, n_words, made = numbering(), [], [], 0, made + 1
        if ids:
            yield from block()

    return run


def _tokens(a: str, b: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, part, done = Tokenizers(a, b), TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, CALL_WORDS):
                rows = batch.slice(start, CALL_WORDS)
                sides = both.flat(rows.column(0).to_numpy(zero_copy_only=False).tolist())
                packed = [ids << LENGTH_BITS + 1 | lens[ids] << 1 | side for side, ((ids, _), lens) in enumerate(zip(sides, (both.a_lens, both.b_lens), strict=True))]
                of = np.concatenate([2 * of + side for side, (_, of) in enumerate(sides)])
                ends = np.concatenate([[0], np.cumsum(np.bincount(of >> 1, minlength=rows.num_rows))]).astype(np.int32)
                tokens = np.concatenate(packed)[np.argsort(of, kind="stable")].astype(np.int32)
                seg = part << 40 | done
                done += rows.num_rows
                out = [pa.array(np.arange(seg, seg + rows.num_rows)), rows.column(0), rows.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens))]
                yield pa.RecordBatch.from_arrays(out, [x.split()[0] for x in DICTIONARY.split(", ")])

    return run


def token_ends(words: DataFrame) -> DataFrame:
    """seg, n, end, and the ids a and b of the tokens that end there (null: none)."""
    tokens = words.select("seg", "n", "tokens").repartition("seg").select("seg", "n", F.posexplode("tokens").alias("at", "t"))
    side, length = F.col("t").bitwiseAND(1).alias("side"), F.shiftright("t", 1).bitwiseAND((1 << LENGTH_BITS) - 1).alias("length")
    tokens = tokens.select("seg", "n", "at", side, length, F.shiftright("t", LENGTH_BITS + 1).alias("id"))
    so_far = Window.partitionBy("seg", "side").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ended = tokens.select("seg", "n", "side", "id", F.sum("length").over(so_far).alias("end"))
    return ended.groupBy("seg", "n", "end").agg(F.max(F.when(F.col("side") == 0, F.col("id"))).alias("a"), F.max(F.when(F.col("side") == 1, F.col("id"))).alias("b"))


def aligned_words(words: DataFrame) -> DataFrame:
    """seg, n, groups (`a1,a2|b1;a3|b2,b3`), n_a, n_b, n_groups and links (array of a and b) of each word."""
    ends = token_ends(words)
    # from the text's end on: the last id met is the one that covers the stretch before an end, and cuts met so far
    # number the groups backwards
    back = Window.partitionBy("seg").orderBy(F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    cut = (F.col("a").isNotNull() & F.col("b").isNotNull()).cast("int")
    met = ends.select("seg", "n", "end", "a", "b", F.sum(cut).over(back).alias("left"), F.struct(F.last("a", True).over(back).alias("a"), F.last("b", True).over(back).alias("b")).alias("link"))

    def ids(side: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col(side).isNotNull(), F.struct("end", F.col(side).alias("id")))))

    def said(of: str) -> Column:
        return F.array_join(F.transform(of, lambda x: x["id"].cast("string")), ",")

    groups = met.groupBy("seg", "n", "left").agg(ids("a").alias("as"), ids("b").alias("bs"), F.collect_list("link").alias("links"))
    groups = groups.select("seg", "n", F.struct((-F.col("left")).alias("at"), F.concat(said("as"), F.lit("|"), said("bs")).alias("said")).alias("group"), F.size("as").alias("n_a"), F.size("bs").alias("n_b"), "links")
    whole = groups.groupBy("seg", "n").agg(F.array_sort(F.collect_list("group")).alias("g"), F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"), F.count("*").alias("n_groups"), F.flatten(F.collect_list("links")).alias("links"))
    return whole.select("seg", "n", F.array_join(F.transform("g", lambda x: x["said"]), ";").alias("groups"), "n_a", "n_b", "n_groups", "links")


def linked(met: DataFrame) -> DataFrame:
    """a, b and count of linked ids: how many links of all texts hold them."""
    return met.select("n", F.explode("links").alias("l")).groupBy(F.col("l.a").alias("a"), F.col("l.b").alias("b")).agg(F.sum("n").alias("count"))


def _assemble(left: pa.Table, right: pa.Table) -> pa.Table:
    """The texts of a block from its words' figures."""
    give_back()  # what the block before left
    order = np.argsort(right.column("at").to_numpy())
    said = right.column("groups").combine_chunks().take(pa.array(order)).to_pylist()
    known = {f: right.column(f).to_numpy()[order] for f in ("n_a", "n_b", "n_best", "count_sum")}
    known["n_groups"] = np.fromiter((g.count(";") + 1 for g in said), np.int64, len(said))
    known["n_links"] = known["n_a"] + known["n_b"] - known["n_groups"]  # as many stretches as ends
    figures = [known[f] for f in FIGURES]
    out, names = [], ["doc_id", *FIGURES, "groups"]

    def packed(ids: list, codes: list[np.ndarray], groups: list[str]) -> pa.RecordBatch:
        flat, ends = np.concatenate([np.zeros(0, np.int64), *codes]).astype(np.int64), np.cumsum([0, *map(len, codes)])
        sums = []
        for f in figures:
            so_far = np.concatenate([[0], np.cumsum(f[flat])])
            sums.append(pa.array(so_far[ends[1:]] - so_far[ends[:-1]], pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *sums, pa.array(groups, pa.string())], names)

    held: tuple[list, list, list] = ([], [], [])
    size = 0
    for row in range(left.num_rows):
        ids, texts = left.column("doc_ids")[row].values, left.column("codes")[row].values
        for doc_id, text in zip(ids.to_pylist(), texts, strict=True):
            codes = text.values.to_numpy() if text.is_valid else np.zeros(0, np.int32)
            groups = ";".join(map(said.__getitem__, codes.tolist()))
            for to, x in zip(held, (doc_id, codes, groups), strict=True):
                to.append(x)
            size += len(groups)
            if size >= OUT_CHARS:
                out.append(packed(*held))
                held, size = ([], [], []), 0
    out.append(packed(*held))
    return pa.Table.from_batches(out)


def aligned(docs: DataFrame, a: str, b: bytes, most_different: int = MOST_DIFFERENT, most_words: int = MOST_WORDS) -> tuple[DataFrame, DataFrame]:
    """Texts with doc_id, FIGURES and groups; and the linked ids with their counts.

    a and b are the contents of the tokenizers' files; they go to the tasks with the code.
    """
    spark = docs.sparkSession
    short_batches(spark)
    folder = f"{shared_folder(spark)}/align-{uuid.uuid4().hex}"

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    coded = kept(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(thrifty(_code(b, Tokenizers(a, b).separable, most_different, most_words)), CODED), "coded")
    places = coded.select("block", "start", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select("block", (F.col("start") + F.col("at")).alias("at"), F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    words = kept(places.groupBy("word").agg(F.sum("n").alias("n")).mapInArrow(thrifty(_tokens(a, b)), DICTIONARY), "words")
    swept(spark)
    met = kept(aligned_words(words), "aligned")
    swept(spark)
    pairs = kept(linked(met), "pairs")
    most = pairs.groupBy("b").agg(F.max("count").alias("most"))  # at most a row for each id of B
    judged = pairs.join(F.broadcast(most), "b").select("a", "b", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))
    of_links = met.select("seg", F.explode("links").alias("l")).select("seg", "l.a", "l.b").join(small(judged, MOST_PAIRS), ["a", "b"]).groupBy("seg").agg(F.sum("best").alias("n_best"), F.sum("count").alias("count_sum"))
    figures = words.select("seg", "word").join(met.drop("links", "n", "n_groups"), "seg").join(of_links, "seg").drop("seg")
    figures = kept(figures, "figures")
    swept(spark, f"{folder}/words", f"{folder}/aligned")
    of_places = kept(places.select("block", "at", "word").join(figures, "word").drop("word"), "places")
    swept(spark, f"{folder}/figures")
    kind = ", ".join(["doc_id long", *(f"{f} long" for f in FIGURES), "groups string"])
    texts = coded.filter(F.size("doc_ids") > 0).select(F.col("block").alias("of_block"), "doc_ids", "codes").groupBy("of_block").cogroup(of_places.groupBy("block")).applyInArrow(_assemble, kind)
    return texts, judged


def digests(texts: DataFrame) -> DataFrame:
    """As aligned()'s texts, with the SHA-256 of the groups in place of them; '' without tokens."""
    return texts.select("doc_id", *FIGURES, F.when(F.col("n_groups") == 0, "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"))


def file_contents(a: str, b: str) -> tuple[str, bytes]:
    """The contents of the tokenizers' files (under 2 MB and 1 MB, fixed by the files)."""
    with open(a, encoding="utf-8") as first, open(b, "rb") as second:
        return first.read(), second.read()
