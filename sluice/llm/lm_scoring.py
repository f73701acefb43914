"""A log-bilinear language model, trained with noise-contrastive estimation, scores whole texts.

Every word of LEAST_OWN occurrences or more (at most MOST_OWN) has a vector, which stands for it as context and as
output alike. A context vector is the sum over the last CONTEXT words of their vectors times a vector of the position,
and the mean of the last MEMORY words' vectors times one more (which trains only the latter). Its product with an output's vector plus a bias is the
output's score, normalised in two steps: among the most frequent words, the text's end and classes of all other words
(by a checksum of their first bytes), then within the class among its words with vectors and one symbol for its rest.
Words of the rest share its probability by their counts less a discount; what that frees is the class's unseen word,
one symbol as in the base score. So the probabilities of all words and the unseen ones sum to one.

1. Counts of all words of all learning documents (partial sums in tasks, then a shuffle by word).
2. Words of a high count, at most HEAD_WORDS, go to all tasks; rarer ones stay in the table of counts.
3. Training: documents fall into shards of about SHARD_TOKENS words by a hash of id and text, however the input is
   partitioned, and each shard's documents stand in the order of that hash. Every round takes its share of the shards;
   each trains a copy in numpy in that order, and a vector's copies are averaged by its occurrences, in whole numbers,
   whose sums don't depend on their order.
4. Scoring: batched matrix products give all outputs' scores, and their log-sum the normaliser. Counts of rare words
   come by a join on the word.

Defined results: a null or empty text has one token, its end; a null id counts as the empty text for the split;
repeated rows are scored each; without learning documents every token's base probability is one; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import SLICE, cut, remainder

#: Words whose counts all tasks have, at most.
HEAD_WORDS = 1 << 16
#: Occurrences from which on a word has a vector, and how many words have one at most.
LEAST_OWN, MOST_OWN = 4, 1 << 15
#: Words that are outputs of the first step, and classes of the others. With the end: 256 outputs.
OWN_WORDS, CLASSES = 63, 192
CONTEXT, MEMORY, WIDTH = 2, 64, 16
#: Shares of the shards that each round trains on, of 16.
ROUNDS = (2, 14)
SHARD_TOKENS = 2_000_000
NOISE, CLASS_NOISE, BATCH, RATE = 24, 2, 4096, 0.3
#: Scores of outputs that are normalised at a time: they stay in a core's cache, and BLAS multiplies matrices this small faster.
AT_ONCE = 3 << 14
#: Averages are sums of whole numbers: values by this, times occurrences up to MOST_WEIGHT.
UNIT, MOST_WEIGHT = 1 << 15, 256
#: Different words that a task counts before it hands them on, at least; it holds three times as many counts at most.
HELD_WORDS = 300_000
#: The end of a text in the table of counts (words are never empty).
END_WORD = b""


def word_class(word: bytes) -> int:
    return crc32(word[:3]) % CLASSES


def _pieces(texts: pa.Array) -> pa.Array:
    """Each text's words with A-Z in lower case; there are empty ones beside white space at a text's ends.

    Arrow's ASCII white space is \x20 and \x09 to \x0D.
    """
    return pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of SLICE rows of the batches with their texts' pieces."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            yield part, _pieces(part.column(part.schema.get_field_index("text")))


def _binary(strings: pa.Array) -> pa.Array:
    return strings.cast(pa.large_binary() if pa.types.is_large_string(strings.type) else pa.binary())


class Words:
    """The different words of some texts, and all their words as numbers of these, text by text."""

    def __init__(self, pieces: pa.Array):
        coded = pieces.flatten().dictionary_encode()
        self.listed = _binary(coded.dictionary)
        self.different = self.listed.to_numpy(zero_copy_only=False).tolist()
        codes = coded.indices.to_numpy()
        of = np.repeat(np.arange(len(pieces)), np.diff(pieces.offsets.to_numpy()))
        full = np.array(list(map(len, self.different)), np.int64)[codes] > 0
        self.codes, self.of = codes[full], of[full]
        self.sizes = np.bincount(self.of, minlength=len(pieces))

    def ended(self, rows: np.ndarray, end: int) -> list[np.ndarray]:
        """Each text as the rows of its words, given those of the different ones, and the end's row."""
        out = np.full(len(self.codes) + len(self.sizes), end, np.int64)
        out[np.arange(len(self.codes)) + self.of] = rows[self.codes]
        return np.split(out, np.cumsum(self.sizes + 1)[:-1])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    n = texts = 0

    def summed() -> pa.Table:
        return pa.TableGroupBy(pa.concat_tables(held), "w", use_threads=False).aggregate([("c", "sum")]).rename_columns(["w", "c"])

    for part, pieces in _parts(batches):
        found = pieces.flatten().value_counts()
        words, counts = found.field(0), found.field(1)
        full = pc.greater(pc.binary_length(words), 0)
        held.append(pa.table({"w": words.filter(full).cast(pa.string()).cast(pa.binary()), "c": counts.filter(full)}))
        texts += part.num_rows
        n += held[-1].num_rows
        if n > 2 * HELD_WORDS:
            held = [summed()]
            n = held[0].num_rows
            if n > HELD_WORDS:
                yield from held[0].to_batches()
                held, n = [], 0
    if texts:
        held.append(pa.table({"w": pa.array([END_WORD], pa.binary()), "c": pa.array([texts], pa.int64())}))
        yield from summed().to_batches()


class Vocabulary:
    """Rows of the words with vectors and of the other symbols, and which rows are normalised together.

    Rows are the first step's outputs (frequent words, END, the classes), then the start of a text, then the rest of
    each class, then the classes' words.
    """

    def __init__(self, counted: list[tuple[bytes, int]], ends: int, rest: np.ndarray):
        """counted: words with vectors, most frequent first; rest: occurrences of each class's other words."""
        own = counted[:OWN_WORDS]
        self.end, self.classes = OWN_WORDS, OWN_WORDS + 1
        self.n_first = self.classes + CLASSES
        self.start, self.rest = self.n_first, self.n_first + 1
        first_word = self.rest + CLASSES
        self.row = {w: i for i, (w, _) in enumerate(own)} | {w: i for i, (w, _) in enumerate(counted[OWN_WORDS:], first_word)}
        self.n_rows = first_word + max(0, len(counted) - OWN_WORDS)
        of = np.array([word_class(w) for w, _ in counted[OWN_WORDS:]], np.int64)
        self.class_of = np.full(self.n_rows, -1, np.int64)  # of the rows of the second step
        self.class_of[self.rest : first_word] = np.arange(CLASSES)
        self.class_of[first_word:] = of
        count = np.zeros(self.n_rows)
        count[: len(own)] = [c for _, c in own]
        count[self.end] = ends
        count[self.rest : first_word] = rest
        count[first_word:] = [c for _, c in counted[OWN_WORDS:]]
        count += 0.5
        count[self.classes : self.n_first] = np.bincount(self.class_of[self.rest :], count[self.rest :], CLASSES)
        # rows of a class side by side, and each row's share of what it is normalised with
        self.order = np.argsort(self.class_of[self.rest :], kind="stable") + self.rest
        self.bounds = np.searchsorted(self.class_of[self.order], np.arange(CLASSES + 1))
        share = np.ones(self.n_rows)
        share[: self.n_first] = count[: self.n_first] / count[: self.n_first].sum()
        share[self.rest :] = count[self.rest :] / count[self.classes : self.n_first][self.class_of[self.rest :]]
        self.log_share = np.log(share).astype(np.float32)
        self.first_sums = np.cumsum(share[: self.n_first])
        self.class_sums = np.cumsum(share[self.order])

    def rows(self, w: list[bytes]) -> np.ndarray:
        """The rows of words; a word without a vector has its class's rest."""
        out = np.fromiter(map(self.row.get, w, repeat(-1)), np.int64, len(w))
        other = np.flatnonzero(out < 0)
        out[other] = [self.rest + crc32(w[i][:3]) % CLASSES for i in other.tolist()]
        return out


@dataclass
class Parameters:
    """A vector and bias (the last column) for each row, and vectors of the context's positions (the last: the mean)."""

    table: np.ndarray
    position: np.ndarray

    @classmethod
    def fresh(cls, v: Vocabulary, seed: int = 11) -> Parameters:
        table = np.random.default_rng(seed).normal(0, 0.1, (v.n_rows, WIDTH + 1)).astype(np.float32)
        table[:, WIDTH] = v.log_share
        position = np.full((CONTEXT + 1, WIDTH), 0.5, np.float32)
        position[CONTEXT] = 2.0
        return cls(table, position)

    def copy(self) -> Parameters:
        return Parameters(self.table.copy(), self.position.copy())

    def weights(self) -> np.ndarray:
        """The positions' vectors with a zero for the bias."""
        return np.column_stack([self.position, np.zeros(CONTEXT + 1, np.float32)])


def _sums(x: np.ndarray) -> np.ndarray:
    """Sums of the rows before each place, column by column, as a column is read in one go."""
    out = np.zeros((x.shape[1], len(x) + 1), np.float64)
    out[:, 1:] = x.T
    return np.ascontiguousarray(np.cumsum(out, axis=1).T)


class Line:
    """Texts one after another, each as the rows of its words and END; the context of each place."""

    def __init__(self, texts: list[np.ndarray], start: int):
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        self.target = np.concatenate([np.zeros(0, np.int64), *texts])
        self.place = np.arange(len(self.target)) - np.repeat(ends - sizes, sizes)
        self.last = np.repeat(ends, sizes)
        at = np.arange(len(self.target))
        self.contexts = [np.where(self.place > i, self.target[np.maximum(at - i - 1, 0)], start) for i in range(CONTEXT)]
        self.back = np.minimum(self.place, MEMORY)

    def context(self, p: Parameters, part: slice) -> tuple[np.ndarray, list[np.ndarray]]:
        """Context vectors of a part of the places, each with a one for the bias, and what each position adds before it is weighed."""
        first = max(0, part.start - MEMORY)
        back = self.back[part]
        sums = _sums(p.table.take(self.target[first : part.stop], axis=0))
        at = np.arange(part.start, part.stop) - first
        mean = sums[part.start - first : part.stop - first] - sums.take(at - back, axis=0)
        mean /= np.maximum(back, 1)[:, None]
        seen = [*(p.table.take(c[part], axis=0) for c in self.contexts), mean.astype(np.float32)]
        weights = p.weights()
        q = seen[0] * weights[0]
        for x, w in zip(seen[1:], weights[1:], strict=True):
            q += x * w
        q[:, WIDTH] = 1
        return q, seen


class Trainer:
    """Noise-contrastive estimation with AdaGrad over batches of places."""

    def __init__(self, v: Vocabulary, p: Parameters, seed: int):
        self.v, self.p = v, p.copy()
        self.g = Parameters(np.full(p.table.shape, 1e-3, np.float32), np.full(p.position.shape, 1e-3, np.float32))
        self.rng = np.random.default_rng(seed)
        self.seen = np.zeros(v.n_rows, np.int64)
        self.tokens = 0

    @staticmethod
    def _errors(true: np.ndarray, false: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return 1 / (1 + np.exp(-true.clip(-30, 30))) - 1, 1 / (1 + np.exp(-false.clip(-30, 30)))

    def step(self, line: Line, part: slice) -> None:
        v, table = self.v, self.p.table
        row = line.target[part]
        n = len(row)
        self.tokens += n
        np.add.at(self.seen, row, 1)
        q, seen = line.context(self.p, part)
        # the first step: frequent words, the end and classes; noise is shared by the batch
        kind = v.class_of[row]
        target = np.where(kind < 0, row, v.classes + kind)
        np.add.at(self.seen, target[kind >= 0], 1)
        noise = np.minimum(np.searchsorted(v.first_sums, self.rng.random(NOISE) * v.first_sums[-1]), v.n_first - 1)
        log_noise = v.log_share + np.float32(np.log(NOISE))
        theirs, false = table.take(target, axis=0), table[noise]
        e_true, e_false = self._errors(np.einsum("ij,ij->i", q, theirs) - log_noise[target], q @ false.T - log_noise[noise])
        theirs *= e_true[:, None]
        dq = theirs
        dq += e_false @ false
        # what moves each place's own row: as an output here, as a context of the next places below
        own_values = e_true[:, None] * q
        rows, values = [row, noise], [own_values, e_false.T @ q]
        # the second step: words of a class, each place with noise of its own
        within = np.flatnonzero(kind >= 0)
        if len(within):
            k, own, qk = kind[within], row[within], q.take(within, axis=0)
            below = np.concatenate([[0.0], v.class_sums])
            low, high = below[v.bounds[k]], below[v.bounds[k + 1]]
            drawn = low[:, None] + self.rng.random((len(within), CLASS_NOISE)) * (high - low)[:, None]
            at = np.clip(np.searchsorted(v.class_sums, drawn), v.bounds[k][:, None], v.bounds[k + 1][:, None] - 1)
            noise = v.order[at]
            log_noise = v.log_share + np.float32(np.log(CLASS_NOISE))
            theirs, false = table.take(own, axis=0), table.take(noise, axis=0)
            e_true, e_false = self._errors(np.einsum("ij,ij->i", qk, theirs) - log_noise[own], np.einsum("ij,ikj->ik", qk, false) - log_noise[noise])
            theirs *= e_true[:, None]
            theirs += np.einsum("ik,ikj->ij", e_false, false)
            dq[within] += theirs
            rows += [target[within], noise.ravel()]
            values += [own_values.take(within, axis=0), (e_false[:, :, None] * qk[:, None, :]).reshape(-1, WIDTH + 1)]
            own_values[within] = e_true[:, None] * qk
        # the context's words
        weights = self.p.weights()
        for i, c in enumerate(line.contexts):
            d = dq * weights[i]
            early = np.flatnonzero(line.place[part] <= i)
            at_start = d.take(early, axis=0).sum(0)
            d[early] = 0
            own_values[: max(0, n - i - 1)] += d[i + 1 :]
            # the start of texts, and words before this part
            rows += [np.array([v.start]), c[part][: i + 1]]
            values += [at_start[None], d[: i + 1]]
        self._move(np.concatenate(rows), np.concatenate([x.T for x in values], axis=1, dtype=np.float64), n)
        d = np.stack([np.einsum("ij,ij->j", dq, x)[:WIDTH] for x in seen]) / n
        self.g.position += d * d
        self.p.position -= 0.5 * RATE * d / np.sqrt(self.g.position)

    def _move(self, rows: np.ndarray, values: np.ndarray, n: int) -> None:
        met = np.zeros(self.v.n_rows, bool)
        met[rows] = True
        at = np.flatnonzero(met)
        number = np.empty(self.v.n_rows, np.int64)
        number[at] = np.arange(len(at))
        of = number[rows]
        d = np.ascontiguousarray(np.array([np.bincount(of, x, len(at)) for x in values], np.float32).T)
        d /= np.float32(n)
        g = d * d
        g += self.g.table.take(at, axis=0)
        self.g.table[at] = g
        d *= RATE
        d /= np.sqrt(g, out=g)
        self.p.table[at] = np.subtract(self.p.table.take(at, axis=0), d, out=d)

    def learn(self, texts: list[np.ndarray]) -> None:
        line = Line(texts, self.v.start)
        for at in range(0, len(line.target), BATCH):
            self.step(line, slice(at, min(at + BATCH, len(line.target))))


def _trained(v: Vocabulary, p: Parameters):
    """Trains a copy on each shard and gives its rows' vectors and the positions (row -1 and below) times their weight."""
    kinds = [("row", pa.int32()), ("weight", pa.int64()), ("x", pa.list_(pa.int32()))]

    def out(t: Trainer) -> pa.RecordBatch:
        rows = np.flatnonzero(t.seen)
        weight = np.minimum(t.seen[rows], MOST_WEIGHT)
        x = np.concatenate([np.rint(t.p.table[rows] * (weight[:, None] * float(UNIT))), np.rint(np.column_stack([t.p.position, np.zeros(CONTEXT + 1)]) * float(UNIT))]).clip(-(2**31), 2**31 - 1).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, WIDTH + 1, dtype=np.int32)), pa.array(x.ravel()))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([rows, -1 - np.arange(CONTEXT + 1)]).astype(np.int32)), pa.array(np.concatenate([weight, np.ones(CONTEXT + 1, np.int64)])), listed], [k for k, _ in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, t, waiting, n = None, None, [], 0
        for part, pieces in _parts(batches):
            texts = Words(pieces)
            for s, text in zip(part.column(part.schema.get_field_index("shard")).to_pylist(), texts.ended(v.rows(texts.different), v.end), strict=True):
                if s != shard:
                    if t:
                        t.learn(waiting)
                        yield out(t)
                    shard, t, waiting, n = s, Trainer(v, p, s & 0xFFFFFFFF), [], 0
                waiting.append(text)
                n += len(text)
                if n >= 8 * BATCH:
                    t.learn(waiting)
                    waiting, n = [], 0
        if t:
            t.learn(waiting)
            yield out(t)

    return run


@dataclass
class Model:
    """What scoring needs: totals, the head's counts, the network, the rest of each class and the count of texts' ends (which the head may lack)."""

    tokens: int
    kinds: int
    head: dict[bytes, int]
    vocabulary: Vocabulary
    parameters: Parameters
    rest: np.ndarray  # occurrences of each class's words without vectors
    rest_kinds: np.ndarray
    discount: float
    least: int
    counts: DataFrame
    ends: int

    def unseen_logs(self) -> np.ndarray:
        """log10 of the unseen word's share of each class's rest."""
        return np.log10(np.where(self.rest > 0, self.discount * self.rest_kinds / np.maximum(self.rest, 1), 1.0))


def head_of(counts: DataFrame, most: int) -> tuple[int, DataFrame]:
    """The least count such that at most `most` words have it or more (by steps of a sixth of an octave), and these words."""
    step = F.floor(F.log2("c") * 6).cast("int")
    sizes = sorted(((r["step"], r["n"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, total = None, 0
    for s, n in sizes:
        if total + n > most:
            break
        least, total = s, total + n
    return (least if least is not None else 1 << 20), counts.filter(step >= F.lit(least if least is not None else 1 << 20))


def learn(docs: DataFrame, rounds: tuple[int, ...] = ROUNDS, head_words: int = HEAD_WORDS, shard_tokens: int = SHARD_TOKENS) -> Model:
    """Learns from all rows of docs (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    counts = cut(docs.mapInArrow(_counted, "w binary, c long").groupBy("w").agg(F.sum("c").alias("c")))
    tokens, kinds, once, twice = counts.select(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    least, top = head_of(counts, head_words)
    got = top.toArrow()
    head = dict(zip(got["w"].to_pylist(), got["c"].to_pylist(), strict=True))
    ranked = sorted(((w, c) for w, c in head.items() if w != END_WORD and c >= LEAST_OWN), key=lambda x: (-x[1], x[0]))[:MOST_OWN]
    ends = head[END_WORD] if END_WORD in head else (counts.filter(F.length("w") == 0).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0])
    rest, rest_kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.filter(F.length("w") > 0).groupBy((F.crc32(F.substring("w", 1, 3)) % CLASSES).alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        rest[r["k"]], rest_kinds[r["k"]] = r["n"], r["v"]
    for w, c in ranked:
        rest[word_class(w)] -= c
        rest_kinds[word_class(w)] -= 1
    v = Vocabulary(ranked, int(ends), rest)
    p = Parameters.fresh(v)
    # which documents a shard holds and in which order depends on the documents alone
    shards = max(1, -(-int(tokens) // shard_tokens)) * sum(rounds)
    mark = F.xxhash64("doc_id", "text")
    marked = docs.select("text", mark.alias("mark"), F.pmod(mark, F.lit(shards)).alias("fine"))
    done = 0
    for share in rounds:
        part = F.col("fine") % sum(rounds)
        # fine shards of the round's remainders that stand together are one shard
        mine = marked.filter((part >= done) & (part < done + share)).withColumn("shard", F.floor(F.col("fine") / sum(rounds)))
        done += share
        ordered = mine.repartition("shard").sortWithinPartitions("shard", "mark", "text").select("shard", "text")
        parts = ordered.mapInArrow(_trained(v, p), "row int, weight long, x array<int>")
        means = parts.groupBy("row").agg(F.sum("weight").alias("weight"), *(F.sum(F.col("x")[i]).alias(f"x{i}") for i in range(WIDTH + 1))).toArrow()
        rows = means["row"].to_numpy()
        x = np.column_stack([means[f"x{i}"].to_numpy() for i in range(WIDTH + 1)]) / (means["weight"].to_numpy()[:, None] * float(UNIT))
        p = p.copy()
        p.table[rows[rows >= 0]] = x[rows >= 0]
        p.position[-1 - rows[rows < 0]] = x[rows < 0, :WIDTH]
    discount = float(np.clip(once / max(1, once + 2 * twice), 0.1, 0.9))
    return Model(int(tokens), int(kinds), head, v, p, rest, rest_kinds, discount, least, counts, int(ends))


def log_probabilities(v: Vocabulary, p: Parameters, line: Line, block: int = 1 << 17) -> np.ndarray:
    """Natural logarithms of the normalised probabilities of a line's targets, in blocks of bounded size."""
    longest, highest = float(np.sqrt(np.square(p.table[:, :WIDTH]).sum(1).max())), float(p.table[:, WIDTH].max())
    # powers of two are faster than those of e; the bias is the product with a context's one
    table = p.table * np.float32(1 / np.log(2))
    first = np.ascontiguousarray(table[: v.n_first].T)
    others = [np.ascontiguousarray(table[v.order[a:b]].T) for a, b in zip(v.bounds[:-1], v.bounds[1:], strict=True)]
    widest = max(v.n_first, int(np.diff(v.bounds).max()))
    ones, held, numbers = np.ones(widest, np.float32), np.empty(max(widest, AT_ONCE), np.float32), np.arange(AT_ONCE)
    lp = np.empty(len(line.target), np.float64)

    def normalised(q: np.ndarray, outputs: np.ndarray, target: np.ndarray) -> np.ndarray:
        n = outputs.shape[1]
        step = max(1, AT_ONCE // n)
        true, total = np.empty(len(q), np.float32), np.empty(len(q), np.float32)
        steep = len(q) and longest * float(np.sqrt(np.square(q[:, :WIDTH]).sum(1).max())) + highest > 80
        for i in range(0, len(q), step):
            m = min(step, len(q) - i)
            s = np.matmul(q[i : i + m], outputs, out=held[: m * n].reshape(m, n))
            if steep:
                np.minimum(s, 80 / np.log(2), out=s)
            true[i : i + m] = s[numbers[:m], target[i : i + m]]
            np.matmul(np.exp2(s, out=s), ones[:n], out=total[i : i + m])
        return true * np.log(2) - np.log(total)

    at_in_class = np.zeros(v.n_rows, np.int64)
    at_in_class[v.order] = np.arange(len(v.order)) - v.bounds[v.class_of[v.order]]
    for start in range(0, len(line.target), block):
        part = slice(start, min(start + block, len(line.target)))
        row = line.target[part]
        q = np.empty((len(row), WIDTH + 1), np.float32)
        for i in range(0, len(row), BATCH):
            q[i : i + BATCH] = line.context(p, slice(start + i, min(start + i + BATCH, part.stop)))[0]
        kind = v.class_of[row]
        out = normalised(q, first, np.where(kind < 0, row, v.classes + kind))
        order = np.argsort(kind.astype(np.int16), kind="stable")
        bounds = np.searchsorted(kind[order], np.arange(CLASSES + 1))
        q, target = q.take(order, axis=0), at_in_class[row[order]]
        for k in range(CLASSES):
            mine = slice(bounds[k], bounds[k + 1])
            out[order[mine]] += normalised(q[mine], others[k], target[mine])
        lp[part] = out
    return lp


def _scored(m: Model):
    v, p, head, ends, discount, unseen, rest = m.vocabulary, m.parameters, m.head, m.ends, m.discount, m.unseen_logs(), m.rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {w: i for i, w in enumerate(head)}
        count = np.array([*head.values(), 0], np.float64)
        log_c, row = np.log10(count + 1), np.append(v.rows(list(head)), 0)
        # what a word without a vector adds to its class's rest
        share = np.array([np.log10((c - discount) / rest[word_class(w)]) if w not in v.row and w != END_WORD else 0.0 for w, c in head.items()] + [0.0])
        for part, pieces in _parts(batches):
            texts = Words(pieces)
            at = np.fromiter(map(index.get, texts.different, repeat(-1)), np.int64, len(texts.different))
            out, more = row[at], share[at]
            strange = np.flatnonzero(at < 0)
            kinds = np.array([crc32(texts.different[i][:3]) % CLASSES for i in strange.tolist()], np.int64)
            out[strange], more[strange] = v.rest + kinds, unseen[kinds]
            rows = texts.ended(out, v.end)
            codes, of, size = texts.codes, texts.of, len(texts.sizes)

            def summed(x: np.ndarray, codes: np.ndarray = codes, of: np.ndarray = of, size: int = size) -> np.ndarray:
                return np.bincount(of, x[codes], size)

            other = np.flatnonzero(at[codes] < 0)
            n, known = texts.sizes + 1, texts.sizes - np.bincount(of[other], minlength=size) + (ends > 0)
            base, more = summed(log_c[at]) + np.log10(ends + 1.0), summed(more)
            # how often each text has each of its words that the head lacks
            pairs, times = np.unique(of[other] * len(at) + codes[other], return_counts=True)
            bounds = pa.array(np.searchsorted(pairs, np.arange(size + 1) * len(at)), pa.int32())
            rare = pa.ListArray.from_arrays(bounds, texts.listed.take(pa.array(pairs % max(1, len(at)))).cast(pa.binary()))
            times = pa.ListArray.from_arrays(bounds, pa.array(times, pa.int32()))
            if rows:
                lp = np.empty(sum(map(len, rows)))
                done, first = 0, 0
                for i in range(1, len(rows) + 1):  # some texts at a time, so that memory is bounded but for one text's rows
                    if i == len(rows) or sum(map(len, rows[first:i])) > 1 << 18:
                        line = Line(rows[first:i], v.start)
                        lp[done : done + len(line.target)] = log_probabilities(v, p, line)
                        done, first = done + len(line.target), i
            firsts = np.cumsum([0, *map(len, rows[:-1])]) if rows else np.zeros(0, np.int64)
            model = np.add.reduceat(lp, firsts) / np.log(10) if rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(model + more, pa.float64()), rare, times],
                ["doc_id", "n_tokens", "n_known", "base", "model", "rare", "times"],
            )

    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of each row."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(_scored(model), "doc_id long, n_tokens long, n_known long, base double, model double, rare array<binary>, times array<int>")
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()))
    each = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("w"), F.col("x.times").alias("times"))
    rare = model.counts.filter((F.length("w") > 0) & (F.floor(F.log2("c") * 6).cast("int") < model.least))
    # a word that was counted takes its own share of the class's rest instead of the unseen word's
    freed = F.array(*(F.lit(float(x)) for x in np.log10(np.maximum(model.discount * model.rest_kinds, 1e-300))))
    share = F.log10(F.col("c") - model.discount) - F.get(freed, (F.crc32(F.substring("w", 1, 3)) % CLASSES).cast("int"))
    found = each.join(rare, "w").groupBy("row").agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more"), F.sum(F.col("times") * share).alias("more_model"))

    def plus(name: str, more: str) -> Column:
        return F.col(name) + F.coalesce(more, F.lit(0))

    whole = float(np.log10(model.tokens + model.kinds + 1))
    return rows.drop("rare", "times").join(found, "row", "left").select("doc_id", "n_tokens", plus("n_known", "more_known").cast("long").alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"), (plus("base", "more") - F.col("n_tokens") * whole).alias("base_score"), plus("model", "more_model").alias("score"))


def held_out(docs: DataFrame) -> Column:
    return remainder(docs["doc_id"].cast("long"), 7) == 2
