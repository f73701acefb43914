"""Quality classifier: a factorisation machine over hashed words, structure statistics and the text's length.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): all pairs of features in
time linear in the features. Words fall into hashed buckets with counts scaled to length one; statistics (symbols,
capitals, digits, punctuation, repeated lines and words, word length, text length) fall into bins, one feature each.

Learning takes a bounded sample of labelled rows (about MOST_ROWS however many there are, chosen by a 62-bit hash of the id), trained in numpy with
mini-batches and AdaGrad. Scoring is one pass over all whole texts; the model is a constant 2 MB.

Defined results: null and empty texts get a score (their statistics are zero), without labels every score is 0.5,
repeated rows are repeated, several labels of one id count as the least, null labels not at all, other columns are
ignored by scores() and kept by kept().
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import draw, lower, remainder, share_of, slices, words

#: Labelled rows that are learnt from, about, at most.
MOST_ROWS = 12_000
BUCKETS = 1 << 15
FACTORS = 8
EPOCHS = 12
#: Upper edges of the bins of each statistic.
BINS = {
    "symbols": (0, 0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.3),
    "capitals": (0, 0.02, 0.04, 0.06, 0.1, 0.2, 0.4, 0.7),
    "digits": (0, 0.005, 0.01, 0.03, 0.06, 0.12, 0.25),
    "marks": (0, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2),
    "exclaims": (0, 0.002, 0.01, 0.03, 0.06),
    "same_lines": (0, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8),
    "same_words": (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
    "word_length": (1, 2, 3, 3.5, 4, 4.5, 5, 5.5, 6, 7, 8, 10, 15),
    "log_words": (1, 2, 3, 4, 5, 6, 7, 8, 9),
}
WIDE = max(map(len, BINS.values())) + 1
SIZE = BUCKETS + WIDE * len(BINS)
_SYMBOLS, _CAPITALS, _DIGITS, _MARKS, _SPACE = b"#*$%&|<>", bytes(range(65, 91)), b"0123456789", b".,;:!?\"'()-", b" \t\n\r\x0b\x0c"


def statistics(text: bytes, w: list[bytes], distinct: int) -> list[float]:
    n, size = len(w), max(1, len(text))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    share = lambda chars: (len(text) - len(text.translate(None, chars))) / size
    return [share(_SYMBOLS), share(_CAPITALS), share(_DIGITS), share(_MARKS), share(b"!"), 1 - len(set(lines)) / max(1, len(lines)), 1 - distinct / max(1, n), len(text.translate(None, _SPACE)) / max(1, n), float(np.log1p(n))]


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features."""
    w = words(lower(text))
    ids, counts = np.unique(np.fromiter(map(crc32, w), np.uint32, len(w)) & np.uint32(BUCKETS - 1), return_counts=True)
    x = counts.astype(np.float32)
    x /= max(1.0, float(np.sqrt(np.square(x).sum())))
    bins = [BUCKETS + i * WIDE + int(np.searchsorted(edges, value)) for i, (edges, value) in enumerate(zip(BINS.values(), statistics(text, w, len(set(w))), strict=True))]
    return np.concatenate([ids.astype(np.int32), np.array(bins, np.int32)]), np.concatenate([x, np.ones(len(bins), np.float32)])


class Machine:
    """w0, w and V of a factorisation machine."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray):
        self.w0, self.w, self.v = w0, w, v

    def score(self, ids: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[ids] * x[:, None]
        z = self.w0 + float(self.w[ids] @ x) + 0.5 * float(np.square(vx.sum(0)).sum() - np.square(vx).sum())
        return 1 / (1 + float(np.exp(-np.clip(z, -60, 60))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, batch: int = 256, rate: float = 0.1, decay: float = 1e-4, seed: int = 7) -> Machine:
    """Mini-batches with AdaGrad; both classes weigh alike."""
    rng = np.random.default_rng(seed)
    w, v = np.zeros(SIZE, np.float32), rng.normal(0, 0.02, (SIZE, FACTORS)).astype(np.float32)
    w0, g0, gw, gv = 0.0, 1e-6, np.full(SIZE, 1e-6, np.float32), np.full((SIZE, FACTORS), 1e-6, np.float32)
    y = np.array([r[2] for r in rows], np.float32)
    if not len(y):
        return Machine(0.0, w, np.zeros_like(v))
    weight = np.where(y == 1, 0.5 / max(1e-9, y.mean()), 0.5 / max(1e-9, 1 - y.mean())).clip(0, 10).astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), batch):
            chosen = order[start : start + batch]
            ids = np.concatenate([rows[i][0] for i in chosen])
            x = np.concatenate([rows[i][1] for i in chosen])
            ends = np.cumsum([len(rows[i][0]) for i in chosen])
            first = np.concatenate([[0], ends[:-1]])
            of = np.repeat(np.arange(len(chosen)), np.diff(np.concatenate([[0], ends])))
            vx = v[ids] * x[:, None]
            sums = np.add.reduceat(vx, first)
            z = w0 + np.add.reduceat(w[ids] * x, first) + 0.5 * (np.square(sums) - np.add.reduceat(np.square(vx), first)).sum(1)
            error = (1 / (1 + np.exp(-z.clip(-60, 60))) - y[chosen]) * weight[chosen] / len(chosen)
            e = error[of] * x
            g0 += float(error.sum()) ** 2
            w0 -= rate * float(error.sum()) / g0**0.5
            touched, place = np.unique(ids, return_inverse=True)
            dw = np.bincount(place, e, len(touched)).astype(np.float32) + decay * w[touched]
            inner = e[:, None] * (sums[of] - vx)
            dv = np.stack([np.bincount(place, inner[:, f], len(touched)) for f in range(FACTORS)], 1).astype(np.float32) + decay * v[touched]
            gw[touched] += dw * dw
            gv[touched] += dv * dv
            w[touched] -= rate * dw / np.sqrt(gw[touched])
            v[touched] -= 0.3 * rate * dv / np.sqrt(gv[touched])
    return Machine(w0, w, v)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches):
        got = [features(t) for t in texts]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array([i for i, _ in got], pa.list_(pa.int32())), pa.array([x for _, x in got], pa.list_(pa.float32()))], ["quality", "ids", "x"])


def learn(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Machine:
    """Learns from labelled rows whose crc32(doc_id) modulo 3 is not 1, about most_rows of them at most."""
    known = labels.filter("quality is not null and doc_id is not null").select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("quality")).filter(remainder(F.col("doc_id"), 3) != 1)
    share = share_of(most_rows, known.count())
    chosen = known.filter(draw("doc_id") < share).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    # the sample's size is bounded by most_rows, so it may be broadcast; of an id that stands several times one text counts
    sample = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy("doc_id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    got = sample.select("quality", "text", "doc_id").mapInArrow(_extract, "quality int, ids array<int>, x array<float>").toArrow()
    rows = sorted(((i.tobytes(), x.tobytes(), q) for q, i, x in zip(got["quality"].to_pylist(), (a.values.to_numpy() for a in got["ids"]), (a.values.to_numpy() for a in got["x"]), strict=True)))
    del got
    pa.default_memory_pool().release_unused()  # the driver keeps one copy of the sample while it trains
    return train([(np.frombuffer(i, np.int32), np.frombuffer(x, np.float32), q) for i, x, q in rows])


def _scores(machine: Machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            score = np.array([machine.score(*features(t)) for t in texts], np.float64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return run


def _kept(machine: Machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            yield part.filter(pa.array([machine.score(*features(t)) >= 0.5 for t in texts], pa.bool_()))

    return run


def scores(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out (crc32 modulo 3 is 1), score and predicted of every whole text."""
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    out = d.mapInArrow(_scores(machine), "doc_id long, score double, predicted int")
    return out.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def kept(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows of docs that aren't rejected (predicted 1), with their columns as they came."""
    return docs.mapInArrow(_kept(machine), docs.schema)
