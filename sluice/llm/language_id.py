"""Language identification by interpolated Kneser-Ney character models, one for each language.

Letters in lower case are symbols, everything else between them is one gap. Counts of ORDER-grams in a bounded sample of
learning texts (about SAMPLE different texts a language however many it has, chosen by a 62-bit hash of id and text) give all lower orders: below the highest, a
gram counts by how many different symbols stand before it. The models of all languages share sorted arrays of mixed
64-bit gram codes, one for each order, with a column of log probabilities for each language; contexts have the weight
of the next lower order likewise. A text's cross-entropy per symbol decides; its language is the lowest one's.

Calibration: part of the sample isn't counted but scored. It fixes the sharpness with which entropies become a
probability (score), and each language's highest plausible entropy; beyond it a prediction is marked rejected.

Defined results: a null text or one without a letter is `und` with score 0; languages that are null aren't learnt;
without a learnt language every text is `und`; ties go to the language first in the alphabet; repeated rows are
repeated; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import draw, remainder, share_of, slices

ORDER = 4
#: Learning texts of a language, about, at most; every fourth calibrates.
SAMPLE = 1600
CALIBRATING = 4
#: A language with fewer texts than this in the sample isn't calibrated: all its texts are counted.
LEAST_CALIBRATED = 40
UNKNOWN = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)


@cache
def symbols() -> np.ndarray:
    """The symbol of each code point: letters their own number (folded to 16 bits), others 0."""
    out = np.zeros(0x110000, np.uint64)
    for c in range(0x110000):
        if chr(c).isalpha():
            out[c] = c if c < 0x10000 else 1 + c % 0xFFFF
    return out


def grams(text: bytes) -> np.ndarray:
    """ORDER-gram codes (16 bits a symbol) that end at each symbol of the text; empty if it has no letter."""
    x = symbols()[np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le", "replace"), "<u4")]
    if not x.any():
        return np.zeros(0, np.uint64)
    gap = x == 0
    y = x[~(gap & np.concatenate([[True], gap[:-1]]))]
    if y[-1]:
        y = np.append(y, np.uint64(0))
    line = np.concatenate([np.zeros(ORDER - 1, np.uint64), y])
    g = line[ORDER - 1 :].copy()
    for i in range(1, ORDER):
        g |= line[ORDER - 1 - i : len(line) - i] << np.uint64(16 * i)
    return g


def _order(g: np.ndarray, n: int) -> np.ndarray:
    """The last n symbols of gram codes."""
    return g & np.uint64((1 << 16 * n) - 1)


class Table:
    """Sorted mixed codes with a row of values each, and an index of the codes by their high bits."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        mixed = codes * _MIX
        order = np.argsort(mixed)
        self.keys, self.values = mixed[order], np.ascontiguousarray(values[order], np.float32)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of each code and whether it is there."""
        mixed = codes * _MIX
        at = np.minimum(np.searchsorted(self.keys, mixed), len(self.keys) - 1)
        return at, self.keys[at] == mixed


@dataclass
class Model:
    languages: list[str]
    grams: list[Table]  # by order, from 1
    weights: list[Table | None]  # of the contexts of each order, from 1
    floor: float
    sharpness: float = 1.0
    highest: np.ndarray | None = None

    def entropies(self, g: np.ndarray) -> np.ndarray:
        """Cross-entropy in nats a symbol under each language."""
        total = np.zeros(len(self.languages))
        for start in range(0, len(g), 1 << 16):
            part = g[start : start + (1 << 16)]
            for n in range(ORDER, 0, -1):
                at, there = self.grams[n - 1].find(_order(part, n))
                total += np.bincount(at[there], minlength=len(self.grams[n - 1].keys)) @ self.grams[n - 1].values if there.sum() > len(self.grams[n - 1].keys) else self.grams[n - 1].values[at[there]].sum(0, dtype=np.float64)
                part = part[~there]
                if not len(part):
                    break
                if n > 1:
                    context = self.weights[n - 1]
                    at, there = context.find(_order(part >> np.uint64(16), n - 1))
                    total += context.values[at[there]].sum(0, dtype=np.float64)
            else:
                total += len(part) * self.floor
        return -total / len(g)

    def judge(self, entropies: np.ndarray) -> tuple[str, float, bool]:
        """Language, score and whether the prediction is rejected."""
        best = int(np.argmin(entropies))
        p = np.exp(-self.sharpness * (entropies - entropies[best]))
        return self.languages[best], float(1 / p.sum()), bool(self.highest is not None and entropies[best] > self.highest[best])


def kneser_ney(codes: np.ndarray, counts: np.ndarray, languages: list[str]) -> Model:
    """Models from the counts (grams by languages) of ORDER-grams."""
    levels = [(codes, counts.astype(np.float64))]
    for n in range(ORDER - 1, 0, -1):
        above, c = levels[0]
        lower, place = np.unique(_order(above, n), return_inverse=True)
        levels.insert(0, (lower, np.stack([np.bincount(place, c[:, k] > 0, len(lower)) for k in range(len(languages))], 1)))
    n_symbols = len(levels[0][0]) + 1
    tables, weights = [], []
    p_lower, lower_codes = np.full((1, len(languages)), 1 / n_symbols), None
    for n, (code, c) in enumerate(levels, 1):
        once, twice = (c == 1).sum(0), (c == 2).sum(0)
        discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.95)
        context, of = np.unique(code >> np.uint64(16), return_inverse=True)
        total = np.stack([np.bincount(of, c[:, k], len(context)) for k in range(len(languages))], 1)
        kinds = np.stack([np.bincount(of, c[:, k] > 0, len(context)) for k in range(len(languages))], 1)
        weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        lower = p_lower if n == 1 else p_lower[np.searchsorted(lower_codes, _order(code, n - 1))]
        p = np.where(total[of] > 0, np.maximum(c - discount, 0) / np.maximum(total[of], 1), 0) + weight[of] * lower
        tables.append(Table(code, np.log(p)))
        weights.append(Table(context, np.log(weight)))
        p_lower, lower_codes = p, code
    return Model(languages, tables, [None, *weights[1:]], float(-np.log(n_symbols) + weights[0].values.min()))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches):
        by: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(part.column(0).to_pylist(), texts, strict=True):
            by.setdefault(lang, []).append(grams(text))
        for lang, found in by.items():
            g, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n, pa.int64())], ["lang", "g", "n"])


def _entropies(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            rows = [(lang, model.entropies(g).tolist()) for lang, t in zip(part.column(0).to_pylist(), texts, strict=True) if len(g := grams(t))]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.string()), pa.array([h for _, h in rows], pa.list_(pa.float64()))], ["lang", "h"])

    return run


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learns from text and lang of docs; None without a language."""
    known = docs.filter("lang is not null and text is not null").select("doc_id", "lang", "text")
    # rows repeated as a whole count once; about as many different ones as the sketch says (one row a language)
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("doc_id", "text"), 0.01).alias("n")).collect()}
    if not sizes:
        return None
    share, enough = F, F
    for lang, n in sizes.items():
        share = share.when(F.col("lang") == lang, F.lit(share_of(sample, n)).cast("long"))
        enough = enough.when(F.col("lang") == lang, min(sample, n) >= LEAST_CALIBRATED)
    chosen = known.filter(draw("doc_id", "text") < share).dropDuplicates(["lang", "doc_id", "text"])
    # a language of few texts needs all of them for its counts, and its entropies have no upper bound
    calibrating = enough & (F.pmod(F.xxhash64("doc_id", "text", F.lit(1)), F.lit(CALIBRATING)) == 0)
    got = chosen.filter(~calibrating).select("lang", "text").mapInArrow(_counts, "lang string, g long, n long").groupBy("lang", "g").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(got["lang"].to_pylist())) if got.num_rows else []
    if not languages:
        return None
    codes, place = np.unique(got["g"].to_numpy().view(np.uint64), return_inverse=True)
    counts = np.zeros((len(codes), len(languages)))
    counts[place, np.searchsorted(np.array(languages), np.array(got["lang"].to_pylist()))] = got["n"].to_numpy()
    model = kneser_ney(codes, counts, languages)
    seen = chosen.filter(calibrating).select("lang", "text").mapInArrow(_entropies(model), "lang string, h array<double>").collect()
    rows = [(languages.index(r["lang"]), r["h"]) for r in seen if r["lang"] in languages]
    if rows:
        true, h = np.array([i for i, _ in rows]), np.array([x for _, x in rows])
        gap = h - h.min(1, keepdims=True)
        losses = [(float(np.mean(np.log(np.exp(-s * gap).sum(1)) + s * gap[np.arange(len(true)), true])), s) for s in (1, 2, 4, 8, 16, 32, 64)]
        model.sharpness = min(losses)[1]
        model.highest = np.array([np.quantile(own, 0.995) + 0.5 if len(own := h[true == k, k]) else np.inf for k in range(len(languages))])
    return model


def _predicted(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            said = [model.judge(model.entropies(g)) if model and len(g := grams(t)) else (UNKNOWN, 0.0, True) for t in texts]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x[0] for x in said], pa.string()), pa.array([x[1] for x in said], pa.float64()), pa.array([x[2] for x in said], pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    return run


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score and rejected of each whole text."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(_predicted(model), "doc_id long, lang_pred string, score double, rejected boolean")


def held_out(docs: DataFrame) -> Column:
    return remainder(docs["doc_id"].cast("long"), 4) == 2
