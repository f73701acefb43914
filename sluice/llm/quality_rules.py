"""Quality rules whose thresholds adapt to each language and source.

Per document: the base figures, and from them a few ratios. Each ratio has a quantile sketch (KLL, built by Spark's own
sketch aggregates) for each language and source; sketches merge, so a group of few rows takes the merged sketch of its
language, and a small language that of all rows. A ratio is out of bounds beyond a fence around its group's middle half:
`reach` spreads away, a spread being at least `floor` (so that a figure which is the same everywhere doesn't reject
every other value). Thresholds join the documents by language and source, and a document stays if the base rules and
all fences hold.

Defined results: null and empty texts have no words and fail the base rules; null languages and sources are groups of
their own; repeated rows are repeated in the result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import cut, slices, words

WINDOW = 8
#: A group's own sketch counts from so many rows on.
LEAST_ROWS = 100
SYMBOLS = b"#*$%&|<>"
_P = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rule:
    """A ratio of a document and how far from its group's middle half it may lie."""

    ratio: str
    reach: float
    floor: float
    lower: bool = False
    upper: bool = True


RULES = (
    Rule("symbol_ratio", 4.0, 0.008),
    Rule("capital_ratio", 4.0, 0.04),
    Rule("repeat_ratio", 4.0, 0.1),
    Rule("line_ratio", 4.0, 0.1),
    Rule("stutter_ratio", 4.0, 0.05),
    Rule("word_length", 4.0, 0.6, lower=True),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_stutters")


def repeated_words(w: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of `window` words that stand twice or more in the text, the first included."""
    n = len(w) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, w), np.int64, len(w)).view(np.uint64)
    x = h[:n].copy()
    for i in range(1, window):
        x *= _P
        x += h[i : i + n]
    order = np.sort(x)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    places = np.flatnonzero(np.isin(x, twice))
    seen: dict[tuple[bytes, ...], int] = {}
    for p in places.tolist():  # hashes propose, the words decide
        key = tuple(w[p : p + window])
        seen[key] = seen.get(key, 0) + 1
    places = np.array([p for p in places.tolist() if seen[tuple(w[p : p + window])] > 1], np.int64)
    edges = np.zeros(len(w) + 1, np.int32)
    np.add.at(edges, places, 1)
    np.add.at(edges, places + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def counts(text: bytes) -> tuple[int, ...]:
    """The figures named in COUNTS."""
    w = words(text)
    marks = np.frombuffer(text, np.uint8)
    blank = (marks == 32) | ((marks >= 9) & (marks <= 13))
    lines = [x for x in text.split(b"\n") if x and x.strip()]
    capitals = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    chars = int(np.count_nonzero((marks & 0xC0) != 0x80)) - int(np.count_nonzero(blank))
    return len(w), chars, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(w), len(lines), capitals, sum(map(eq, w, w[1:]))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches):
        got = list(zip(*map(counts, texts), strict=True)) or [()] * len(COUNTS)
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), *(pa.array(x, pa.int64()) for x in got)], ["doc_id", "lang", "source", *COUNTS])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts and the ratios of every whole text."""
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["lang"].cast("string").alias("lang"), docs["source"].cast("string").alias("source"), docs["text"])
    out = d.mapInArrow(_counted, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS))

    def over(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))

    return out.withColumns({"symbol_ratio": over("n_symbols", "word_chars"), "capital_ratio": over("n_capitals", "word_chars"), "repeat_ratio": over("n_repeat_words", "n_words"), "line_ratio": over("n_dup_lines", "n_lines"), "stutter_ratio": over("n_stutters", "n_words"), "word_length": over("word_chars", "n_words")})


def thresholds(figures: DataFrame, rules: tuple[Rule, ...] = RULES, least_rows: int = LEAST_ROWS) -> DataFrame:
    """lang, source and for each rule's ratio low and high; sketches of small groups give way to merged ones."""
    names = [r.ratio for r in rules]
    own = figures.groupBy("lang", "source").agg(F.count("*").alias("n"), *(F.kll_sketch_agg_double(c).alias(c) for c in names))
    own = cut(own)

    def merged(keys: list[str], tag: str) -> DataFrame:
        return own.groupBy(*keys).agg(F.sum("n").alias(f"n_{tag}"), *(F.kll_merge_agg_double(c).alias(f"{c}_{tag}") for c in names))

    with_lang = own.join(merged(["lang"], "lang").withColumnRenamed("lang", "l"), F.col("lang").eqNullSafe(F.col("l")))
    whole = merged([], "all").first()  # one row of sketches, a few KB each
    out = [F.col("lang").alias("t_lang"), F.col("source").alias("t_source")]
    for r in rules:
        sketch = F.when(F.col("n") >= least_rows, F.col(r.ratio)).when(F.col("n_lang") >= least_rows, F.col(f"{r.ratio}_lang")).otherwise(F.lit(whole[f"{r.ratio}_all"]).cast("binary"))
        low, high = (F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for q in (0.25, 0.75))
        spread = F.greatest(high - low, F.lit(r.floor))
        out.append((low - r.reach * spread if r.lower else F.lit(float("-inf"))).alias(f"{r.ratio}_low"))
        out.append((high + r.reach * spread if r.upper else F.lit(float("inf"))).alias(f"{r.ratio}_high"))
    return with_lang.select(*out)


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, least_rows: int = LEAST_ROWS) -> DataFrame:
    """doc_id, the base figures, base_failed, kept and, for a look at the reasons, failed (the ratios out of bounds)."""
    figures = cut(measured(docs))
    limits = thresholds(figures, rules, least_rows)
    met = figures.join(limits, figures["lang"].eqNullSafe(limits["t_lang"]) & figures["source"].eqNullSafe(limits["t_source"]))
    failed = F.array_compact(F.array(*(F.when(~F.col(r.ratio).between(F.col(f"{r.ratio}_low"), F.col(f"{r.ratio}_high")), r.ratio) for r in rules)))
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return met.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~base & (F.size(failed) == 0)).alias("kept"), failed.alias("failed"))
