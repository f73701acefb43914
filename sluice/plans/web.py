"""Requests to web servers against ordered rules: the first rule that matches a field names the alert."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Rule = tuple[str, str, list[str]]


def enabled(rules: list[Rule], disabled: set[str]) -> list[Rule]:
    """Rules whose name isn't disabled, in their order."""
    return [r for r in rules if r[0] not in disabled]


def java_pattern(pattern: str) -> str:
    """A pattern for Spark's regular expressions: braces that don't count repeats are escaped."""
    counted = {m.start() for m in re.finditer(r"(?<!\\)\{[0-9]+(?:,[0-9]*)?\}", pattern)}
    out, escaped = [], False
    for i, c in enumerate(pattern):
        end = c == "}" and any(i == pattern.index("}", s) for s in counted)
        out.append("\\" + c if c in "{}" and not escaped and i not in counted and not end else c)
        escaped = c == "\\" and not escaped
    return "".join(out)


def _hit(kind: str, field: str, pattern: str) -> Column:
    p = F.lit(java_pattern(pattern))
    if kind.startswith("array"):
        return F.try_element_at(F.filter(F.col(field), lambda x: F.regexp_like(x, p)), F.lit(1))
    return F.when(F.regexp_like(F.col(field), p), F.col(field))


def first_matches(requests: DataFrame, rules: list[Rule]) -> DataFrame:
    """requests with rule, field and value of the first rule that matches (fields in the rule's order); others go.

    Rules: (name, pattern, fields). A field may hold an array, of which any element may match.
    """
    kinds = dict(requests.dtypes)
    found = F
    for name, pattern, fields in rules:
        for field in fields:
            value = _hit(kinds[field], field, pattern)
            found = found.when(value.isNotNull(), F.struct(F.lit(name).alias("rule"), F.lit(field).alias("field"), value.alias("value")))
    if found is F:
        return requests.select("*", F.lit("").alias("rule"), F.lit("").alias("field"), F.lit("").alias("value")).limit(0)
    return requests.withColumn("__m", found).filter("__m is not null").select("*", "__m.*").drop("__m")


def first_matches_python(requests: DataFrame, rules: list[Rule]) -> DataFrame:
    """As first_matches(), by Python's regular expressions, for patterns that mean something else in Spark's."""
    kind = StructType(list(requests.schema.fields))
    for c in ("rule", "field", "value"):
        kind = kind.add(c, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(n, re.compile(p), f) for n, p, f in rules]
        for batch in batches:
            keep, hits = [], []
            for i, row in enumerate(batch.to_pylist()):
                hit = next(((n, f, v) for n, p, fields in compiled for f in fields for v in (row[f] if isinstance(row[f], list) else [row[f]]) if v is not None and p.search(v)), None)
                if hit:
                    keep.append(i)
                    hits.append(hit)
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, *(pa.array([h[k] for h in hits], pa.string()) for k in range(3))], [*batch.schema.names, "rule", "field", "value"])

    return requests.mapInArrow(run, kind)
