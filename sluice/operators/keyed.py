"""State machines over a key's rows in order, for what plain windows can't express (reset after an alert, timers).

A machine is a class with `row(dict) -> list[dict]` and `end() -> list[dict]`. In batch the rows are dealt by key,
sorted within the task and streamed through one machine after another, so a task holds one key's state and never a
key's rows. The same machines run in Structured Streaming (sluice.streaming.stateful).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

OUT_ROWS = 4096


class Machine(Protocol):
    def row(self, row: dict[str, Any]) -> list[dict[str, Any]]: ...

    def end(self) -> list[dict[str, Any]]: ...


def run_keyed(df: DataFrame, keys: list[str], order: list[str], machine: Callable[[], Machine], schema: str | StructType) -> DataFrame:
    """What the machines of all keys emit."""
    kind = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                at = tuple(row[k] for k in keys)
                if at != key:
                    if state is not None:
                        out += state.end()
                    key, state = at, machine()
                out += state.row(row)
                if len(out) >= OUT_ROWS:
                    yield pa.RecordBatch.from_pylist(out, arrow)
                    out = []
        if state is not None:
            out += state.end()
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(stream, kind)
