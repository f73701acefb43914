"""Chat formatting in budgeted windows.

A conversation's turns are numbered by their order, whatever numbers they bear (a sort by ranges, counts of each range
and their running sums), and fall into blocks of BLOCK turns, the unit that a task holds, so a conversation of any
length is many tasks' work. Each block also gets the few turns before it and the conversation's system turn. Within a
block, prefix sums of turn tokens choose the longest turn-aligned span that fits the budget beside what is repeated:
the system turn and at most HISTORY turns before the span. Repeated turns never count as targets, so every assistant
turn is under the loss mask exactly once. A turn longer than the budget has a window of its own; it is never cut.

Tokens are those of the BPE vocabulary whose path is given (op10's encoder, over the rendered turn; turns end with a line
end, so their tokens add up), or else words of the text and four for the template.

Template: `<|turn|>role` newline text `<|end|>` newline. In roles and texts a backslash is doubled, and one is put
after the first character of every control string, which unescape() takes back.

Defined results: a null text or role is empty, a null turn comes first, turns of the same number are ordered by role
and text (repeated rows are turns too), a null conversation is one conversation, an empty table has no windows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.llm.bpe import WordBpe, vocabulary
from sluice.llm.common import SLICE, cut

BUDGET = 2048
HISTORY, HISTORY_SHARE = 2, 0.25
BLOCK = 256
OPEN, CLOSE = "<|turn|>", "<|end|>"
#: Control strings that texts may not hold as they are.
CONTROL = (OPEN, CLOSE, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))
_ESCAPED = re.compile(r"\\(.)", re.S)
#: In a role the first line end would close it, so it is written as a backslash and this letter.
_ROLE_LINE = "n"
_TURN = re.compile(re.escape(OPEN) + r"(.*?)\n(.*?)" + re.escape(CLOSE) + "\n", re.S)
WINDOWS = "conv_id long, block long, place int, text string, repeats int, n_tokens int, loss array<struct<s:int,e:int>>"

Turn = tuple[str, str]


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def rendered(turn: Turn) -> str:
    role = escape(turn[0]).replace("\n", "\\" + _ROLE_LINE)
    return f"{OPEN}{role}\n{escape(turn[1])}{CLOSE}\n"


def tokens(turn: Turn) -> int:
    """Words of the text and four for the template."""
    return len(turn[1].split()) + 4


def plan(turns: list[Turn], before: list[Turn], system: Turn | None, budget: int = BUDGET, size: Callable[[Turn], int] = tokens) -> list[tuple[list[Turn], list[Turn]]]:
    """Windows as (repeated turns, own turns); `before` holds the turns before the first."""
    line = before + turns
    upto = [0, *accumulate(map(size, line))]
    out, start = [], len(before)
    while start < len(line):
        head = [system] if system and start else []
        fixed = sum(map(size, head))
        first = start
        while first > max(0, start - HISTORY) and upto[start] - upto[first - 1] <= (budget - fixed) * HISTORY_SHARE:
            first -= 1
        if first == 0 < start and system and not before and line[0] == system:  # it stands in the head already
            first = 1
        fixed += upto[start] - upto[first]
        end = max(start + 1, bisect_right(upto, upto[start] + budget - fixed) - 1)
        out.append((head + line[first:start], line[start:end]))
        start = end
    return out


def window(repeated: list[Turn], own: list[Turn], size: Callable[[Turn], int] = tokens) -> tuple[str, int, int, list[dict[str, int]]]:
    """Text, number of repeated turns, tokens, and the spans of own assistant texts in code points."""
    parts = [rendered(t) for t in repeated]
    at, loss = sum(map(len, parts)), []
    for turn in own:
        piece = rendered(turn)
        if turn[0] == "assistant":
            end = at + len(piece) - len(CLOSE) - 1
            loss.append({"s": end - len(escape(turn[1])), "e": end})
        parts.append(piece)
        at += len(piece)
    return "".join(parts), len(repeated), sum(map(size, repeated + own)), loss


def _windows(budget: int, source: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, turns, before, system, out = None, [], [], None, []
        size: dict[Turn, int] = {}
        bpe = WordBpe(source) if source else None

        def sizes(part: list[Turn]) -> list[int]:
            return [len(ids) // 4 for ids, _ in bpe.encode_all(list(map(rendered, part)))] if bpe else list(map(tokens, part))

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Turn, int]]:
            """Rows with their turn and its tokens; turns are encoded together, whatever conversation they are of."""
            for b in batches:
                for i in range(0, b.num_rows, SLICE):
                    part = b.slice(i, SLICE).to_pylist()
                    told = [(r["role"], r["text"]) for r in part]
                    yield from zip(part, told, sizes(told), strict=True)

        def flush() -> None:
            for place, (repeated, own) in enumerate(plan(turns, before, system, budget, size.__getitem__)):
                out.append((*key, place, *window(repeated, own, size.__getitem__)))

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            made = pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.string()), pa.array(columns[4], pa.int32()), pa.array(columns[5], pa.int32()), pa.array(columns[6], pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))], ["conv_id", "block", "place", "text", "repeats", "n_tokens", "loss"])
            out.clear()
            return made

        for row, turn, n in counted(batches):
            if (row["conv_id"], row["block"]) != key:
                if key:
                    flush()
                key, turns, before, system, size = (row["conv_id"], row["block"]), [], [], None, {}
            size[turn] = n
            if row["kind"] == 0:
                system = turn
            else:
                (before if row["kind"] == 1 else turns).append(turn)
            if len(out) >= 256:
                yield batch()
        if key:
            flush()
        if out:
            yield batch()

    return run


def placed(turns: DataFrame) -> DataFrame:
    """turns with place, the number of turns of the conversation before it in the order of turn, role and text.

    A conversation may span many ranges of the sort; only its counts by range, a row each, come together.
    """
    # a range is told by the beginnings of long texts, which never parts equal ones
    ranges = turns.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv_id", "turn", "role", "text")
    rows = cut(ranges.select("*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("id")))
    upto = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("conv_id", "range").agg(F.min("id").alias("first"), F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(upto), F.lit(0)) - F.col("first"))
    parts = parts.select(F.col("conv_id").alias("of"), F.col("range").alias("of_range"), "base")
    return rows.join(parts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("range") == F.col("of_range"))).withColumn("place", F.col("base") + F.col("id")).drop("range", "id", "of", "of_range", "base")


def windows(conversations: DataFrame, budget: int = BUDGET, path: str | None = None) -> DataFrame:
    """The windows of all conversations: conv_id, block and place (their order), text, repeats, n_tokens and loss spans.

    path is that of a BPE vocabulary, whose tokens the budget counts.
    """
    c = conversations.select(conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"].cast("long").alias("turn"), *(F.coalesce(conversations[x].cast("string"), F.lit("")).alias(x) for x in ("role", "text")))
    c = cut(placed(c).select("conv_id", "role", "text", "place")).withColumn("block", F.floor(F.col("place") / BLOCK))
    own = c.withColumn("kind", F.lit(2))
    before = c.filter(F.col("place") % BLOCK >= BLOCK - HISTORY).withColumn("block", F.col("block") + 1).withColumn("kind", F.lit(1))
    starts = c.filter(F.col("place") % BLOCK == 0).select("conv_id", "block")
    system = c.filter("place = 0 and role = 'system'").select(F.col("conv_id").alias("of"), "role", "text", "place")
    told = starts.join(system, F.col("conv_id").eqNullSafe(F.col("of"))).select("conv_id", "role", "text", "place", "block", F.lit(0).alias("kind"))
    # history without turns of its own would make a window of nothing
    before = before.join(starts.toDF("b_conv", "b_block"), F.col("conv_id").eqNullSafe(F.col("b_conv")) & (F.col("block") == F.col("b_block")), "left_semi")
    rows = own.unionByName(before).unionByName(told)
    return rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "kind", "place").mapInArrow(_windows(budget, vocabulary(path) if path else None), WINDOWS)


def read_back(text: str) -> list[Turn]:
    """The turns of a window."""
    return [(_ESCAPED.sub(lambda m: "\n" if m[1] == _ROLE_LINE else m[1], r), unescape(t)) for r, t in _TURN.findall(text)]


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state, out = None, None, []

    def flush() -> None:
        n, turns, chars, loss, formatted = state
        out.append((key[0], n, turns.hexdigest(), chars, loss.hexdigest(), formatted))

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
        out.clear()
        return made

    for b in batches:
        for row in b.to_pylist():
            if (row["conv_id"],) != key:
                if key:
                    flush()
                key, state = (row["conv_id"],), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in read_back(row["text"])[row["repeats"] :]:
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            for span in row["loss"]:
                text = unescape(row["text"][span["s"] : span["e"]])
                state[2] += len(text)
                state[3].update(text.encode())
            state[4] += len(row["text"])
        if len(out) >= 1024:
            yield batch()
    if key:
        flush()
    if out:
        yield batch()


def digests(made: DataFrame) -> DataFrame:
    """What reading the windows back gives for each conversation.

    A digest goes over a conversation's bytes in order, so this check streams its windows through one task without
    holding them; the formatting itself has no such limit.
    """
    ordered = made.select("conv_id", "block", "place", "text", "repeats", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "block", "place")
    return ordered.mapInArrow(_digested, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
