"""Many words at once: all words of a dictionary that stand in a text, by one pass of an Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a dictionary at most (an automaton of some 100 MB in each task); larger ones are an error, never cut.
MOST_WORDS = 1_000_000


def hits(rows: DataFrame, key: str, text: str, words: DataFrame, word: str = "word", most_words: int = MOST_WORDS) -> DataFrame:
    """key, word and n: how often each word of the dictionary stands in the text, overlaps included; rows without a hit go.

    The dictionary travels to the tasks with the code, each task builds the automaton once and runs it over Arrow
    batches, so the time follows the texts' length and not the dictionary's. Null texts have no hit, null and empty words
    count for nothing.
    """
    known = words.select(F.col(word).alias("w")).filter("w is not null and w <> ''").distinct().limit(most_words + 1).collect()
    if len(known) > most_words:
        raise ValueError(f"the dictionary has over {most_words} words")
    dictionary = sorted(r["w"] for r in known)
    kind = f"{key} {dict(rows.dtypes)[key]}, word string, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for w in dictionary:
            automaton.add_word(w, w)
        automaton.make_automaton()
        for batch in batches:
            keys, found, counts = [], [], []
            for i, said in enumerate(batch.column(1).to_pylist()):
                own: dict[str, int] = {}
                for _, w in automaton.iter(said or "") if dictionary else ():
                    own[w] = own.get(w, 0) + 1
                keys += [i] * len(own)
                found += own
                counts += own.values()
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keys, pa.int64())), pa.array(found, pa.string()), pa.array(counts, pa.int64())], [key, "word", "n"])

    return rows.select(key, text).mapInArrow(run, kind)
