"""BPE encoding and decoding with a word-end vocabulary; merges are chosen by a segment tree.

For each piece of a word the leaves of a segment tree hold the ranks of adjacent symbol pairs and each inner node the
least rank below it (the left one on ties), so the root names the leftmost pair of the lowest rank. A merge changes
three leaves, and each change climbs to the root once: n log n for a piece of n symbols, however long. The trees of
short pieces of like size stand side by side in one array, and a step merges in all of them at once.

Words repeat, so each task keeps bounded tables of words and pieces that it has encoded. A text is never cut.
Defined results: a null text is empty, an empty text has no tokens, repeated rows give repeated results, and
columns besides the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from sluice.llm.common import short_batches, thrifty

#: Words and pieces that a task keeps at most, in each of two generations.
KEPT = 60_000
#: Longer ones aren't kept.
LONGEST_KEPT = 64
#: Words with letters beyond this one are normalised and parted by the tokenizers library: Unicode versions differ.
LAST_COMMON = "\u024f"
#: Fixed values of the vocabulary file's format: how texts are parted.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Above every leaf: a leaf is the pair's rank, its position and the merged symbol, in 16, 31 and 16 bits.
NO_PAIR = (1 << 63) - 1
#: Pairs of the longest pieces whose trees stand side by side; longer pieces have a tree of their own.
SIDE_BY_SIDE = 32


def byte_alphabet() -> list[str]:
    """The printable character for each byte: printable Latin-1 bytes stand for themselves, others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Kept:
    """A bounded table: the older half goes when the newer one is full, unless it is used again."""

    def __init__(self) -> None:
        self.new: dict = {}
        self.old: dict = {}

    def get(self, key):
        got = self.new.get(key)
        if got is None and (got := self.old.get(key)) is not None:
            self.put(key, got)
        return got

    def put(self, key, value) -> None:
        if len(key) <= LONGEST_KEPT:
            if len(self.new) >= KEPT:
                self.old, self.new = self.new, {}
            self.new[key] = value


class WordBpe:
    """The vocabulary, its merges and special tokens, from the text of a tokenizers file."""

    def __init__(self, source: str):
        said = json.loads(source)
        model = said["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {x["content"]: x["id"] for x in said["added_tokens"]}
        self.names = {i: t for t, i in (self.ids | self.special).items()}
        self.merges = {self.ids[a] << 16 | self.ids[b]: rank << 47 | self.ids[a + b] for rank, (a, b) in enumerate(model["merges"])}
        alphabet = byte_alphabet()
        self.pair_keys = np.array(sorted(self.merges), np.int64)
        self.pair_leaves = np.array([self.merges[k] for k in self.pair_keys.tolist()], np.int64)
        self.inner = [self.ids[c] for c in alphabet]
        self.final = [self.ids[c + self.end] for c in alphabet]
        self.pieces = regex.compile(PIECES)
        self.space = regex.compile(r"\s+")
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.library = Tokenizer.from_str(source)
        self.words, self.pieces_known = Kept(), Kept()

    def merged(self, symbols: list[int]) -> list[int]:
        """The symbols after all merges; a segment tree (root 1, leaves from `size` on) names the next merge."""
        n, pair = len(symbols), self.merges.get
        size = 1 << max(0, n - 2).bit_length()
        tree = [NO_PAIR] * (2 * size)
        for i in range(n - 1):
            if (leaf := pair(symbols[i] << 16 | symbols[i + 1])) is not None:
                tree[size + i] = leaf | i << 16
        for node in range(size - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left < right else right
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        while (top := tree[1]) != NO_PAIR:
            i = top >> 16 & 0x7FFFFFFF
            j = after[i]
            symbols[i] = top & 0xFFFF
            symbols[j] = -1
            after[i] = k = after[j]
            changed = [(i, NO_PAIR)] if k < 0 else [(j, NO_PAIR), (i, pair(symbols[i] << 16 | symbols[k]))]
            if k >= 0:
                before[k] = i
            if (h := before[i]) >= 0:
                changed.append((h, pair(symbols[h] << 16 | symbols[i])))
            for at, leaf in changed:
                node = size + at
                tree[node] = NO_PAIR if leaf is None or leaf == NO_PAIR else leaf | at << 16
                while node := node >> 1:
                    left, right = tree[2 * node], tree[2 * node + 1]
                    least = left if left < right else right
                    if tree[node] == least:
                        break
                    tree[node] = least
        return [x for x in symbols if x >= 0]

    def leaves(self, a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaves of pairs at positions; NO_PAIR where a symbol is negative or nothing merges the two."""
        key = a << 16 | b
        found = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[found] == key) & (b >= 0), self.pair_leaves[found] | at << 16, NO_PAIR)

    def merged_together(self, symbols: np.ndarray) -> None:
        """As merged() for each row, in place; rows are padded with -1 on the right, merged symbols become -1."""
        n, width = symbols.shape
        size = width - 1
        at = np.arange(size)
        tree = np.full((n, 2 * size), NO_PAIR, np.int64)
        tree[:, size:] = self.leaves(symbols[:, :-1], symbols[:, 1:], at)
        for node in range(size - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
        own, symbols = symbols, np.concatenate([symbols, np.full((n, 1), -1, np.int64)], 1)  # the last column stands for no neighbour
        after = np.where(symbols[:, 1:] >= 0, np.arange(1, width + 1), width)
        before = np.broadcast_to(np.array([width, *range(width - 1), width]), (n, width + 1)).copy()
        root = min(1, size)
        row = np.flatnonzero(tree[:, root] != NO_PAIR)
        while len(row):
            top = tree[row, root]
            i = top >> 16 & 0x7FFFFFFF
            j = after[row, i]
            k = np.where(j < width, after[row, np.minimum(j, width - 1)], width)
            h = before[row, i]
            symbols[row, i] = top & 0xFFFF
            symbols[row, j] = -1
            after[row, i] = k
            before[row, k] = i
            now = symbols[row, i]
            for where, leaf in ((j, None), (i, self.leaves(now, symbols[row, k], i)), (h, self.leaves(symbols[row, h], now, h))):
                good = where < size
                r, node = row[good], where[good] + size
                tree[r, node] = NO_PAIR if leaf is None else leaf[good]
                for _ in range(size.bit_length() - 1):
                    node = node >> 1
                    tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
            row = row[tree[row, root] != NO_PAIR]
        own[:] = symbols[:, :width]

    def learn(self, pieces: list[bytes]) -> dict[bytes, tuple[bytes, str]]:
        """Ids (packed) and decoded form of each piece."""
        out: dict[bytes, tuple[bytes, str]] = {}
        sizes: dict[int, list[bytes]] = {}
        for raw in pieces:
            if len(raw) - 1 > SIDE_BY_SIDE:
                ids = self.merged([*map(self.inner.__getitem__, raw[:-1]), self.final[raw[-1]]])
                out[raw] = struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)
            else:
                sizes.setdefault(1 << max(0, len(raw) - 2).bit_length(), []).append(raw)
        inner, final = np.array(self.inner), np.array(self.final)
        for size, same in sizes.items():
            n = np.fromiter(map(len, same), np.int64, len(same))
            raw = np.frombuffer(b"".join(x.ljust(size + 1, b"\0") for x in same), np.uint8).reshape(len(same), size + 1)
            place = np.arange(size + 1)
            symbols = np.where(place < n[:, None] - 1, inner[raw], np.where(place == n[:, None] - 1, final[raw], -1)).astype(np.int64)
            self.merged_together(symbols)
            left = symbols >= 0
            ends = np.cumsum(left.sum(1)).tolist()
            ids = symbols[left]
            packed, names, start = ids.astype("<u4").tobytes(), [*map(self.names.__getitem__, ids.tolist())], 0
            for x, end in zip(same, ends, strict=True):
                out[x] = packed[4 * start : 4 * end], " ".join(names[start:end])
                start = end
        return out

    def parted(self, word: str) -> list[bytes]:
        """The pieces of what stands between two white spaces, normalised and in lower case."""
        if word.isascii() and word.isalpha():
            return [word.lower().encode()]
        if max(word) <= LAST_COMMON:
            return [x.encode() for x in self.pieces.findall(unicodedata.normalize("NFC", word).lower())]
        byte = {c: b for b, c in enumerate(byte_alphabet())}
        said = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(word))
        return [bytes(byte[c] for c in piece) for piece, _ in said]

    def encode_all(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """All ids of each text, packed (little-endian, 32 bits each), and its decoded form."""
        split = [[(p, [p]) if p in self.special else (None, self.space.split(p)) for p in (self.marks.split(t) if self.marks else [t])] for t in texts]
        known: dict[str, tuple[bytes, str]] = {"": (b"", "")}
        new: dict[str, list[bytes]] = {}
        for word in {w for text in split for mark, ws in text if mark is None for w in ws}:
            if word:
                got = self.words.get(word)
                if got is None:
                    new[word] = self.parted(word)
                else:
                    known[word] = got
        pieces = {p: self.pieces_known.get(p) for p in {p for ps in new.values() for p in ps}}
        for p, got in self.learn([p for p, got in pieces.items() if got is None]).items():
            pieces[p] = got
            self.pieces_known.put(p, got)
        for word, ps in new.items():
            known[word] = got = pieces[ps[0]] if len(ps) == 1 else (b"".join([pieces[p][0] for p in ps]), " ".join([pieces[p][1] for p in ps]))
            self.words.put(word, got)
        out = []
        for text in split:
            parts = [x for mark, ws in text for x in (map(known.__getitem__, ws) if mark is None else [(struct.pack("<I", self.special[mark]), mark)]) if x[0]]
            out.append((b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts])))
        return out

    def encode(self, text: str) -> tuple[bytes, str]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        """The format has no decoder step, so the tokens stand side by side with a space between."""
        return " ".join([self.names[i] for i in ids])


def coder(source: str, digest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(source)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                coded = bpe.encode_all([t or "" for t in part.column(1).to_pylist()])
                out = [part.column(0), pa.array([len(i) // 4 for i, _ in coded], pa.int64())]
                if digest:
                    out += [pa.array([hashlib.sha256(i).hexdigest() for i, _ in coded]), pa.array([hashlib.sha256(d.encode()).hexdigest() for _, d in coded])]
                    yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    ends = np.cumsum([0, *(len(i) // 4 for i, _ in coded)]).astype(np.int32)
                    ids = np.frombuffer(b"".join([i for i, _ in coded]), "<i4")
                    out += [pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32())), pa.array([d for _, d in coded], pa.string())]
                    yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_tokens", "ids", "decoded"])

    return run


def vocabulary(path: str) -> str:
    """The vocabulary file's text; it goes to the tasks with their code (under 2 MB, fixed by the file)."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (array of int) and decoded (string) of each whole text."""
    short_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(thrifty(coder(vocabulary(path), False)), "doc_id long, n_tokens long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """As encode(), with SHA-256 digests in place of the ids and the decoded text."""
    short_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(thrifty(coder(vocabulary(path), True)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
