"""Byte-level BPE encoding and decoding by forced-boundary splitting (operator 4).

Two bytes that stand next to each other in no token of the vocabulary can never end up in one token, so
a cut between them is certain. A text is cut in three steps, each of which keeps the result equal to
encoding it whole:

1. at special tokens, whose ids are taken directly;
2. into chunks before a blank that follows a character which is not white space: no token holds a
   character followed by a blank, and the pre-tokenising pattern never looks back over that place;
3. each distinct chunk into the pattern's words, and each word's bytes at the forced boundaries.

The fragments are merged on their own, many side by side, and their ids put one after the other. Chunks
that came up before are looked up (a task remembers about ``CACHED`` of them).

Vocabulary: the file of a byte-level BPE tokenizer (``vocab``, ``merges``, ``added_tokens``). It is read
on the driver and sent to tasks as a broadcast whose size the vocabulary bounds.

Edge cases: a NULL text is encoded like the empty one, as an empty list. Texts of any length are encoded
whole; the memory for one text is a small multiple of it. Unknown ids make ``decode`` fail; bytes that
are not UTF-8 decode to U+FFFD. NULL ids decode to the empty text. Rows keep their other columns, except
those that carry the name of a result column; equal rows give equal results; empty tables stay empty.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratalake.llm import batches
from stratalake.llm.frames import schema_with

CACHED = 500_000
MAX_VOCABULARY = 1 << 20
SHORT = 64  # bytes of a fragment from which a heap of its own is faster

# The pre-tokenising pattern of this kind of tokenizer, and Unicode's white space.
_WHITE = r"\t-\r \x85\xa0  -     　"
_WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"

_OTHER_SPACE = re.compile(rf"(?![ \n])[{_WHITE}]")


def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in such vocabularies: printable bytes for themselves, the
    others as the characters from U+0100 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Vocabulary:
    """What encoding and decoding need of a tokenizer file."""

    tokens: list[bytes]
    merges: dict[tuple[int, int], tuple[int, int]]  # two ids: rank, id of the merged token
    special: dict[str, int] = field(default_factory=dict)

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, byte_of = content["model"], _byte_characters()
        if len(model["vocab"]) + len(content["added_tokens"]) > MAX_VOCABULARY:
            raise ValueError(f"a vocabulary of more than {MAX_VOCABULARY} tokens is not sent to every task")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in content["added_tokens"]):
            raise ValueError("special tokens that take up surrounding text are not supported")
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        tokens = [b""] * (1 + max([*model["vocab"].values(), *special.values()]))
        for text, i in model["vocab"].items():
            tokens[i] = bytes(byte_of[c] for c in text)
        for text, i in special.items():
            tokens[i] = text.encode()
        merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            merges[model["vocab"][left], model["vocab"][right]] = rank, model["vocab"][left + right]
        return cls(tokens, merges, special)

    def neighbours(self) -> np.ndarray:
        """For every two bytes, whether some token holds one after the other."""
        found = np.zeros((256, 256), dtype=bool)
        for token in self.tokens:
            for a, b in zip(token, token[1:]):
                found[a, b] = True
        return found


class _Merges:
    """Rank and result of a merge for many pairs at once: an open-addressing table in arrays."""

    NONE = 1 << 40

    def __init__(self, merges: dict[tuple[int, int], tuple[int, int]]):
        self.bits = max(4, len(merges).bit_length() + 2)
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, self.NONE, dtype=np.int64)
        self.made = np.zeros(1 << self.bits, dtype=np.int64)
        pairs = np.array(list(merges), dtype=np.int64).reshape(-1, 2)
        keys, values = (pairs[:, 0] << 20) | pairs[:, 1], np.array(list(merges.values()), dtype=np.int64).reshape(-1, 2)
        left, at = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = left[self.keys[at[left]] < 0]
            self.keys[at[free]] = keys[free]  # of those that want one slot, the last gets it
            won = left[self.keys[at[left]] == keys[left]]
            self.ranks[at[won]], self.made[at[won]] = values[won, 0], values[won, 1]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (batches.mix(keys.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slots of the pairs; a slot without a merge has the rank NONE."""
        keys = (left << 20) | right
        at = self._home(keys)
        wrong = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] >= 0))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[wrong]]
            wrong = wrong[(held != keys[wrong]) & (held >= 0)]
        return at


class Encoder:
    """Turns texts into the bytes of 32-bit ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.byte_ids = np.array([vocabulary.tokens.index(bytes([b])) for b in range(256)])
        self.together = vocabulary.neighbours()
        self.merges = _Merges(vocabulary.merges)
        self.words = regex.compile(_WORDS)
        self.known: dict[str, bytes] = {}  # by chunk
        self.known_after: dict[str, bytes] = {}  # by chunk without the blank that it starts with
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")")

    def encode(self, texts: list[str]) -> list[bytes]:
        plans = [self._plan(text) for text in texts]
        self._learn({c for plan in plans for heads, _ in plan if isinstance(heads, list) for c in heads},
                    set().union(*(after for plan in plans for _, after in plan)))
        found = [b"".join(self._ids(heads, after) for heads, after in plan) for plan in plans]
        if len(self.known) + len(self.known_after) > CACHED:
            self.known.clear()
            self.known_after.clear()
        return found

    def _plan(self, text: str) -> list[tuple[list[str] | int, list[str]]]:
        """Parts in order: a special id, or chunks and then chunks without their blank."""
        if any(name in text for name in self.vocabulary.special):
            parts = self.special.split(text)
            return [x for i, part in enumerate(parts)
                    for x in ([(self.vocabulary.special[part], [])] if i % 2 else self._plan(part))]
        if not text:
            return []
        if any(x in text for x in ("  ", " \n", "\n ")) or _OTHER_SPACE.search(text):
            return [(_safe_chunks(text), [])]
        pieces = text.split(" ")
        return [([pieces[0]] if pieces[0] else [], pieces[1:])]

    def _ids(self, heads: list[str] | int, after: list[str]) -> bytes:
        if isinstance(heads, int):
            return np.array([heads], dtype=np.int32).tobytes()
        return b"".join(map(self.known.__getitem__, heads)) + b"".join(map(self.known_after.__getitem__, after))

    def _learn(self, heads: set[str], after: set[str]) -> None:
        heads, after = list(heads.difference(self.known)), list(after.difference(self.known_after))
        ids = self._encode_chunks(heads + [" " + piece for piece in after])
        self.known.update(zip(heads, ids))
        self.known_after.update(zip(after, ids[len(heads):]))

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        if not chunks:
            return []
        words = [self.words.findall(chunk) for chunk in chunks]
        sizes = np.array([len(word.encode()) for found in words for word in found])
        data = np.frombuffer("".join(chunks).encode(), dtype=np.uint8)
        cut = np.ones(len(data), dtype=bool)  # whether a fragment starts at a byte
        cut[1:] = ~self.together[data[:-1], data[1:]]
        cut[np.cumsum(sizes[:-1])] = True
        fragment = np.cumsum(cut) - 1
        chunk_sizes = np.add.reduceat(sizes, np.cumsum([0] + [len(found) for found in words[:-1]]))
        chunk = np.repeat(np.arange(len(chunks)), chunk_sizes)[cut]  # by fragment
        ids, fragment = self._merge(self.byte_ids[data], fragment)
        ends = np.searchsorted(chunk[fragment], np.arange(len(chunks) + 1)) * 4
        packed = ids.astype(np.int32).tobytes()
        return [packed[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def _merge(self, ids: np.ndarray, fragment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges every fragment to the end: in each round the leftmost best pair of each."""
        sizes = np.bincount(fragment)
        long = sizes[fragment] > SHORT
        done = []
        for i in np.flatnonzero(sizes > SHORT).tolist():
            merged = self._merge_long(ids[np.searchsorted(fragment, i):np.searchsorted(fragment, i + 1)].tolist())
            done.append((np.array(merged), np.full(len(merged), i)))
        ids, fragment = ids[~long], fragment[~long]
        while len(ids):
            slots = self.merges.find(ids[:-1], ids[1:])
            rank = np.append(np.where(fragment[:-1] == fragment[1:], self.merges.ranks[slots], _Merges.NONE), _Merges.NONE)
            first = np.flatnonzero(np.append(True, fragment[1:] != fragment[:-1]))
            best = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(ids)))
            over = np.repeat(best == _Merges.NONE, size)
            done.append((ids[over], fragment[over]))
            at = np.flatnonzero((rank == np.repeat(best, size)) & ~over)
            at = at[np.append(True, fragment[at[1:]] != fragment[at[:-1]])] if len(at) else at
            ids[at] = self.merges.made[slots[at]]
            keep = ~over
            keep[at + 1] = False
            ids, fragment = ids[keep], fragment[keep]
        ids, fragment = (np.concatenate([d[i] for d in done]) for i in (0, 1))
        order = np.argsort(fragment, kind="stable")
        return ids[order], fragment[order]

    def _merge_long(self, ids: list[int]) -> list[int]:
        """One long fragment with a heap of pairs and links between the ids that are left."""
        merges, after, before = self.vocabulary.merges, list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = []

        def offer(at: int) -> None:
            if 0 <= at and after[at] < len(ids):
                pair = ids[at], ids[after[at]]
                if pair in merges:
                    heapq.heappush(heap, (merges[pair][0], at, pair))

        for at in range(len(ids) - 1):
            offer(at)
        while heap:
            _, at, pair = heapq.heappop(heap)
            right = after[at]
            if right >= len(ids) or (ids[at], ids[right]) != pair:
                continue  # one of the two has been merged meanwhile
            ids[at], ids[right], after[at] = merges[pair][1], -1, after[right]
            if after[at] < len(ids):
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [i for i in ids if i >= 0]


_CHUNKS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")


def _safe_chunks(text: str) -> list[str]:
    """Chunks that start at blanks or line ends, unless other white space stands before them."""
    chunks = _CHUNKS.findall(text)
    if not _OTHER_SPACE.search(text):
        return chunks
    joined = []
    for chunk in chunks:
        if joined and _OTHER_SPACE.match(joined[-1][-1]):
            joined[-1] += chunk
        else:
            joined.append(chunk)
    return joined


def encode_batches(parts: Iterable[pa.RecordBatch], vocabulary: Vocabulary, text: str, ids: str) -> Iterator[pa.RecordBatch]:
    """The batches with the ids of column ``text`` as column ``ids``."""
    encoder = Encoder(vocabulary)
    for batch in parts:
        for part in batches.slices(batch, text):
            packed = encoder.encode([value or "" for value in part.column(text).to_pylist()])
            ends = np.cumsum([0] + [len(p) // 4 for p in packed])
            yield _with(part, ids, pa.LargeListArray.from_arrays(
                ends, np.frombuffer(b"".join(packed), dtype=np.int32)).cast(pa.list_(pa.int32())))


def decode_batches(parts: Iterable[pa.RecordBatch], vocabulary: Vocabulary, ids: str, text: str) -> Iterator[pa.RecordBatch]:
    """The batches with the text of column ``ids`` as column ``text``."""
    table = np.frombuffer(b"".join(vocabulary.tokens), dtype=np.uint8)
    sizes = np.array([len(t) for t in vocabulary.tokens], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    for batch in parts:
        for row in range(0, batch.num_rows, 256):
            part = batch.slice(row, 256)
            lists = part.column(ids)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if len(flat) and (flat.min() < 0 or flat.max() >= len(sizes)):
                raise ValueError("an id is not in the vocabulary")
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate(([0], np.cumsum(sizes[flat])))[np.concatenate(([0], np.cumsum(counts)))]
            data = table[batches.ranges(starts[flat], sizes[flat])].tobytes()
            yield _with(part, text, pa.array(
                [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.string()))


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    columns = dict(zip(batch.schema.names, batch.columns)) | {name: column}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def shared(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary of the tokenizer file ``path`` on the driver, for tasks; its size is checked.
    Plain values, because executors need not have this package."""
    vocabulary = Vocabulary.from_file(path)
    return spark.sparkContext.broadcast((vocabulary.tokens, vocabulary.merges, vocabulary.special))


def encode(docs: DataFrame, path: str, text_column: str = "text", ids_column: str = "ids") -> DataFrame:
    """``docs`` with an array of token ids per row."""
    vocabulary = shared(docs.sparkSession, path)
    return docs.mapInArrow(lambda parts: encode_batches(parts, Vocabulary(*vocabulary.value), text_column, ids_column),
                           schema_with(docs, **{ids_column: T.ArrayType(T.IntegerType())}))


def decode(docs: DataFrame, path: str, ids_column: str = "ids", text_column: str = "decoded") -> DataFrame:
    """``docs`` with the text of the token ids per row."""
    vocabulary = shared(docs.sparkSession, path)
    return docs.mapInArrow(lambda parts: decode_batches(parts, Vocabulary(*vocabulary.value), ids_column, text_column),
                           schema_with(docs, **{text_column: T.StringType()}))
