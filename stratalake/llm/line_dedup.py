"""Line dedup over a sharded minimal perfect hash (operator 10).

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased. Keys of at least
``min_chars`` code points that occur in at least ``min_docs`` documents are frequent: all their lines
go, except those of the largest doc_id that holds the key.

1. Every document gives the 128-bit digests of its distinct long keys.
2. Documents are dealt into blocks of about ``block_bytes`` of text by doc_id. Digests are counted per
   block and then over all blocks, so a line that a third of all documents hold arrives at most once
   per block.
3. The distinct digests are dealt into shards. Each shard becomes a minimal perfect hash: it maps its n
   digests to 0…n-1 with about three bits a key and no keys stored. The slots hold a 64-bit fingerprint,
   the number of documents and the largest doc_id.
4. Blocks probe the shards with their digests and get the frequent ones back; each document of the
   block drops its lines by that answer. Lines themselves are never joined.

A group in one task is a shard (``shard_keys`` keys and its probes, one per key and block) or a block.

Edge cases: NULL text reads as one empty line. Rows with one doc_id are one document. Rows without
doc_id together count as one document that is smaller than every other, so it keeps no frequent line
unless fewer than ``min_docs`` hold it. Other columns, whatever their names, pass through unchanged.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from stratalake.llm import batches
from stratalake.llm.frames import Table, schema_with
from stratalake.session import stage

_SPACE = b" \t\n\x0b\x0c\r"
_GAMMA = 2  # bits of a level per key still to be placed
_DIGESTS = "_id long, _low long, _high long"
_INDEX = "_shard long, _sizes array<long>, _bits binary, _prints binary, _counts binary, _lasts binary"
_ANSWERS = "_block long, _low long, _high long, _last long"


def line_key(line: bytes) -> bytes:
    return line.strip(_SPACE).lower()  # bytes.lower changes A-Z only


def is_long(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and len(key.decode()) >= min_chars


def key_digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _document_digests(parts: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, digest) for the distinct long keys of each row."""
    for batch in parts:
        for part in batches.slices(batch, "_text"):
            ids, found = [], []
            for doc, text in zip(part.column("_id").to_pylist(), part.column("_text").to_pylist()):
                keys = {k for k in map(line_key, (text or "").encode().split(b"\n")) if is_long(k, min_chars)}
                ids += [doc] * len(keys)
                found += map(key_digest, keys)
            halves = np.frombuffer(b"".join(found), dtype=np.int64)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(halves[0::2]), pa.array(halves[1::2])],
                                  names=["_id", "_low", "_high"])


class PerfectHash:
    """A minimal perfect hash: level after level, keys that hit a free bit of their own stay there and
    the rest moves on. A key's number is the count of set bits before its bit."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.rank = np.cumsum(bits) - bits

    @classmethod
    def build(cls, low: np.ndarray, high: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(low):
            size = _GAMMA * len(low)
            at = cls._place(low, high, len(sizes), size)
            hits = np.bincount(at, minlength=size)
            levels.append(hits == 1)
            sizes.append(size)
            low, high = low[hits[at] != 1], high[hits[at] != 1]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, dtype=bool))

    @staticmethod
    def _place(low: np.ndarray, high: np.ndarray, level: int, size: int) -> np.ndarray:
        return (batches.mix(low ^ batches.mix(high, level), level) % np.uint64(size)).astype(np.int64)

    def numbers(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Each key's number; -1 for a key that surely was not built in."""
        found = np.full(len(low), -1, dtype=np.int64)
        left, base = np.arange(len(low)), 0
        for level, size in enumerate(self.sizes):
            at = base + self._place(low[left], high[left], level, size)
            hit = self.bits[at]
            found[left[hit]] = self.rank[at[hit]]
            left, base = left[~hit], base + size
        return found


def _unsigned(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy().astype(np.int64).view(np.uint64)


def _build_shard(key: tuple, table: pa.Table) -> pa.Table:
    low, high = _unsigned(table, "_low"), _unsigned(table, "_high")
    index = PerfectHash.build(low, high)
    order = np.argsort(index.numbers(low, high))
    counts = table.column("_docs").to_numpy().astype(np.int64)[order]
    lasts = table.column("_last").fill_null(np.iinfo(np.int64).min).to_numpy().astype(np.int64)[order]
    return pa.table({"_shard": pa.array([key[0].as_py()], pa.int64()), "_sizes": pa.array([index.sizes], pa.list_(pa.int64())),
                     "_bits": [np.packbits(index.bits).tobytes()], "_prints": [high[order].tobytes()],
                     "_counts": [counts.tobytes()], "_lasts": [lasts.tobytes()]})


def _probe_shard(probes: pa.Table, shard: pa.Table, min_docs: int) -> pa.Table:
    """The probes whose key is frequent, with the largest doc_id that holds it."""
    block, low, high = probes.column("_block").to_numpy(), _unsigned(probes, "_low"), _unsigned(probes, "_high")
    if shard.num_rows and len(low):
        row = shard.to_pylist()[0]
        bits = np.unpackbits(np.frombuffer(row["_bits"], dtype=np.uint8), count=sum(row["_sizes"])).astype(bool)
        at = PerfectHash(row["_sizes"], bits).numbers(low, high)
        frequent = (at >= 0) & (np.frombuffer(row["_prints"], dtype=np.uint64)[at] == high)
        frequent &= np.frombuffer(row["_counts"], dtype=np.int64)[at] >= min_docs
        last = np.frombuffer(row["_lasts"], dtype=np.int64)[at]
    else:
        frequent, last = np.zeros(len(low), dtype=bool), np.zeros(len(low), dtype=np.int64)
    return pa.table({"_block": block[frequent].astype(np.int64), "_low": low[frequent].view(np.int64),
                     "_high": high[frequent].view(np.int64), "_last": last[frequent]})


def _drop_lines(docs: pa.Table, answers: pa.Table, column: str, min_chars: int) -> pa.Table:
    """The documents of a block without the lines that its answers name."""
    digests = np.stack([answers.column(c).to_numpy().astype(np.int64) for c in ("_low", "_high")], axis=1).tobytes()
    last = {digests[16 * i:16 * i + 16]: doc for i, doc in enumerate(answers.column("_last").to_pylist())}
    texts, totals, dropped = [], [], []
    for doc, text in zip(docs.column("_id").to_pylist(), docs.column(column).to_pylist()):
        lines = (text or "").encode().split(b"\n")
        kept = lines
        if last:
            kept = []
            for line in lines:
                key = line_key(line)
                if is_long(key, min_chars) and last.get(key_digest(key), doc) != doc:
                    continue
                kept.append(line)
        texts.append(b"\n".join(kept).decode() if len(kept) < len(lines) else text)
        totals.append(len(lines))
        dropped.append(len(lines) - len(kept))
    docs = docs.set_column(docs.column_names.index(column), column, pa.array(texts, pa.string()))
    docs = docs.append_column("n_lines", pa.array(totals, pa.int64())).append_column("n_dropped", pa.array(dropped, pa.int64()))
    return docs.drop_columns(["_block", "_id"])


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = 40,
                min_docs: int = 5, shard_keys: int = 250_000, block_bytes: int = 24 << 20) -> DataFrame:
    """``docs`` with frequent lines dropped from the text, plus n_lines (before) and n_dropped.

    Columns of ``docs`` that carry the names n_lines or n_dropped are replaced.
    """
    table = Table(docs)
    doc_id, text = table.col(id_column).cast("long").alias("_id"), table.at(text_column)
    size = table.df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    block = F.pmod(F.xxhash64("_id"), F.lit(1 + size // block_bytes)).alias("_block")

    digests = table.df.select(doc_id, F.col(text).alias("_text")).mapInArrow(
        lambda parts: _document_digests(parts, min_chars), _DIGESTS)
    by_block = stage(digests.distinct().groupBy(block, "_low", "_high")
                     .agg(F.count(F.lit(1)).alias("_docs"), F.max("_id").alias("_last")))
    counts = stage(by_block.groupBy("_low", "_high").agg(F.sum("_docs").alias("_docs"), F.max("_last").alias("_last")))
    shard = F.pmod(F.col("_low"), F.lit(1 + counts.count() // shard_keys)).alias("_shard")
    index = counts.withColumn("_shard", shard).groupBy("_shard").applyInArrow(_build_shard, _INDEX)
    answers = by_block.select(shard, "_block", "_low", "_high").groupBy("_shard").cogroup(index.groupBy("_shard")) \
        .applyInArrow(lambda probes, arrays: _probe_shard(probes, arrays, min_docs), _ANSWERS)

    keyed = table.df.select("*", doc_id).select("*", block)
    kept = schema_with(table.df, **{text: T.StringType()}, n_lines=T.LongType(), n_dropped=T.LongType())
    result = keyed.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(
        lambda docs, found: _drop_lines(docs, found, text, min_chars), kept)
    return table.restore(result, "n_lines", "n_dropped")
