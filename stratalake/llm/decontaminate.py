"""Benchmark decontamination by winnowing (operator 2).

Words are runs of ASCII letters, digits and characters beyond ASCII, with A-Z lower-cased. A window is
``span`` consecutive words of an item; an item of fewer words, but not none, is one window. A document
word inside any occurrence of a window is hit.

1. In every run of ``span - gram + 1`` consecutive ``gram``-word hashes the smallest is kept as a
   fingerprint, the rightmost of equal ones. A run is exactly one window of ``span`` words, so every span
   of that length shared by a document and an item has the same fingerprint at the same place.
2. Fingerprints of documents are joined with those of the items.
3. Each match is extended: the windows of the document around the fingerprint are compared with the
   items' windows by a hash of their own. Words of equal windows are hit.

Items with fewer than ``span`` words are below what winnowing guarantees; every run of their length in a
document is compared with them.

The items' windows are dealt into blocks of at most about ``block_windows`` rows, whose size is therefore
bounded, and the documents are read once for each block: work is proportional to the documents times
the blocks, and no document row is shuffled for a single block. With several blocks, the hits of a
document (bounded by its own length) meet by row.

Edge cases: NULL or empty texts have no words; rows are answered one by one, also equal rows and rows
without an id. An item without an id counts under the empty id, and items of one id count as one. Empty
tables on either side give no hits. Other columns of the documents stay, except those with the name of a
result column or "hits" and "items"; those of the items are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from stratalake.llm import batches
from stratalake.llm.frames import Table, schema_with
from stratalake.session import stage

_WINDOWS = "_size int, _print long, _window long, _item string"
_SEED = 11  # of window hashes, so that they are independent of fingerprints


def fingerprints(words: batches.Words, span: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word that starts a window of ``span`` words: the window's first word, and the place and
    hash of its fingerprint, the rightmost smallest ``gram``-word hash inside it."""
    inside = np.flatnonzero(words.inside(span))
    hashes = words.grams(gram)
    if not len(inside):
        return inside, inside, hashes[:0]
    runs = np.lib.stride_tricks.sliding_window_view(hashes, span - gram + 1)[inside]
    best = span - gram - np.argmin(runs[:, ::-1], axis=1)
    return inside, inside + best, runs[np.arange(len(inside)), best]


def _item_windows(parts: Iterator[pa.RecordBatch], span: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in parts:
        for part in batches.slices(batch, "_text"):
            words = batches.words(*batches.buffers(part.column("_text")), inside=batches.ALPHANUMERIC)
            item = np.repeat(np.arange(part.num_rows), words.counts)
            starts, _, prints = fingerprints(words, span, gram)
            found = [(np.full(len(starts), span), prints, words.grams(span, _SEED)[starts], item[starts])]
            short = np.flatnonzero((words.counts > 0) & (words.counts < span))
            for size in np.unique(words.counts[short]).tolist():
                items = short[words.counts[short] == size]
                hashes = words.grams(size, _SEED)[words.first[:-1][items]]
                found.append((np.full(len(items), size), hashes, hashes, items))
            sizes, prints, windows, items = (np.concatenate(column) for column in zip(*found))
            yield pa.record_batch([
                pa.array(sizes.astype(np.int32)), pa.array(prints.view(np.int64)), pa.array(windows.view(np.int64)),
                part.column("_item").take(pa.array(items))], names=["_size", "_print", "_window", "_item"])


class Windows:
    """A block of item windows, sorted for look-up."""

    def __init__(self, sizes: np.ndarray, prints: np.ndarray, windows: np.ndarray, items: list[str], span: int):
        self.items = items
        self.prints = np.unique(prints[sizes == span].view(np.uint64))
        self.by_size = {}
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            rows = rows[np.argsort(windows[rows].view(np.uint64), kind="stable")]
            self.by_size[size] = windows[rows].view(np.uint64), rows

    def find(self, size: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each hash its first entry and the number of entries; and the entries' rows."""
        known, rows = self.by_size[size]
        first = np.searchsorted(known, hashes)
        return first, np.searchsorted(known, hashes, side="right") - first, rows


def _isin(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.searchsorted(known, values)
    return known[np.minimum(at, len(known) - 1)] == values if len(known) else np.zeros(len(values), dtype=bool)


def _document_hits(parts: Iterator[pa.RecordBatch], text: str, block: Windows, span: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The rows with n_words, hits and items."""
    for batch in parts:
        for part in batches.slices(batch, text):
            words = batches.words(*batches.buffers(part.column(text)), inside=batches.ALPHANUMERIC)
            doc = np.repeat(np.arange(part.num_rows), words.counts)
            hit, pairs = np.zeros(len(words.hash) + 1, dtype=np.int64), []
            for size in block.by_size:
                if size == span:
                    _, at, prints = fingerprints(words, span, gram)
                    at = np.unique(at[_isin(prints, block.prints)])
                    starts = np.unique((at[:, None] - np.arange(span - gram + 1)).ravel())
                    starts = starts[(starts >= 0) & (starts <= len(words.hash) - span)]
                else:
                    starts = np.arange(max(0, len(words.hash) - size + 1))
                starts = starts[words.inside(size)[starts]]
                first, count, rows = block.find(size, words.grams(size, _SEED)[starts])
                starts, first, count = starts[count > 0], first[count > 0], count[count > 0]
                np.add.at(hit, starts, 1)
                np.add.at(hit, starts + size, -1)
                entries = rows[batches.ranges(first, count)]
                pairs.append(np.unique(np.stack([np.repeat(doc[starts], count), entries]), axis=1))
            hits = np.flatnonzero(np.cumsum(hit[:-1]) > 0)
            of_doc = np.searchsorted(doc[hits], np.arange(part.num_rows + 1))
            items = [set() for _ in range(part.num_rows)]
            for row, entry in np.concatenate(pairs, axis=1).T.tolist() if pairs else []:
                items[row].add(block.items[entry])
            places = (hits - words.first[:-1][doc[hits]]).astype(np.int32)
            found = {"n_words": pa.array(words.counts.astype(np.int64)),
                     "hits": pa.ListArray.from_arrays(of_doc.astype(np.int32), pa.array(places)),
                     "items": pa.array([sorted(names) for names in items], pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([*part.columns, *found.values()], names=[*part.schema.names, *found])


def item_windows(items: DataFrame, item_column: str, text_column: str, span: int, gram: int) -> DataFrame:
    table = Table(items)
    item = F.coalesce(table.col(item_column).cast("string"), F.lit(""))
    return table.df.select(item.alias("_item"), table.col(text_column).alias("_text")).mapInArrow(
        lambda parts: _item_windows(parts, span, gram), _WINDOWS).distinct()


def hits(docs: DataFrame, items: DataFrame, text_column: str = "text", item_column: str = "item_id",
         item_text_column: str = "text", span: int = 10, gram: int = 5, block_windows: int = 500_000) -> DataFrame:
    """``docs`` with n_words, hits (sorted places of hit words, from 0) and items (ids, as sorted strings,
    whose windows occur)."""
    windows = stage(item_windows(items, item_column, item_text_column, span, gram))
    blocks = 1 + windows.count() // block_windows
    dealt = F.pmod(F.xxhash64("_window", "_item"), F.lit(blocks))
    table = Table(docs)
    text, rows = table.at(text_column), table.df
    if blocks > 1:  # rows get numbers, which the written table keeps
        rows = stage(rows.withColumn("_row", F.monotonically_increasing_id()))
    found = []
    for number in range(blocks):
        block = windows.filter(dealt == number).toArrow()
        numbers = [block.column(c).to_numpy().astype(np.int64) for c in ("_size", "_print", "_window")]
        shared = docs.sparkSession.sparkContext.broadcast((numbers, block.column("_item").to_pylist()))
        read = rows if blocks == 1 else rows.select("_row", text)

        def run(parts, shared=shared):
            columns, names = shared.value
            return _document_hits(parts, text, Windows(*columns, names, span), span, gram)

        found.append(read.mapInArrow(run, schema_with(
            read, n_words=T.LongType(), hits=T.ArrayType(T.IntegerType()), items=T.ArrayType(T.StringType()))))
    if blocks == 1:
        return table.restore(found[0], "n_words", "hits", "items")
    merged = reduce(DataFrame.unionByName, found).groupBy("_row").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return table.restore(rows.join(merged, "_row"), "n_words", "hits", "items")


def contamination(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated."""
    found = hits(docs, items, **settings).withColumns({
        "n_hit": F.size("hits").cast("long"), "n_items": F.size("items").cast("long"),
        "items_sha256": F.sha2(F.array_join("items", ","), 256), "contaminated": F.size("hits") > 0})
    return found.drop("hits", "items")
