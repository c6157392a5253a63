"""SimHash near duplicates by an inverted index over byte positions (operator 13).

A text's A-Z are lower-cased; its shingles are runs of ``size`` words ``[^\\x20\\x09-\\x0D]+`` joined by one blank,
repeats included (fewer words: all of them are one shingle). A fingerprint bit is 1 if more than half of the
shingles' XXH64 hashes (UTF-8, seed 42) have it. Fingerprints that differ in at most ``max_bits`` bits are linked.

1. Documents are reduced to distinct fingerprints first, so copies never meet in pairs.
2. A fingerprint is eight positional bytes (position, byte). Differing bits lie in at most ``max_bits`` of them,
   so a linked pair shares at least 8 - ``max_bits``: the guaranteed minimum. A posting list of one positional byte would
   hold a 256th of all fingerprints, so the index's lists are those of several positional bytes together: the
   positions are cut into ``max_bits`` + 2 blocks, of which a linked pair shares at least two whole ones, and there is one
   list per two blocks and their bytes. Every linked pair meets in a list, and lists that hold one fingerprint are dropped.
3. For pairs that meet in a list the shared positional bytes are tallied; pairs that reach the guaranteed minimum
   are verified by their differing bits. All this is the condition of the join, so no other pair is written.
4. Fingerprints in a list of more than ``longest`` (a large group of near copies) are not compared in pairs.
   Two fingerprints that differ in at most two bits have a common neighbour that differs from each in
   one bit at most. Each such fingerprint names its 65 neighbours, itself included, and those that name the same
   one are linked to the smallest of them: at most 65 per neighbour, so the work grows with the list and no
   link between groups is lost. With ``max_bits`` = 1 the same lists are verified once more by the fingerprints
   of either side of one bit (the neighbour must be one of the two).
5. Links are closed to connected components; a component's name is its smallest doc_id.

Edge cases: NULL and blank texts have no words and the fingerprint zero, which is linked like any other. Rows without
an id take part with their fingerprint, but never name a component; one whose component has no id at all gets NULL.
Rows of one id are rows of their own, linked by that id. Other columns are ignored, whatever their names. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratalake.llm import batches
from stratalake.llm.components import components
from stratalake.llm.frames import Table
from stratalake.session import stage

SEED = 42
BYTES = 8
_CHUNK = 1 << 16  # shingles hashed at a time


def text_fingerprints(texts: pa.Array, size: int) -> np.ndarray:
    """The fingerprints of some texts, as unsigned numbers."""
    import xxhash

    data, offsets = batches.buffers(texts)
    data = batches.LOWER[data]
    is_word = np.concatenate(([False], batches.NOT_SPACE[data], [False]))
    breaks = np.zeros(len(data) + 1, dtype=bool)
    breaks[offsets] = True
    start = np.flatnonzero(is_word[1:] & (~is_word[:-1] | breaks))
    end = np.flatnonzero(is_word[:-1] & (~is_word[1:] | breaks))
    first = np.searchsorted(start, offsets)
    words = np.diff(first)
    shingles = np.where(words > 0, np.maximum(words - size + 1, 1), 0)
    ones = np.zeros((len(words), 64), dtype=np.int64)
    document = np.repeat(np.arange(len(words)), shingles)
    begin = batches.ranges(first[:-1], shingles)  # each shingle's first word
    last = np.minimum(begin + size, np.repeat(first[1:], shingles))  # and the one after its last
    for at in range(0, len(begin), _CHUNK):
        low, high, owner = begin[at:at + _CHUNK], last[at:at + _CHUNK], document[at:at + _CHUNK]
        a, b = int(low[0]), int(high[-1])
        length = end[a:b] - start[a:b] + 1  # every word with the blank after it
        stop = np.cumsum(length)
        joined = data[np.minimum(batches.ranges(start[a:b], length), len(data) - 1)]
        joined[stop - 1] = 0x20
        text, here = joined.tobytes(), stop - length
        hashes = [xxhash.xxh64_intdigest(text[x:y], SEED) for x, y in zip(here[low - a].tolist(), (stop[high - 1 - a] - 1).tolist())]
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, BYTES), axis=1)
        cuts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        ones[owner[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > shingles[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def _batches(parts: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in parts:
        for part in batches.slices(batch, "text"):
            found = text_fingerprints(part.column("text"), size).view(np.int64)
            yield pa.record_batch([part.column("id"), pa.array(found)], names=["id", "print"])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 3) -> DataFrame:
    """(id, print) of every row; the fingerprint as a signed 64-bit number."""
    table = Table(docs)
    return table.df.select(table.col(id_column).cast("long").alias("id"), table.col(text_column).cast("string").alias("text")).mapInArrow(
        lambda parts: _batches(parts, size), "id long, print long")


def shared_bytes(a: Column, b: Column) -> Column:
    """How many of the eight positional bytes two fingerprints share."""
    other = a.bitwiseXOR(b)
    return sum((F.when(other.bitwiseAND(F.lit(_signed(0xFF << 8 * i))) == 0, 1).otherwise(0) for i in range(BYTES)), F.lit(0))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def blocks(max_bits: int) -> list[int]:
    """Masks of the posting lists: every two of ``max_bits`` + 2 blocks of neighbouring positions."""
    cuts = [round(i * BYTES / (max_bits + 2)) for i in range(max_bits + 3)]
    single = [sum(0xFF << 8 * i for i in range(a, b)) for a, b in zip(cuts, cuts[1:])]
    return [a | b for a, b in combinations(single, 2)]


def links(prints: DataFrame, max_bits: int = 2, longest: int = 64) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``print``, enough to connect all that differ in at most
    ``max_bits`` (0, 1 or 2) bits, and none between others that are not connected by such links."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits is 0, 1 or 2")
    if max_bits == 0:
        return prints.select(F.col("print").alias("a"), F.col("print").alias("b")).limit(0)
    posted = prints.select("print", F.posexplode(F.array(*(
        F.col("print").bitwiseAND(F.lit(_signed(mask))) for mask in blocks(max_bits)))).alias("positions", "bytes"))
    lists = stage(posted.groupBy("positions", "bytes").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    here = ["positions", "bytes"]
    met = stage(posted.join(lists, here))
    short = met.filter(F.col("n") <= longest).drop("n")
    a, b = short.withColumnRenamed("print", "a"), short.withColumnRenamed("print", "b")
    same = [a[c] == b[c] for c in here]
    enough = shared_bytes(a["a"], b["b"]) >= BYTES - max_bits
    verified = F.bit_count(a["a"].bitwiseXOR(b["b"])) <= max_bits
    found = a.join(b, [*same, a["a"] < b["b"], enough, verified]).select("a", "b")

    dense = met.filter(F.col("n") > longest).select("print").distinct()
    flips = F.array(F.lit(0).cast("long"), *(F.lit(_signed(1 << i)).cast("long") for i in range(64)))
    near = dense.select("print", F.explode(F.transform(flips, lambda f: F.col("print").bitwiseXOR(f))).alias("near"))
    if max_bits == 1:
        crowd = near.join(dense.select(F.col("print").alias("near")), "near").select(F.col("near").alias("a"), F.col("print").alias("b"))
        return found.unionByName(crowd.filter("a < b"))
    crowd = near.groupBy("near").agg(F.collect_list("print").alias("held")).filter(F.size("held") > 1)  # at most 65
    return found.unionByName(crowd.select(F.array_min("held").alias("a"), F.explode("held").alias("b")).filter("a < b"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 3,
                    max_bits: int = 2, longest: int = 64) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    rows = stage(fingerprints(docs, id_column, text_column, size))
    classes = stage(rows.groupBy("print").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")))
    # rows of one id are one document, whatever their texts
    several = rows.filter("id is not null").groupBy("id").agg(F.min("print").alias("a"), F.max("print").alias("z")).filter("a <> z")
    by_id = rows.join(several.select("id", "a"), "id").select("a", F.col("print").alias("b")).filter("a <> b").distinct()
    joined = components(links(classes.select("print"), max_bits, longest).unionByName(by_id))
    grouped = classes.join(joined, F.col("print") == F.col("node"), "left").select(
        "print", "least", "n", F.coalesce("component", "print").alias("component"))
    smallest = grouped.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("n").alias("rows"))
    # documents that are alone keep their own id and need no join
    named = stage(grouped.select("print", "component").join(smallest.filter("rows > 1"), "component").select("print", "component_id", F.lit(True).alias("_found")))
    hexed = F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint")
    return rows.join(named, "print", "left").select(
        F.col("id").alias("doc_id"), hexed, F.when(F.col("_found"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
