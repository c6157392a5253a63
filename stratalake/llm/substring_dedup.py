"""Substring dedup by unit hashing (operator 6).

Units are lines and, within lines, sentences: a unit ends at a line end, or after ``.``, ``!`` or ``?`` before
white space. A unit is normalised to its lower-cased words between single blanks; units of fewer than
``min_words`` words are left alone. Of all units of one normal form, in all documents, the earliest ranked
stays: the order is doc_id (NULL last), then the place in the text. The rest is removed from the texts,
and the places of the removed units in the original text are kept.

With ``passages``, as the query has it, whole lines, paragraphs (between blank lines) and texts are units too, so that
a repeated passage goes with its short sentences, and copies of a text go whole. A sentence then also ends after the
full stops of Chinese and Japanese, and two letters of a script without blanks count as one word. Removed
places that lie in another are not reported.

Units are grouped by a 128-bit digest. The earliest is a minimum per digest, taken before the shuffle,
so a passage in a third of all documents is not gathered anywhere; only digests that come up twice go
on, and Spark splits a hot one in the join that marks what is removed. A document's removed places are
gathered by document and are at most as many as its units.

Edge cases: NULL text reads as the empty text and stays NULL. Rows of one doc_id and one text count as
the same document, so they lose the same units; rows of one doc_id and different texts, or without
doc_id, are ranked among themselves by a hash of the text. Texts of any length are read whole. An empty
table gives an empty result. Other columns, whatever their names, stay; those with the name of a result
column are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from stratalake.llm import batches
from stratalake.llm.frames import Table, schema_with
from stratalake.session import stage

_UNITS = "_id long, _mark long, _start int, _end int, _low long, _high long"
_CUT = re.compile(r"[.!?]+(?=\s)|\n")
#: Ends of sentences, lines, paragraphs and texts.
_PASSAGES = (re.compile(r"[.!?]+(?=\s)|[\u3002\uff01\uff1f]+|\n"), re.compile(r"\n"), re.compile(r"\n\s*\n"), re.compile(r"(?!)"))
_NO_BLANKS = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def units(text: str, min_words: int, passages: bool = False) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, digest) of the units with enough words; white space around a unit is outside it."""
    seen, blankless = set(), passages and not text.isascii()
    for cut in _PASSAGES if passages else (_CUT,):
        start = 0
        for end in [*(m.end() for m in cut.finditer(text)), len(text)]:
            unit = text[start:end]
            place = start + len(unit) - len(unit.lstrip()), start + len(unit.rstrip())
            start = end
            if place in seen:  # a line of one sentence, a paragraph of one line
                continue
            seen.add(place)
            words = unit.lower().split()
            if len(words) >= min_words or blankless and len(words) + len(_NO_BLANKS.findall(unit)) // 2 >= min_words:
                yield *place, hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest()


def _all_units(parts: Iterator[pa.RecordBatch], min_words: int, passages: bool) -> Iterator[pa.RecordBatch]:
    for batch in parts:
        for part in batches.slices(batch, "_text"):
            row, starts, ends, digests = [], [], [], []
            for i, text in enumerate(part.column("_text").to_pylist()):
                for start, end, digest in units(text or "", min_words, passages):
                    row.append(i)
                    starts.append(start)
                    ends.append(end)
                    digests.append(digest)
            halves, row = np.frombuffer(b"".join(digests), dtype=np.int64), pa.array(row, pa.int64())
            yield pa.record_batch([part.column("_id").take(row), part.column("_mark").take(row), pa.array(starts, pa.int32()),
                                   pa.array(ends, pa.int32()), pa.array(halves[0::2]), pa.array(halves[1::2])],
                                  names=["_id", "_mark", "_start", "_end", "_low", "_high"])


def _cut_texts(parts: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in parts:
        kept, outer = [], []
        for value, spans in zip(batch.column(text).to_pylist(), batch.column("removed").to_pylist()):
            at, pieces, whole = 0, [], []
            for span in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                if span["end"] > at:  # not within the last one
                    pieces.append(value[at:span["start"]])
                    at = span["end"]
                    whole.append(span)
            kept.append(value if value is None else "".join(pieces) + value[at:])
            outer.append(whole)
        columns = dict(zip(batch.schema.names, batch.columns)) | {
            text: pa.array(kept, pa.string()), "removed": pa.array(outer, batch.schema.field("removed").type)}
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def dedup_units(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = 6,
                passages: bool = False) -> DataFrame:
    """``docs`` with repeated units cut out of the text, and removed: their places (start, end) in code
    points of the original text, in order. ``passages``: whole lines, paragraphs and texts are units too."""
    table = Table(docs)
    text = table.at(text_column)
    keyed = table.df.select("*", table.col(id_column).cast("long").alias("_id"), F.xxhash64(text).alias("_mark"))
    found = keyed.select("_id", "_mark", F.col(text).alias("_text")).mapInArrow(lambda parts: _all_units(parts, min_words, passages), _UNITS)
    found = stage(found)

    rank = F.struct(F.col("_id").isNull().alias("_none"), "_id", "_mark", "_start")
    first = stage(found.groupBy("_low", "_high").agg(F.count(F.lit(1)).alias("_times"), F.min(rank).alias("_first"))
                  .filter("_times > 1").drop("_times"))
    later = found.join(first, ["_low", "_high"]).filter(rank != F.col("_first"))
    spans = later.groupBy("_id", "_mark").agg(F.array_sort(F.collect_set(F.struct(
        F.col("_start").alias("start"), F.col("_end").alias("end")))).alias("removed")).select(
        F.col("_id").alias("_of"), F.col("_mark").alias("_of_mark"), "removed")
    joined = keyed.join(spans, F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_mark") == F.col("_of_mark")), "left")
    places = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    joined = joined.select(*table.own, F.coalesce("removed", F.array().cast(places)).alias("removed"))
    return table.restore(joined.mapInArrow(lambda parts: _cut_texts(parts, text), schema_with(joined, **{text: T.StringType()})), "removed")
