"""Filter interaction audit (operator 11): what each filter removes in every order of five filters.

Filters, over words ``[^\\x20\\x09-\\x0D]+``; a document fails

A with fewer than ``min_words`` words,
B if its distinct words are fewer than ``distinct_percent`` % of its words,
C if more than ``capital_percent`` % of its code points are ``[A-Z]``,
D if it holds one of ``symbols``,
E if its text is that of a document with a smaller id, whether that one was removed or not.

1. One pass over the texts gives every row its failures of A to D as bits and the hash of its text.
2. E is an existential self-join: rows whose hash occurs more than once are left-semi joined on hash, exact text
   and smaller id. The right side holds the smallest id per text, reduced before the shuffle, so a text that a
   third of all rows share meets one row there; the left side of such a hot text is split by Spark at run time.
3. The ids that fail E are united with those that fail another filter, and bits are or-ed per id.
4. Documents are counted per part and combination of bits: at most 31 numbers a part, from which all orders
   follow without going back to documents.

Edge cases: NULL text is the empty text; NULL part the empty string. A row without an id has no smaller id and is
nobody's smaller id, so it never fails E nor makes others fail. Rows of one id are documents of their own;
equal rows of one id do not make each other fail. An id with several labels counts as good (toxic) if one of
them says so; unlabelled documents are neither. Other columns are ignored, whatever their names. An empty
table has no parts and gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.llm.frames import Table
from stratalake.llm.quality_rules import SPACES, words_of
from stratalake.session import stage

FILTERS = "ABCDE"
COPY = "E"  # the filter that compares documents; all others look at one text
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@dataclass(frozen=True)
class Limits:
    """Parameters of the filters."""

    min_words: int = 50
    distinct_percent: int = 65
    capital_percent: int = 5
    symbols: str = "#$%&*|"


def bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def text_failures(text: Column, words: Column, limits: Limits) -> Column:
    """The failures of one text as bits."""
    n_words, capitals = F.size(words), F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    failing = {
        "A": n_words < limits.min_words,
        "B": 100 * F.size(F.array_distinct(words)) < limits.distinct_percent * n_words,
        "C": 100 * capitals.cast("long") > limits.capital_percent * F.length(text).cast("long"),
        # what is left of the text without the symbols is shorter if it held one
        "D": F.length(F.translate(text, limits.symbols, "")) < F.length(text),
    }
    return sum((F.when(failed, bit(letter)).otherwise(0) for letter, failed in failing.items()), F.lit(0))


def later_copies(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """The ``rows`` (id, part, hash, text) whose text a row with a smaller id has; ``hashes`` are all rows' hashes."""
    again = stage(hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"))
    held = rows.join(again, "hash", "left_semi")
    firsts = held.groupBy(F.col("hash").alias("_hash"), F.col("text").alias("_text")).agg(F.min("id").alias("_first"))
    smaller = (F.col("hash") == F.col("_hash")) & (F.col("text") == F.col("_text")) & (F.col("_first") < F.col("id"))
    return held.join(firsts, smaller, "left_semi")


def failures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source",
             limits: Limits = Limits()) -> tuple[DataFrame, DataFrame]:
    """(failing, sizes): id, part, bits and copies (equal rows) of what fails a filter, and the rows of each part."""
    table = Table(docs)
    text = F.coalesce(table.col(text_column).cast("string"), F.lit(""))
    rows = table.df.select(table.col(id_column).alias("id"), F.coalesce(table.col(part_column).cast("string"), F.lit("")).alias("part"),
                           F.xxhash64(text).alias("hash"), text.alias("text"))
    # equal ids, hashes and lengths stand for equal rows, which fail the same filters
    row = ("id", "part", "hash", "chars")
    judged = stage(rows.withColumns({"chars": F.length("text"), "_words": words_of(F.col("text"))}).select(
        *row, text_failures(F.col("text"), F.col("_words"), limits).alias("bits")))
    copies = later_copies(rows, judged).withColumn("chars", F.length("text")).select(*row, F.lit(bit(COPY)).alias("bits"))
    is_copy = F.col("bits") == bit(COPY)
    failing = judged.filter("bits > 0").unionByName(copies).groupBy(*row).agg(
        F.bit_or("bits").alias("bits"), F.greatest(F.count_if(is_copy), F.count_if(~is_copy)).alias("copies"))
    return failing.select("id", "part", "bits", "copies"), judged.groupBy("part").agg(F.count(F.lit(1)).alias("total"))


def combinations(failing: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Documents per part and combination of failures (bits): n, and how many of them are good and toxic."""
    table = Table(labels)
    label = table.df.filter(table.col(id_column).isNotNull()).groupBy(table.col(id_column).alias("id")).agg(
        *(F.max(F.when(table.col(c) == 1, 1).otherwise(0)).alias(c) for c in ("quality", "toxic")))
    counted = failing.join(label, "id", "left")
    return counted.groupBy("part", "bits").agg(
        F.sum("copies").alias("n"), *(F.sum(F.col("copies") * F.coalesce(c, F.lit(0))).alias(n)
                                      for c, n in (("quality", "good"), ("toxic", "toxic"))))


def orders(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the ``combinations`` and the rows of each part."""
    n = len(FILTERS)
    found = counts.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("found"))  # at most 2**n - 1
    every = F.split(F.lit(" ".join(map("".join, permutations(FILTERS)))), " ")
    steps = sizes.join(found, "part", "left").withColumn("found", F.coalesce("found", F.array().cast(found.schema["found"].dataType))) \
        .withColumn("filter_order", F.explode(every)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))

    def bits_of(letters: Column) -> Column:
        return sum((F.when(F.instr(letters, c) > 0, bit(c)).otherwise(0) for c in FILTERS), F.lit(0))

    steps = steps.withColumns({"own": bits_of(F.substr("filter_order", F.col("step"), F.lit(1))),
                               "earlier": bits_of(F.substr("filter_order", F.lit(1), F.col("step") - 1))})

    def total(value, condition) -> Column:
        return F.aggregate("found", F.lit(0).cast("long"), lambda sum_, c: sum_ + F.when(condition(c), value(c)).otherwise(0))

    def fails(c: Column, bits: str) -> Column:
        return c["bits"].bitwiseAND(F.col(bits)) > 0

    def removed(c: Column) -> Column:
        return fails(c, "own") & ~fails(c, "earlier")

    measures = {
        "kept": F.col("total") - total(lambda c: c["n"], lambda c: fails(c, "own") | fails(c, "earlier")),
        "removed": total(lambda c: c["n"], removed),
        "redundant": total(lambda c: c["n"], lambda c: fails(c, "own") & fails(c, "earlier")),
        "unique_fails": total(lambda c: c["n"], lambda c: c["bits"] == F.col("own")),
        "good_lost": total(lambda c: c["good"], removed),
        "toxic_lost": total(lambda c: c["toxic"], removed),
        # of the filters that a document fails, each comes first in the same number of orders
        "shapley": total(lambda c: c["n"] * F.call_function("div", F.lit(factorial(n)), F.bit_count(c["bits"])), lambda c: fails(c, "own")),
    }
    return steps.select("part", "filter_order", "step", *(m.cast("long").alias(name) for name, m in measures.items()))


def audit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          part_column: str = "source", limits: Limits = Limits()) -> DataFrame:
    """part, filter_order, step and the ``MEASURES`` of every part, order of the filters and step."""
    failing, sizes = failures(docs, id_column, text_column, part_column, limits)
    return orders(combinations(failing, labels), sizes)
