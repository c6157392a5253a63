"""Spelling variant grouping by pivotal grams (operator 12).

Words that differ by exactly one inserted, deleted or replaced code point are near. A word's form is its most frequent
near word (ties: the smallest in code-point order) if that is ``times`` as frequent or more; following
forms to the last gives the word's root.

1. Words are counted over all texts; those of at least ``min_chars`` code points and ``min_count`` occurrences remain.
2. A word's grams are its bigrams with their places, ordered by how many words hold the bigram, rarest first.
   Its prefix is its three rarest grams (and others of the third one's bigram). One edit destroys at most two
   grams, so a near word holds a gram of the prefix. The pivots are two grams of the prefix that share no letter,
   the two of the least total frequency, chosen by dynamic programming; one edit destroys one of them at most.
3. Of two near words, the one whose prefix ends earlier in the order has a pivot that is left whole, and the
   other's prefix holds it: what comes as early as the end of the first prefix lies inside the second.
   So pivots are joined with prefixes and never whole gram lists. Place and length are part of the key: an edit shifts a
   gram by one place at most, and by none where the lengths are equal.
4. Pairs are verified inside the join: letters that occur in one word only, then the edit distance.

There are at most 90 ** 2 different bigrams (``LETTERS`` without A-Z), which bounds their collected counts.

Edge cases: NULL text has no words; equal rows count each time. A NULL id reads as the empty text in the rule that deletes
letters. Words of any length are compared whole. Words without a near word have n_near 0, no form and themselves as
root. Forms are strictly more frequent, so following them ends; after r rounds 2 ** r of them are followed. Other
columns are ignored, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratalake.llm.frames import Table
from stratalake.session import stage

LETTERS = "A-Za-zÀ-ÿ"
GRAM = 2  # letters of a gram
EDITS = 1
#: Places a gram can shift where the other word is longer by so many letters.
SHIFTS = {0: (0,), 1: (0, 1), -1: (0, -1)}
_GRAMS = "array<struct<gram int, place int>>"


def runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, run): each run of letters of each text, A-Z lower-cased."""
    table = Table(docs)
    found = F.regexp_extract_all(table.col(text_column).cast("string"), F.lit(f"[{LETTERS}]+"), F.lit(0))
    lower = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return table.df.select(F.coalesce(table.col(id_column).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run")).select(
        "id", lower.alias("run"))


def without_some_letters(run: Column, doc_id: Column, one_in: int = 199) -> Column:
    """The run; where ``one_in`` divides the crc32 of ``<id>:<run>``, without its code point at crc32 % length."""
    crc = F.crc32(F.encode(F.concat(doc_id, F.lit(":"), run), "UTF-8"))
    place = (crc % F.length(run) + 1).cast("int")
    return F.when(crc % one_in == 0, F.overlay(run, F.lit(""), place, F.lit(1))).otherwise(run)


def vocabulary(words: DataFrame, min_chars: int = 6, min_count: int = 5) -> DataFrame:
    """(word, n) of the frequent words among the rows ``word``."""
    long = words.filter(F.length("word") >= min_chars)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Each bigram's place in the order (rarest first) and how many times the words hold it; at most 8,100 entries."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr("word", i, F.lit(GRAM)))
    counts = words.filter(F.length("word") >= GRAM).select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    ordered = sorted((r["n"], r["gram"]) for r in counts.collect())
    return {gram: (i, n) for i, (n, gram) in enumerate(ordered)}


def prefix(word: str, order: Mapping[str, tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(place in the order, place in the word, count) of the rarest grams: as many as edits can destroy and one
    more, with all others of the last one's bigram."""
    grams = sorted((order[word[i:i + GRAM]][0], i, order[word[i:i + GRAM]][1]) for i in range(len(word) - GRAM + 1))
    last = grams[min(GRAM * EDITS, len(grams) - 1)][0]
    return [g for g in grams if g[0] <= last]


def pivots(grams: list[tuple[int, int, int]], count: int = EDITS + 1) -> list[tuple[int, int, int]]:
    """``count`` of the grams that share no letter, with the least total count.

    best[k] is the best choice of k grams among those that end before the current one; grams come by place.
    """
    grams = sorted(grams, key=lambda g: g[1])
    best: list[list[tuple[int, list]]] = [[(0, [])] + [(1 << 62, [])] * count]  # after each gram
    for at, gram in enumerate(grams):
        before = next((j for j in range(at - 1, -1, -1) if grams[j][1] + GRAM <= gram[1]), -1)
        row = list(best[-1])
        for k in range(1, count + 1):
            cost, chosen = best[before + 1][k - 1]
            if cost + gram[2] < row[k][0]:
                row[k] = (cost + gram[2], [*chosen, gram])
        best.append(row)
    return best[-1][count][1]


def _select(parts: Iterator[pa.RecordBatch], order: Mapping[str, tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("gram", pa.int32()), ("place", pa.int32())]))
    for batch in parts:
        last, pivot, held = [], [], []
        for word in batch.column("word").to_pylist():
            grams = prefix(word, order)
            last.append(grams[-1][0])
            pivot.append([{"gram": g, "place": p} for g, p, _ in pivots(grams)])
            held.append([{"gram": g, "place": p} for g, p, _ in grams])
        yield pa.record_batch([batch.column("word"), batch.column("n"), pa.array(last, pa.int32()), pa.array(pivot, kind), pa.array(held, kind)],
                              names=["word", "n", "last", "pivots", "prefix"])


def near_words(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n), once per pair of near words of the distinct ``words`` (word, n) of at least four letters."""
    order = gram_order(words)
    chosen = stage(words.select("word", "n").mapInArrow(
        lambda parts: _select(parts, order), f"word string, n long, last int, pivots {_GRAMS}, prefix {_GRAMS}"))
    # a letter's bit; words one edit apart differ in two letters at most
    letters = F.aggregate(F.split("word", ""), F.lit(0).cast("long"),
                          lambda found, c: found.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 61)))
    sized = chosen.withColumns({"chars": F.length("word"), "letters": letters})
    moves = F.array(*(F.struct(F.lit(longer).alias("longer"), F.lit(shift).alias("shift")) for longer, shifts in SHIFTS.items() for shift in shifts))
    left = sized.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("last").alias("a_last"), F.col("letters").alias("a_letters"),
                        F.col("chars").alias("a_chars"), F.explode("pivots").alias("pivot")) \
        .withColumn("move", F.explode(moves)).select(
        "a", "a_n", "a_last", "a_letters", F.col("pivot.gram").alias("gram"), (F.col("pivot.place") + F.col("move.shift")).alias("place"),
        (F.col("a_chars") + F.col("move.longer")).alias("chars"))
    right = sized.select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("last").alias("b_last"), F.col("letters").alias("b_letters"),
                         F.col("chars").alias("_chars"), F.explode("prefix").alias("held")).select(
        "b", "b_n", "b_last", "b_letters", F.col("held.gram").alias("_gram"), F.col("held.place").alias("_place"), "_chars")
    met = left.join(right, [F.col("gram") == F.col("_gram"), F.col("place") == F.col("_place"), F.col("chars") == F.col("_chars"),
                            F.col("a_last") <= F.col("b_last"), F.col("a") != F.col("b"),
                            F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2 * EDITS,
                            F.levenshtein("a", "b", EDITS) == EDITS])
    turned = F.col("a") < F.col("b")
    return met.select(F.when(turned, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(turned, F.col("a_n")).otherwise(F.col("b_n")).alias("a_n"),
                      F.when(turned, F.col("b")).otherwise(F.col("a")).alias("b"), F.when(turned, F.col("b_n")).otherwise(F.col("a_n")).alias("b_n")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the rows (word, form): the last of the forms that follow each other."""
    state = stage(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stage(state.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if joined.filter("moved").isEmpty():
            return state
        state = joined.drop("moved")


def variants(words: DataFrame, times: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row (word, n)."""
    words = stage(words)
    pairs = stage(near_words(words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("_best"))
    fit = -F.col("_best.less") >= times * F.col("n")
    judged = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fit, F.col("_best.other")).alias("form"), F.when(fit, -F.col("_best.less")).alias("form_n")))
    last = roots(judged.filter("form is not null"))
    return judged.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = 6, min_count: int = 5,
          times: int = 5, one_in: int = 199) -> DataFrame:
    """``variants`` of the frequent words of ``docs``, some of whose runs lose a letter by ``without_some_letters``."""
    words = runs(docs, id_column, text_column).select(without_some_letters(F.col("run"), F.col("id"), one_in).alias("word"))
    return variants(vocabulary(words, min_chars, min_count), times)
