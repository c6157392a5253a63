"""Quality rules by distribution divergence (operator 9), as DataFrame expressions only.

Base rules, over words ``[^\\x20\\x09-\\x0D]+``: a document fails with fewer than ``min_words`` words, or if more
than ``max_repeat_percent`` % of its words lie in 3-word windows that the document holds twice or more.

Divergence rules, for documents that pass them: the histogram of character classes and the histogram of
the language's most common words are compared with the language's reference by Jensen-Shannon distance
(base 2, from 0 to 1). A histogram of n counts strays from its source by an amount that shrinks as
1/sqrt(n), so each limit is ``limit + slack / sqrt(n)``, and a histogram of fewer than its minimum of
counts is not judged.

References are learnt from all documents of at least ``min_words`` words: class shares are averaged over
documents as whole parts per million, and word counts added up, so the references do not depend on the
order of rows. Every language with at least ``reference_docs`` of these documents and ``reference_words`` words in
them has a reference of its own, however small its share. References are joined to the documents; Spark
broadcasts them only if they are small. A document of any other language has nothing to be
compared with and is not judged by divergence. A document without a language keeps its words unjudged; its character
classes are compared with the references of the ``near_languages`` largest languages and of all documents,
and the nearest counts.

Edge cases: NULL text reads as the empty text, which has no words and fails. Rows are judged one by one,
so equal rows get equal verdicts. Without any reference (an empty table, or no document of
``min_words`` words) nothing is judged by divergence. Other columns pass through unchanged; columns with the name
of a result column are replaced. Texts of any length are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.llm.frames import Table
from stratalake.session import stage

SPACES = " \t\n\x0b\x0c\r"
_SPACE = r"[\x20\x09-\x0D]"
_NO_SYMBOLS = r"[^#*$%&|<>]+"

#: Character classes that are counted on their own, as the pattern of what does not belong. White space and
#: symbols are counted by the base rules; all other characters, mostly small letters, are the rest.
CLASSES = {"capital": r"[^A-Z\xC0-\xDE]+", "sentence": r"[^.,;:?!'\"()-]+"}
N_CLASSES = len(CLASSES) + 3
ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance",
         "word_distance", "kept")


@dataclass(frozen=True)
class Rules:
    """Parameters of both groups of rules."""

    min_words: int = 50
    max_repeat_percent: int = 50
    common_words: int = 24
    reference_docs: int = 20  # of a language, and words in them, for it to have a reference
    reference_words: int = 5_000
    near_languages: int = 1000  # whose classes a document without a language is compared with
    class_limit: float = 0.13
    class_slack: float = 1.0
    min_chars: int = 100
    word_limit: float = 0.14
    word_slack: float = 1.65
    min_judged_words: int = 50


def let(value: Column, then) -> Column:
    """``then`` of a value that is computed once for a row, also if ``then`` uses it many times."""
    return F.transform(F.array(value), then)[0]


def count_of(text: Column, others: str) -> Column:
    """Code points of ``text`` outside the pattern ``others``."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE + "+"))


def with_repeated_words(df: DataFrame) -> DataFrame:
    """``n_repeat_words``: how many of ``_words`` lie in a 3-word window that comes up twice or more.

    Only a text whose window hashes are not all different is looked at closer: its windows are sorted as the upper
    bits of their hash followed by their place, and neighbours of one hash count if their words are equal. Hashes and sorted
    ones are columns of their own: inside a lambda Spark would not compile finding the distinct ones and sorting.
    """
    left, right = (partial(F.call_function, f"shift{side}") for side in ("left", "right"))
    words, windows, keys = F.col("_words"), F.col("_windows"), F.col("_keys")
    bits = F.length(F.bin(F.size(windows)))

    def covered(bits: Column, mask: Column) -> Column:
        def both(x: Column, other: Column) -> Column:
            at, to = (k.bitwiseAND(mask).cast("int") for k in (x, other))
            same = reduce(Column.__and__, (F.get(words, at + i) == F.get(words, to + i) for i in range(3)))
            return F.when((right(x.bitwiseXOR(other), bits) == 0) & same, F.array(at, to))

        pairs = F.filter(F.zip_with(keys, F.slice(keys, 2, F.size(keys)), both), lambda pair: pair.isNotNull())
        return let(F.array_distinct(F.flatten(pairs)), lambda starts: F.size(F.array_distinct(F.concat(
            starts, F.transform(starts, lambda at: at + 1), F.transform(starts, lambda at: at + 2)))))

    df = df.withColumn("_windows", let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.slice(F.transform(
        h, lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2))), 1, F.greatest(F.size(h) - 2, F.lit(0)))))
    df = df.withColumn("_keys", F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.sort_array(let(
        bits, lambda b: F.transform(windows, lambda h, i: left(h, b).bitwiseOR(i.cast("long")))))))
    n = F.when(keys.isNotNull(), let(F.length(F.bin(F.size(keys))), lambda b: let(
        left(F.lit(1).cast("long"), b) - 1, lambda mask: covered(b, mask)))).otherwise(0)
    return df.withColumn("n_repeat_words", n.cast("long")).drop("_windows", "_keys")


def duplicate_lines(text: Column) -> Column:
    full = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    return let(full, lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def with_base(df: DataFrame, text: Column, rules: Rules) -> DataFrame:
    """The base columns, and the words of the text as ``_words``."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    df = with_repeated_words(df.withColumns({"_text": text, "_words": words_of(text)}))
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": count_of(F.col("_text"), _NO_SYMBOLS),
        "n_dup_lines": duplicate_lines(F.col("_text")),
    })
    return df.withColumn("base_failed", (F.col("n_words") < rules.min_words)
                         | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))


def class_columns(df: DataFrame) -> list[Column]:
    """Code points of each class but the rest, of a table with base columns."""
    found = [count_of(df["_text"], others) for others in CLASSES.values()]
    return [*found, F.length(df["_text"]) - df["word_chars"], df["n_symbols"]]


def class_counts(df: DataFrame) -> Column:
    """Code points of each class, the rest last, of a table with base columns."""
    return let(F.array(*class_columns(df)), lambda c: F.concat(c, F.array(F.length(df["_text"]) - F.aggregate(
        c, F.lit(0).cast("long"), lambda a, b: a + b))))


def references(df: DataFrame, language: Column, rules: Rules) -> DataFrame:
    """Per language (NULL: all documents, classes only): docs, total (of words), classes (shares), words and
    shares (the last: all other words)."""
    found = [f"_class{i}" for i in range(N_CLASSES)]
    df = df.withColumns(dict(zip(found, class_columns(df))))
    df = df.withColumn(found[-1], F.length("_text") - reduce(Column.__add__, map(F.col, found[:-1])))
    learnt = F.col("n_words") >= rules.min_words  # not a filter, which would split texts once more
    # two plain groupings, of documents and of words: Spark compiles each from the text to the counts as one
    own = stage(df.groupBy(language.alias("language")).agg(
        F.count(F.when(learnt, 1)).alias("docs"), F.sum(F.when(learnt, F.col("n_words"))).alias("total"),
        *(F.sum(F.when(learnt, F.floor(F.col(c) * 1_000_000 / F.length("_text")).cast("long"))).alias(c) for c in found)).filter("docs > 0"))
    pooled = own.agg(F.lit(None).cast("string").alias("language"), F.sum("docs").alias("docs"), F.lit(None).cast("long").alias("total"),
                     *(F.sum(c).alias(c) for c in found)).filter("docs > 0")
    totals = own.filter("language is not null").unionByName(pooled).select("language", "docs", "total", F.array(*found).alias("sums"))

    keys = df.select(language.alias("language"), F.explode(F.when(learnt & language.isNotNull(), F.col("_words"))).alias("key"))
    counts = keys.groupBy("language", "key").agg(F.count("*").alias("n"))
    best = Window.partitionBy("language").orderBy(F.col("n").desc(), F.col("key"))
    words = counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= rules.common_words).groupBy("language").agg(
        F.array_sort(F.collect_list(F.struct("rank", "key", "n"))).alias("top"))
    joined = totals.join(words, "language", "left")
    return joined.select(
        "language", "docs", "total",
        F.transform("sums", lambda n: n / F.aggregate("sums", F.lit(0).cast("long"), lambda a, b: a + b)).alias("classes"),
        F.transform("top", lambda t: t["key"]).alias("words"),
        F.concat(F.transform("top", lambda t: t["n"] / F.col("total")), F.array(
            (F.col("total") - F.aggregate("top", F.lit(0).cast("long"), lambda a, t: a + t["n"])) / F.col("total"))).alias("shares"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares, in base 2."""
    def part(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    total = F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)
    return F.sqrt(F.greatest(F.lit(0.0), total / 2))


def word_shares(words: Column, common: Column, most: int) -> Column:
    """Shares of the at most ``most`` common words among the words, and of all others.

    Every common word becomes a character of its own and all others nothing, so counting a word is counting a character.
    """
    marks = [chr(48 + i) for i in range(most)]
    by_place = F.array(F.lit(""), *map(F.lit, marks))

    def shares(found: Column, total: Column) -> Column:
        counts = F.transform(F.slice(F.array(*map(F.lit, marks)), 1, F.size(common)), lambda mark: (
            F.length(found) - F.length(F.replace(found, mark, F.lit("")))) / total)
        return F.concat(counts, F.array((total - F.length(found)) / total))

    def found(all_: Column, longest: Column) -> Column:
        # most words are longer than the common ones and need not be compared with them
        return F.array_join(F.transform(all_, lambda w: F.when(
            F.length(w) <= longest, F.get(by_place, F.array_position(common, w).cast("int")))), "")

    return let(words, lambda all_: let(F.array_max(F.transform(common, lambda c: F.length(c))), lambda longest: let(
        found(all_, longest), lambda marked: shares(marked, F.size(all_)))))


def judge(docs: DataFrame, text_column: str = "text", language_column: str = "lang", rules: Rules = Rules()) -> DataFrame:
    """``docs`` with the base columns, both distances (NULL where not judged) and kept."""
    table = Table(docs)
    language = table.col(language_column).cast("string")
    based = with_base(table.df, table.col(text_column), rules)
    learnt = stage(references(based, language, rules))
    own = learnt.filter((F.col("docs") >= rules.reference_docs) & (F.col("total") >= rules.reference_words)
                        & F.col("language").isNotNull())
    near = own.orderBy(F.col("docs").desc(), "language").limit(rules.near_languages).unionByName(learnt.filter("language is null"))
    based = based.join(own.select("language", "classes", "words", "shares"), language == F.col("language"), "left").join(
        F.broadcast(near.agg(F.collect_list("classes").alias("_near"))), F.lit(True), "left")
    chars = F.length("_text")
    shares = F.transform(class_counts(based), lambda n: n / F.length(based["_text"]))
    compared = F.when(F.col("classes").isNotNull(), F.array("classes")).when(language.isNull(), F.col("_near"))
    judged = based.withColumns({
        "class_distance": F.when(~F.col("base_failed") & (chars >= rules.min_chars) & (F.size(compared) > 0), let(
            shares, lambda found: F.array_min(F.transform(compared, lambda classes: js_distance(found, classes))))),
        "word_distance": F.when(~F.col("base_failed") & (F.col("n_words") >= rules.min_judged_words) & F.col("words").isNotNull(),
                                js_distance(word_shares(F.col("_words"), F.col("words"), rules.common_words), F.col("shares"))),
    })
    strays = (F.col("class_distance") > rules.class_limit + rules.class_slack / F.sqrt(chars)) \
        | (F.col("word_distance") > rules.word_limit + rules.word_slack / F.sqrt("n_words"))
    judged = judged.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(strays, F.lit(False)))
    return table.restore(judged, *ADDED)


def keep(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps.

    Rejected rows go by a generator without output, not by a filter: Spark would move a filter below the
    columns it uses and work them out again for each use.
    """
    judged = judge(docs, **settings)
    return judged.select(*docs.columns, F.explode(F.when(F.col("kept"), F.array(F.lit(1)))).alias("_once")).drop("_once")
