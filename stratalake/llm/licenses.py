"""License scans (operator 1), as DataFrame and SQL functions and Spark ML only.

A paragraph is a line. A multinomial logistic regression over hashed word uni- and bigrams, with a sparse
(L1) penalty, names the licence family of a paragraph or ``unknown``. It is trained on the notices below in
several wordings, on statements about rights that name no family, and on ordinary paragraphs of the corpus
(at most ``background`` of them, in the order of a hash).

The unknown class is calibrated on wordings that training does not see: a family is only named from the
probability halfway between the smallest that its own wordings reach and the largest that the other
statements reach. A named family must then be confirmed by comparison with a template: at least
``confirm`` of a notice's bigrams are in the paragraph. A paragraph that is named but not confirmed, or
confirmed for another family, is ``unknown``.

Every paragraph that is not blank is classified and compared. The result has those that hold a term of licence
notices and those in which a template of their most likely family is found; any other is an ordinary paragraph
and gives no row.
Everything is decided within a row; nothing is shuffled but the training sample.

Edge cases: NULL and empty texts have no paragraphs. Rows are scanned one by one, equal rows alike, and
rows without an id keep NULL. Texts of any length are read whole. An empty table gives an empty result
(training then has no background). Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratalake.llm.frames import Table
from stratalake.session import stage

# Names that notices give the licence families.
NAMES = {
    "apache": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 license"],
    "mit": ["MIT License", "MIT licence", "Expat License"],
    "bsd": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "modified BSD license"],
    "gpl": ["GNU General Public License, version 3", "GNU General Public License, version 2", "GNU GPL", "GPLv3 license"],
    "lgpl": ["GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1", "GNU LGPL"],
    "agpl": ["GNU Affero General Public License", "GNU Affero General Public License, version 3", "GNU AGPL"],
    "mpl": ["Mozilla Public License", "Mozilla Public License, version 2.0", "MPL 2.0 license"],
    "cc-by": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License"],
    "cc-by-sa": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc0": ["CC0 1.0", "Creative Commons Zero", "CC0 public domain dedication"],
}
# Wordings around a name; every third is kept for calibration.
WORDINGS = [
    "Licensed under {}.", "Licensed under the {}.", "This work is licensed under {}.", "Released under the {}.", "Released under {}.",
    "This work is licensed under the {}.", "This program is distributed under the terms of the {}.", "Distributed under {}; see LICENSE.",
    "The source code is available under the {}.", "You may use this file under the {}.", "License: {}", "Published under the {}.",
]
# Statements about rights that name no family.
OTHERS = [
    "All rights reserved.", "Copyright by the author.", "Licensed under separate terms.", "Released under the terms of the contract.",
    "This work is licensed to the customer only.", "Distributed under an agreement between the parties.", "A license is required to use this file.",
    "Used with permission.", "The license may be revoked.", "Released under a proprietary license.", "Public domain in some countries.",
    "You may not use this file.", "Published under embargo.", "The software license fee is due in March.", "No permission is granted.",
    "Licensed under the Example Company License.", "Released under the laws of the state.", "This program is distributed to members.",
]
# Terms of licence notices, as plain text and as whole words of which the part without marks is plain text.
PLAIN_TERMS = ["license", "licence", "released under", "distributed under", "published under", "under the terms", "creative commons",
               "public domain", "copyright", "permission", "all rights reserved", *(f"under the {name}" for name in ("apache", "mit", "bsd", "gnu", "mozilla"))]
WHOLE_TERMS = {"cc0": r"\bcc0\b", "cc by": r"\bcc by"}
TERMS = "|".join([*PLAIN_TERMS, *WHOLE_TERMS.values()])  # all of them as one pattern
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *NAMES]


@dataclass
class Scanner:
    model: LogisticRegressionModel
    threshold: float
    features: int


def words_of(text: Column) -> Column:
    """Lower-cased words; marks inside a name (BY-NC, 2.0) stay."""
    found = F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.+-]+|[.]+(?=\s|$)", " "), " ")  # one blank is no pattern
    return F.filter(found, lambda w: F.length(w) > 0)


def bigrams_of(words: Column) -> Column:
    """Neighbouring words, with marks for the first and the last; computed once per row."""
    def pairs(all_: Column) -> Column:
        return F.transform(all_, lambda w, i: F.concat(F.when(i == 0, "<").otherwise(F.get(all_, i - 1)), F.lit(" "), w))

    return F.transform(F.array(words), pairs)[0]


def has_term(lower: Column) -> Column:
    """Whether a lower-cased paragraph holds a term of licence notices; patterns are only tried where their text occurs."""
    plain = [F.contains(lower, F.lit(term)) for term in PLAIN_TERMS]
    return reduce(Column.__or__, plain + [F.contains(lower, F.lit(term)) & lower.rlike(pattern) for term, pattern in WHOLE_TERMS.items()])


def _featured(paragraphs: DataFrame, features: int) -> DataFrame:
    counted = paragraphs.withColumn("_words", words_of(F.col("paragraph"))).withColumn("_pairs", bigrams_of(F.col("_words")))
    for column, out in (("_words", "_one"), ("_pairs", "_two")):
        counted = HashingTF(numFeatures=features, binary=True, inputCol=column, outputCol=out).transform(counted)
    return VectorAssembler(inputCols=["_one", "_two"], outputCol="features").transform(counted).drop("_one", "_two")


def _notices(spark: SparkSession) -> DataFrame:
    """(paragraph, family, kept_back) of the notices and the other statements."""
    rows = [(wording.format(name), family, i % 3 == 2) for family, names in NAMES.items() for name in names for i, wording in enumerate(WORDINGS)]
    rows += [(text, UNKNOWN, i % 3 == 2) for i, text in enumerate(OTHERS)]
    return spark.createDataFrame(rows, "paragraph string, family string, kept_back boolean")


def paragraphs_of(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, place, paragraph) of all lines that are not blank."""
    table = Table(docs)
    lines = F.filter(F.transform(F.split(table.col(text_column), "\n"), lambda line, i: F.struct(i.alias("place"), line.alias("paragraph"))),
                     lambda x: F.btrim(x["paragraph"], F.lit(" \t\r")) != "")
    return table.df.select(table.col(id_column).alias("doc_id"), F.inline(lines))


def _index(family: Column) -> Column:
    return (F.array_position(F.array(*map(F.lit, FAMILIES)), family) - 1).cast("double")


def train(docs: DataFrame, text_column: str = "text", background: int = 1000, features: int = 1 << 14) -> Scanner:
    """A scanner; ``docs`` give ordinary paragraphs for the unknown class."""
    spark = docs.sparkSession
    lines = docs.select(F.explode(F.split(F.col(text_column), "\n")).alias("paragraph")).withColumn("_lower", F.lower("paragraph"))
    ordinary = lines.filter((F.length("paragraph") > 0) & ~has_term(F.col("_lower"))).select("paragraph").orderBy(
        F.xxhash64("paragraph"), "paragraph").limit(background)
    notices = _notices(spark)
    seen = notices.filter("not kept_back").select("paragraph", "family").unionByName(ordinary.select("paragraph", F.lit(UNKNOWN).alias("family")))
    labelled = _featured(stage(seen).coalesce(1), features).withColumn("label", _index(F.col("family")))  # a bounded sample
    weight = F.when(F.col("family") == UNKNOWN, 0.3).otherwise(1.0)
    regression = LogisticRegression(maxIter=40, regParam=2e-3, elasticNetParam=0.5, family="multinomial", weightCol="weight")
    model = regression.fit(labelled.withColumn("weight", weight).select("features", "label", "weight"))
    kept = model.transform(_featured(notices.filter("kept_back").coalesce(1), features)).select("family", vector_to_array("probability").alias("p"))
    best = F.array_max(F.slice("p", 2, len(FAMILIES) - 1))
    right = F.get(F.col("p"), _index(F.col("family")).cast("int"))
    low, high = kept.agg(F.min(F.when(F.col("family") != UNKNOWN, right)), F.max(F.when(F.col("family") == UNKNOWN, best))).first()
    return Scanner(model, min(0.9, max(0.2, (low + high) / 2)), features)


def templates(spark: SparkSession) -> dict[str, list[list[str]]]:
    """The distinct bigrams of each family's names, without what precedes a name."""
    rows = [(family, name) for family, names in NAMES.items() for name in names]
    found = spark.createDataFrame(rows, "family string, name string").withColumn("pairs", bigrams_of(words_of(F.col("name"))))
    inner = F.slice("pairs", 2, F.greatest(F.size("pairs") - 1, F.lit(1)))
    collected = found.select("family", "name", F.array_distinct(inner).alias("inner")).collect()  # a row for each name
    return {family: [r["inner"] for r in collected if r["family"] == family] for family in NAMES}


def template_overlap(pairs: Column, family: Column, known: dict[str, list[list[str]]]) -> Column:
    """The largest share of a name's bigrams of the family that are among ``pairs``."""
    names = F.create_map(*(x for f, inner in known.items() for x in (F.lit(f), F.array(*(F.array(*map(F.lit, pairs_)) for pairs_ in inner)))))
    return F.array_max(F.transform(names[family], lambda inner: F.size(F.filter(inner, lambda x: F.array_contains(pairs, x))) / F.size(inner)))


def scan(docs: DataFrame, scanner: Scanner, id_column: str = "doc_id", text_column: str = "text", confirm: float = 0.9) -> DataFrame:
    """One row per paragraph with a licence term or a confirmed template: doc_id, place (line, from 0), family,
    probability (of the most likely family) and overlap with its closest template."""
    named = scanner.model.transform(_featured(paragraphs_of(docs, id_column, text_column), scanner.features))
    p = vector_to_array("probability")
    named = named.withColumn("_lower", F.lower("paragraph"))
    named = named.select("doc_id", "place", "_pairs", has_term(F.col("_lower")).alias("_term"), F.slice(p, 2, len(FAMILIES) - 1).alias("_p")).withColumn(
        "probability", F.array_max("_p"))
    named = named.withColumn("_family", F.element_at(F.array(*map(F.lit, NAMES)), F.array_position("_p", F.col("probability")).cast("int")))
    named = named.withColumn("overlap", template_overlap(F.col("_pairs"), F.col("_family"), templates(docs.sparkSession)))
    certain = (F.col("probability") >= scanner.threshold) & (F.col("overlap") >= confirm)
    # ordinary paragraphs go by a generator without output: a filter would move below the model and work it out twice
    listed = F.explode(F.when(F.col("_term") | (F.col("overlap") >= confirm), F.array(F.lit(1)))).alias("_listed")
    return named.select("doc_id", "place", F.when(certain, F.col("_family")).otherwise(UNKNOWN).alias("family"),
                        F.round("probability", 6).alias("probability"), "overlap", listed).drop("_listed")
