"""A corpus made ready for training: five stages over ``documents``, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``; where a stage
changes a text, n_chars is counted again. The results are defined for every input by the operators'
docstrings; documents without an id stay unless a rule rejects their text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stratalake.llm import decontaminate, line_dedup, ngram_join, quality_rules, queries
from stratalake.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their frequent lines; one that loses all its lines stays, with an empty text."""
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(
        docs.schema["n_chars"].dataType)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates, once: documents of which 80 %
    of the five-word shingles are the same."""
    groups = ngram_join.near_duplicates(docs, size=5, percent=80)
    dropped = groups.filter("component_id <> doc_id").select("doc_id").distinct()
    # rows of one id count as one document; rows without an id do so if their texts are equal
    same = Window.partitionBy("doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64("text"))).orderBy(
        "text", *(c for c in docs.columns if c not in ("doc_id", "text")))
    return docs.join(dropped, "doc_id", "left_anti").withColumn("_place", F.row_number().over(same)).filter(
        "_place = 1").select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter(~F.col("contaminated")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the token ids and of the text decoded from them."""
    return queries.bpe_digests(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", benchmark), ("BPE encoding and decoding", encode)]

#: SQL cannot express byte-pair encoding; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
