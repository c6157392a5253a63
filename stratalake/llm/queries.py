"""One query per operator of this package over the whole of its table, with production parameters."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.llm import (bpe, decontaminate, filter_audit, labelled, licenses, line_dedup, ngram_join, quality_model, quality_rules,
                            simhash, spelling, substring_dedup, toxicity, warc)
from stratalake.session import shared_dir


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_licenses(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.train(docs))


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(_read(spark, folder, "documents").select("doc_id", "text"), _read(spark, folder, "benchmark"))
    return found.drop("text")


def op3_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    scored = quality_model.score(docs, quality_model.train(docs, _read(spark, folder, "labels")))
    return scored.select("doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, _read(spark, folder, "labels")))
    return scored.select("doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def tokenizer_path() -> str:
    """The installed tokenizer file that the queries use; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _bpe_digests(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id and digests of ids and decoded."""
    for batch in parts:
        ids, decoded = [], []
        for value in batch.column("ids"):
            numbers = value.values.to_numpy().tolist()
            ids.append(hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest())
        for value in batch.column("decoded").to_pylist():
            decoded.append(hashlib.sha256(value.encode()).hexdigest())
        yield pa.record_batch([batch.column("doc_id"), batch.column("ids").value_lengths().cast(pa.int64()),
                               pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                              names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def bpe_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them."""
    shared = bpe.shared(docs.sparkSession, tokenizer_path())

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = bpe.Vocabulary(*shared.value)
        encoded = bpe.encode_batches(parts, vocabulary, "text", "ids")
        return _bpe_digests(bpe.decode_batches(encoded, vocabulary, "ids", "decoded"))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digests(_read(spark, folder, "documents"))


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: removed units, as places in the original text, and what is left."""
    kept = substring_dedup.dedup_units(_read(spark, folder, "documents").select("doc_id", "text"), passages=True)
    return kept.select("doc_id", F.size("removed").cast("long").alias("n_removed"), F.aggregate(
        "removed", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"]).alias("chars_removed"), F.array_join(F.transform(
            "removed", lambda span: F.concat_ws("-", span["start"], span["end"])), ",").alias("removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(_read(spark, folder, "pages"), archive)
    return warc.verified(spark, archive).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(_read(spark, folder, "documents"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(_read(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_read(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group(_read(spark, folder, "documents"))


def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_licenses, op2_decontaminate, op3_quality_model, op4_bpe, op5_toxicity, op6_substring_dedup, op7_warc, op8_ngram_join, op9_quality_rules, op10_line_dedup,
                                   op11_filter_audit, op12_spelling, op13_simhash, pipeline)}
