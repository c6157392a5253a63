"""A content-addressed WARC archive (operator 7).

An archive is a folder with two tables. ``payloads`` holds the bytes of each distinct payload once, under
its SHA-256; ``headers`` holds for every record the exact bytes that stand before the payload: the WARC
header and the HTTP header. A record is rebuilt by joining the two.

Of records with equal payloads of at least ``min_bytes``, the one with the largest id is a ``response``; the
others are ``revisit`` records, which refer to it and repeat the HTTP header but not the payload. The
digest is verified twice: payloads of one digest must have one length and one SHA-1 when they are
written, and the stored bytes must have the digest that they are stored under when they are read.

Payloads are brought down to one per digest before the shuffle, and only ids, urls and digests are joined
with them, so a payload that a third of all pages share is neither moved nor stored many times.

Edge cases: a NULL payload is the empty one. Rows without an id come before every other, so they are
revisits of a row with an id; rows that have the largest id of their payload together are all responses.
A NULL url has no WARC-Target-URI; line ends in a url are percent-encoded. Equal rows give equal
records. An empty table gives an empty archive. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratalake.llm.frames import Table

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_END = "\r\n\r\n"
_NAME = "urn:page:"


def base32_of_hex(digest: Column) -> Column:
    """Bare upper-case base32 of a hexadecimal SHA-1: every 5 hexadecimal digits are 4 of base32."""
    def digit(i: Column) -> Column:
        part = F.conv(F.substring(digest, F.floor(i / 4).cast("int") * 5 + 1, 5), 16, 10).cast("long")
        value = F.call_function("shiftright", part, (15 - 5 * (i % 4)).cast("int")).bitwiseAND(F.lit(31).cast("long"))
        return F.substring(F.lit(_BASE32), value.cast("int") + 1, 1)

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), digit), "")


def write(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html",
          date: str = "1970-01-01T00:00:00Z", min_bytes: int = 0) -> None:
    """Writes one record per row of ``pages`` to a new archive in ``folder``."""
    table = Table(pages)
    payload = F.encode(F.coalesce(table.col(payload_column).cast("string"), F.lit("")), "UTF-8")
    records = table.df.select(table.col(id_column).cast("long").alias("id"), table.col(url_column).cast("string").alias("url"), payload.alias("payload"))
    records = records.select("id", "url", "payload", F.sha2("payload", 256).alias("digest"), F.sha1("payload").alias("sha1"),
                             F.octet_length("payload").cast("long").alias("bytes"))
    kept = records.groupBy("digest").agg(
        F.max("id").alias("holder"), F.first("payload").alias("payload"), F.max("sha1").alias("sha1"), F.max("bytes").alias("bytes"),
        ((F.min("bytes") == F.max("bytes")) & (F.min("sha1") == F.max("sha1"))).alias("equal"))
    kept.select("digest", F.when(F.col("equal"), F.col("payload")).otherwise(F.raise_error(F.lit(
        "payloads of one SHA-256 differ"))).alias("payload"), "sha1", "bytes", "holder").write.parquet(f"{folder}/payloads")

    holders = pages.sparkSession.read.parquet(f"{folder}/payloads").select("digest", "holder")
    joined = records.drop("payload").join(holders, "digest")
    revisit = (F.col("bytes") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("holder"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(_END))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    def name(id_: str) -> Column:
        return F.concat(F.lit(f"<{_NAME}"), F.coalesce(F.col(id_).cast("string"), F.lit("")), F.lit(">"))

    lines = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name("id")), F.lit(f"WARC-Date: {date}"), F.concat(F.lit("WARC-Target-URI: "), url),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name("holder"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_of_hex(F.col("sha1"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))).cast("string")))
    joined.select("digest", F.encode(F.concat(lines, F.lit(_END), http), "UTF-8").alias("header")).write.parquet(f"{folder}/headers")


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?md)^{name}: ?([^\r\n]*)", 1)
    return F.when(found != "", found)


def read_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Per record: header (bytes), digest and the fields id, url, record_type, refers_to, payload_digest and
    payload_bytes as its header gives them."""
    header = F.decode("header", "UTF-8")
    warc, http = F.substring_index(header, _END, 1), F.substring_index(F.substring_index(header, _END, -2), _END, 1)

    def id_in(name: str) -> Column:
        found = F.regexp_extract(warc, rf"(?md)^{name}: <{_NAME}(-?\d+)>", 1)
        return F.when(found != "", found.cast("long"))

    return spark.read.parquet(f"{folder}/headers").select(
        "header", "digest", id_in("WARC-Record-ID").alias("id"), _field(warc, "WARC-Target-URI").alias("url"),
        _field(warc, "WARC-Type").alias("record_type"), id_in("WARC-Refers-To").alias("refers_to"),
        F.substring_index(_field(warc, "WARC-Payload-Digest"), ":", -1).alias("payload_digest"),
        _field(http, "Content-Length").cast("long").alias("payload_bytes"))


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """digest and payload; reading fails on bytes that do not have the digest they are stored under."""
    stored = spark.read.parquet(f"{folder}/payloads")
    return stored.select("digest", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))).alias("payload"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every record with its fields, its payload and its exact bytes as ``record``."""
    joined = read_headers(spark, folder).join(read_payloads(spark, folder), "digest")
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return joined.withColumn("record", F.concat(F.col("header"), body, F.lit(_END.encode()))).drop("header", "digest")


def verified(spark: SparkSession, folder: str) -> DataFrame:
    """The fields of every record, with length and SHA-1 of the stored payload that it is joined with
    instead of what its header says; fails where the two differ."""
    stored = read_payloads(spark, folder).select(
        F.col("digest"), F.octet_length("payload").cast("long").alias("stored_bytes"), base32_of_hex(F.sha1("payload")).alias("stored_digest"))
    joined = read_headers(spark, folder).drop("header").join(stored, "digest")
    agree = (F.col("stored_bytes") == F.col("payload_bytes")) & (F.col("stored_digest") == F.col("payload_digest"))
    return joined.select("id", "url", "record_type", "refers_to", F.col("stored_bytes").alias("payload_bytes"), F.when(
        agree, F.col("stored_digest")).otherwise(F.raise_error(F.lit("a header does not fit its payload"))).alias("payload_digest"))
