"""Positional delimited files into raw tables (SRC-1..4)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.schemas import MALFORMED, RAW


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """All columns as text, by position; the header line is skipped, whatever it says.

    Quoting follows RFC 4180: a quoted field may hold commas, line breaks stay outside, a doubled quote is
    a quote and a backslash is an ordinary character. An empty field is NULL, quoted or not. Lines with too few or too many fields keep what could be read, and the whole line goes
    to ``malformed_line``. Column pruning is off because Spark would otherwise stop counting
    the fields of a line whose later columns are not asked for. Spark refuses queries on the files
    that use ``malformed_line`` alone; ask for another column with it, or read the written table.
    """
    schema = ", ".join(f"{c} string" for c in [*columns, MALFORMED])
    return (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED, escape='"',
                 columnPruning=False)
        .csv(path)
    )


def with_audit(df: DataFrame, source: str, load_ts: datetime) -> DataFrame:
    return df.withColumns({"dwh_source": F.lit(source), "dwh_load_date": F.lit(load_ts)})


def load_bronze(spark: SparkSession, folder: str, load_ts: datetime,
                tables: Mapping[str, Sequence[str]] = RAW) -> dict[str, DataFrame]:
    """``<folder>/<table>.csv`` (a file or a folder of part files) of every table, with audit columns."""
    return {
        name: with_audit(read_delimited(spark, f"{folder.rstrip('/')}/{name}.csv", columns), f"{name}.csv", load_ts)
        for name, columns in tables.items()
    }
