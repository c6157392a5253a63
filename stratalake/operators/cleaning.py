"""Split raw rows into accepted and rejected, and keep the newest row per id
(FLT-1, FLT-2, WIN-1, EXP-25, EXP-26, SNK-2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.merge import Staged, unstaged
from stratalake.schemas import MALFORMED


class Rules(NamedTuple):
    """How one raw table is cleaned. ``parsed`` values are worked out once per raw row; ``checks`` and ``columns``
    use them by name, and ``key`` is one of them."""

    source: str
    raw: Sequence[str]
    parsed: Mapping[str, Column]
    key: str
    checks: Sequence[tuple[str, Column]]
    newest_by: str | None
    columns: Mapping[str, Column]


VERDICT, ACCEPTED, REJECTED = "_verdict", "accepted", "rejected"


def keep_newest(df: DataFrame, keys: Sequence[Column], newest_by: str | None, ties: Sequence[str]) -> DataFrame:
    """One row per key: greatest ``newest_by`` (NULL last), then smallest ``ties``.

    Written as row_number() = 1, which Spark limits to one row per key inside every map task
    before it shuffles, so a key holding much of the table never travels whole.
    Rows equal in all ``ties`` are interchangeable when ``ties`` names every column.
    """
    order = [F.col(newest_by).desc()] if newest_by else []
    order += [F.col(c).asc() for c in ties if c != newest_by]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def judge(bronze: DataFrame, rules: Rules, slices: int = 1) -> DataFrame:
    """The raw rows with the parsed values, every failed check's name (``_reason``) and the verdict on the row, which for
    accepted ones names their slice of the ids if there are several."""
    checks = list(rules.checks)
    if MALFORMED in bronze.columns:
        checks = [("malformed row", F.col(MALFORMED).isNotNull()), *checks]
    raw = [c for c in bronze.columns if c in rules.raw or c == MALFORMED]
    judged = bronze.select(*raw, *[c.alias(name) for name, c in rules.parsed.items()]).withColumn("_reason", reason(checks))
    accepted = F.lit(ACCEPTED)
    if slices > 1:
        accepted = F.concat(F.lit(f"{ACCEPTED}-"), F.pmod(F.xxhash64(rules.key), F.lit(slices)).cast("string"))
    return judged.withColumn(VERDICT, F.when(F.col("_reason") == "", accepted).otherwise(REJECTED))


def _once(judged: DataFrame, verdict: str) -> DataFrame:
    """The rows of one verdict of a table that is not written. The others go by a generator without output:
    a filter would move below the parsed values and work them out again for each use."""
    kept = F.when(F.col(VERDICT) == verdict, F.array(F.lit(1)))
    return judged.select(*judged.columns, F.explode(kept).alias("_kept")).drop("_kept")


def clean(bronze: DataFrame, rules: Rules, load_ts: datetime, staged: Staged = unstaged) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). Every raw row that fails a check is in ``rejected`` with all its reasons;
    rows that only lose against a newer row of the same id are in neither.

    ``staged`` may write the judged rows in folders by verdict; both results then come from one pass over the raw table.
    """
    accepted, rejected = clean_by_slice(bronze, rules, load_ts, staged, 1)
    return accepted[ACCEPTED], rejected


def clean_by_slice(bronze: DataFrame, rules: Rules, load_ts: datetime, staged: Staged, slices: int) -> tuple[dict[str, DataFrame], DataFrame]:
    """(accepted rows by verdict, rejected). All rows of an id are in one of the ``slices``, so each can be deduplicated
    alone, and its shuffle is that part of the table's. Several of them should be ``staged``, or each judges all rows again."""
    judged = judge(bronze, rules, slices)
    raw = [c for c in judged.columns if c in rules.raw or c == MALFORMED]
    written = staged(judged, VERDICT)

    def of(verdict: str) -> DataFrame:
        return written.where(F.col(VERDICT) == verdict) if written is not judged else _once(judged, verdict)

    accepted = {
        verdict: keep_newest(of(verdict).select(*rules.raw, *rules.parsed), [F.col(rules.key)], rules.newest_by, rules.raw)
        .select(*[c.alias(name) for name, c in rules.columns.items()], F.lit(load_ts).alias("dwh_load_date"))
        for verdict in ([ACCEPTED] if slices == 1 else [f"{ACCEPTED}-{i}" for i in range(slices)])
    }
    rejected = of(REJECTED).select(
        F.lit(f"bronze.{rules.source}").alias("source_table"),
        F.col("_reason").alias("rejection_reason"),
        row_to_json(raw).alias("raw_row_json"),
        F.lit(load_ts).alias("rejected_at"),
    )
    return accepted, rejected


def reason(checks: Sequence[tuple[str, Column]]) -> Column:
    """Every failed check's name, in order, separated by '; '. An undecided check has failed."""
    return F.concat_ws("; ", *[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in checks])


def row_to_json(columns: Sequence[str]) -> Column:
    """The row as a JSON object without its NULL fields."""
    return F.to_json(F.struct(*columns))
