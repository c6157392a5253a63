"""Dimension merges: overwrite (UPS-1) and history-keeping (SCD-1, SCD-2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.measures import differs
from stratalake.operators.keys import assign_keys, highest_key
from stratalake.operators.merge import CHANGE, EXPIRE, KEEP, Staged, match, outcome, split, unstaged


def scd1_merge(dim: DataFrame, snapshot: DataFrame, id_col: str, attrs: Sequence[str], key_col: str,
               load_ts: datetime, staged: Staged = unstaged, highest: Column | int | None = None) -> DataFrame:
    """Overwrite every row the snapshot also has (audit time included, changed or not), append
    the rest of the snapshot under new keys, leave rows the snapshot lacks as they are.
    ``staged`` may materialise the matched rows, which are read three times; ``highest`` is the largest key
    given so far, where it is known."""
    stamp, seen = F.lit(load_ts), F.col("_new").isNotNull()
    pairs = match(dim, snapshot.select(id_col, *attrs), id_col, F.lit(CHANGE))
    taken = {id_col: F.col(id_col), **{a: F.col(f"_new.{a}") for a in attrs}, "dwh_load_date": stamp}
    rows = outcome(pairs, {
        key_col: F.col(f"_old.{key_col}"), id_col: F.col(id_col),
        **{a: F.when(seen, F.col(f"_new.{a}")).otherwise(F.col(f"_old.{a}")) for a in attrs},
        "dwh_load_date": F.when(seen, stamp).otherwise(F.col("_old.dwh_load_date")),
    }, taken)
    kept, added = split(rows, [key_col, *taken], list(taken), staged)
    return kept.unionByName(assign_keys(added, id_col, key_col, highest_key(dim, key_col) if highest is None else highest))


def scd2_merge(dim: DataFrame, snapshot: DataFrame, id_col: str, attrs: Sequence[str],
               tracked: Mapping[str, object], key_col: str, as_of: date, load_ts: datetime,
               ignore_case: bool = False, staged: Staged = unstaged, highest: Column | int | None = None) -> DataFrame:
    """Expire the current version of each id whose tracked attributes changed and add a new one.

    ``tracked`` maps an attribute to the value that stands for its NULL. A current version whose
    tracked attributes did not change keeps all its columns, changed or not; expiring sets only
    ``end_date`` and ``is_current``; ids missing from the snapshot are left alone.
    Needs at most one current version per id, which this merge itself guarantees. Only current versions take
    part in the match. ``staged`` may materialise the matched rows, which are read three times; ``highest`` is the
    largest key given so far, where it is known.
    """
    changed = reduce(lambda a, b: a | b, [
        differs(F.col(f"_old.{c}"), F.col(f"_new.{c}"), blank, ignore_case) for c, blank in tracked.items()])
    pairs = match(dim.where("is_current"), snapshot.select(id_col, *attrs), id_col, F.when(changed, EXPIRE).otherwise(KEEP))
    expired = F.col("_class") == EXPIRE
    stored = {c: F.col(id_col) if c == id_col else F.col(f"_old.{c}") for c in dim.columns}
    version = {
        id_col: F.col(id_col), **{a: F.col(f"_new.{a}") for a in attrs},
        "effective_date": F.lit(as_of), "end_date": F.lit(None).cast("date"), "is_current": F.lit(True), "dwh_load_date": F.lit(load_ts),
    }
    rows = outcome(pairs, {
        **stored, "end_date": F.when(expired, F.lit(as_of)).otherwise(F.col("_old.end_date")), "is_current": ~expired}, version, expires=True)
    versions, added = split(rows, dim.columns, list(version), staged)
    added = assign_keys(added, id_col, key_col, highest_key(dim, key_col) if highest is None else highest)
    return dim.where("NOT is_current").unionByName(versions).unionByName(added)


def version_at(dim: DataFrame, day: Column) -> DataFrame:
    """The version of each id that was valid on ``day``; validity is half-open."""
    return dim.where((F.col("effective_date") <= day) & (F.col("end_date").isNull() | (day < F.col("end_date"))))


def history_of_changes(daily: DataFrame, id_col: str, day_col: str, tracked: Mapping[str, object]) -> DataFrame:
    """The versions that one history-keeping merge per day would leave, in one pass.

    ``daily`` has at most one row per id and day, so an id's window holds at most as many rows
    as there are days.
    """
    by_day = Window.partitionBy(id_col).orderBy(day_col)
    before = F.lag(F.struct(*tracked)).over(by_day)
    changed = reduce(lambda a, b: a | b, [differs(F.col(c), F.col(f"_before.{c}"), blank) for c, blank in tracked.items()])
    starts = daily.withColumn("_before", before).where(F.col("_before").isNull() | changed)
    following = F.lead(day_col).over(by_day)
    return starts.select(
        id_col, *tracked,
        F.col(day_col).alias("effective_date"),
        following.alias("end_date"),
        following.isNull().alias("is_current"),
    )
