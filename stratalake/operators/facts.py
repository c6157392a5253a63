"""Star look-ups and the fact upsert (JOIN-3, JOIN-6, JOIN-7, UPS-2, UPS-3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.measures import differs
from stratalake.operators.keys import assign_keys, highest_key
from stratalake.operators.merge import CHANGE, KEEP, Staged, match, outcome, split, unstaged


class Lookup(NamedTuple):
    """Find ``key_col`` in ``dim`` where the fact's ``on`` equals the dimension's ``id_col``."""

    dim: DataFrame
    on: str
    id_col: str
    key_col: str

    def _rows(self) -> DataFrame:
        """Every row; only current rows where the dimension keeps history."""
        return self.dim.where("is_current") if "is_current" in self.dim.columns else self.dim

    def pairs(self) -> DataFrame:
        return self._rows().select(F.col(self.id_col).alias(self.on), self.key_col)

    def ids(self) -> DataFrame:
        return self._rows().select(F.col(self.id_col).alias(self.on))


def lookup_keys(rows: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Add each dimension's key; a row that misses any dimension drops out.

    No join carries a hint: Spark broadcasts a dimension only if its size is under the
    configured limit, otherwise it sorts and merges and splits hot ids at run time.
    """
    for look in lookups:
        pairs = look.ids() if look.on == look.key_col else look.pairs()
        rows = rows.join(pairs, look.on)
    return rows


def unknown_ids(rows: DataFrame, known: Mapping[str, DataFrame]) -> DataFrame:
    """Per column of ``known``: how many rows, and how many different values, its one-column
    DataFrame does not hold, and how many of those rows are NULL, which is never known.

    One pass over the rows for all columns, which must be whole numbers. Both sides are counted
    per value before they meet, so a value that fills much of the table travels once per task.
    """
    seen = rows.select(*known).unpivot([], list(known), "lookup", "value").select(
        "lookup", "value", F.lit(1).alias("_rows"), F.lit(0).alias("_known"))
    for column, values in known.items():
        seen = seen.union(values.select(F.lit(column), F.col(values.columns[0]), F.lit(0), F.lit(1)))
    per_value = seen.groupBy("lookup", "value").agg(F.sum("_rows").alias("_rows"), F.max("_known").alias("_known"))
    missing = (F.col("_known") == 0) | F.col("value").isNull()
    return per_value.groupBy("lookup").agg(
        F.sum(F.when(missing, F.col("_rows")).otherwise(0)).alias("missing_rows"),
        F.count_if(missing & (F.col("_rows") > 0)).alias("missing_ids"),
        F.sum(F.when(F.col("value").isNull(), F.col("_rows")).otherwise(0)).alias("null_rows"),
    )


def lookup_misses(rows: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """(lookup, missing_rows, missing_ids): rows that ``lookup_keys`` would drop, per dimension."""
    return unknown_ids(rows, {look.on: look.ids() for look in lookups}).drop("null_rows")


def fact_changes(fact: DataFrame, source: DataFrame, id_col: str, mutable: Mapping[str, object], lookups: Sequence[Lookup],
                 load_ts: datetime, ignore_case: bool = False) -> DataFrame:
    """(_class, _side, columns): every fact row as it will be, and the source rows of unknown ids with the
    columns that ``lookups`` go by. Foreign keys, date key and every other column of a known id never move."""
    stamp, changed = F.lit(load_ts), F.col("_class") == CHANGE
    differing = reduce(lambda a, b: a | b, [
        differs(F.col(f"_old.{c}"), F.col(f"_new.{c}"), blank, ignore_case) for c, blank in mutable.items()])
    pairs = match(fact, source, id_col, F.when(differing, CHANGE).otherwise(KEEP))
    stored = {c: F.col(id_col) if c == id_col else F.col(f"_old.{c}") for c in fact.columns}
    stored |= {c: F.when(changed, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")) for c in mutable}
    stored["dwh_load_date"] = F.when(changed, stamp).otherwise(F.col("_old.dwh_load_date"))
    wanted = [c for c in source.columns if c in fact.columns or c in {look.on for look in lookups}]
    return outcome(pairs, stored, {**{c: F.col(id_col) if c == id_col else F.col(f"_new.{c}") for c in wanted}, "dwh_load_date": stamp})


def fact_upsert(fact: DataFrame, source: DataFrame, id_col: str, mutable: Mapping[str, object],
                lookups: Sequence[Lookup], key_col: str, load_ts: datetime, ignore_case: bool = False,
                staged: Staged = unstaged, highest: Column | int | None = None) -> DataFrame:
    """Update the mutable columns of known ids where one differs, then add unknown ids.

    ``staged`` may materialise the matched rows and the new ones with their ranks, which are read several times, so that
    the result need not be written to be read again; ``highest`` is the largest key given so far, where it is known.
    """
    rows = fact_changes(fact, source, id_col, mutable, lookups, load_ts, ignore_case)
    new = [c for c in rows.columns if c in source.columns or c == "dwh_load_date"]
    kept, unseen = split(rows, fact.columns, new, unstaged if fact.select(key_col).isEmpty() else staged)  # a first load joins nothing
    added = assign_keys(lookup_keys(unseen, lookups), id_col, key_col, highest_key(fact, key_col) if highest is None else highest, staged)
    return kept.unionByName(added.select(*fact.columns))
