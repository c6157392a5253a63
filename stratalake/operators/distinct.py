"""Exact distinct counts that can be merged (AGG-5): which keys occur, as words of 64 keys.

Generated keys run from 1 without gaps, so a set of keys is a few 64-bit words, a bit per key. Sets of small groups are
or-ed to those of larger ones without going back to rows, and counted at the end. Only words with a key are kept, so a
set never has more rows than keys, and a word is a number that hash aggregation changes in place: no wide row is ever
sorted. For groups of few keys, such as the patients of one doctor, a plain distinct count is as small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of a table of key sets, besides its groups.
KIND, BUCKET, WORD = "kind", "bucket", "keys"
_BITS = 6  # of a key that say its place in a word


def key_sets(rows: DataFrame, groups: Sequence[str], kinds: Mapping[str, str]) -> DataFrame:
    """(groups, kind, bucket, keys): the keys of each group, for every key column of ``kinds`` (kind: column).
    NULL keys are left out, as a distinct count does."""
    keys = F.array(*[F.struct(F.lit(kind).alias(KIND), F.col(column).cast("long").alias("_key")) for kind, column in kinds.items()])
    found = rows.select(*groups, F.inline(keys)).where(F.col("_key").isNotNull())
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_key").bitwiseAND((1 << _BITS) - 1).cast("int"))
    return found.select(*groups, KIND, F.shiftright("_key", _BITS).alias(BUCKET), bit.alias(WORD)).groupBy(
        *groups, KIND, BUCKET).agg(F.bit_or(WORD).alias(WORD))


def merged_sets(sets: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The key sets of larger groups."""
    return sets.groupBy(*groups, KIND, BUCKET).agg(F.bit_or(WORD).alias(WORD))


def set_sizes(sets: DataFrame, groups: Sequence[str], names: Mapping[str, str]) -> DataFrame:
    """(groups, names): how many keys of each kind a group holds, under the name of the kind."""
    counted = merged_sets(sets, groups).withColumn("_keys", F.bit_count(WORD).cast("long"))
    return counted.groupBy(*groups).agg(*[
        F.coalesce(F.sum(F.when(F.col(KIND) == kind, F.col("_keys"))), F.lit(0).cast("long")).alias(name) for kind, name in names.items()])
