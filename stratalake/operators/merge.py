"""The match of a stored table with a newer source, in one pass (JOIN-6, JOIN-7, UPS-1..3, SCD-1, SCD-2).

Every business id of either side meets once in a full outer join, which gives each pair a class. Rows to keep,
to change, to expire and to add all follow from that one join, so each side is shuffled at most once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Classes of a pair, and the rows that come out of it.
KEEP, CHANGE, EXPIRE, INSERT = "keep", "change", "expire", "insert"
OLD, NEW, SIDE = "old", "new", "_side"

#: Materialises a table, in folders by the named column if there is one.
Staged = Callable[..., DataFrame]


def unstaged(df: DataFrame, by: str | None = None) -> DataFrame:
    return df


def match(old: DataFrame, new: DataFrame, id_col: str, verdict: Column) -> DataFrame:
    """(id, _old, _new, _class): both rows of every id as structs, NULL where a side lacks the id.

    ``verdict`` is the class of an id that both sides hold. Ids are unique on each side; a NULL id meets nothing.
    """
    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(id_col, F.struct(*[c for c in df.columns if c != id_col]).alias(name))

    pairs = packed(old, "_old").join(packed(new, "_new"), id_col, "full")
    kind = F.when(F.col("_old").isNull(), INSERT).when(F.col("_new").isNull(), KEEP).otherwise(verdict)
    return pairs.withColumn("_class", kind)


def outcome(pairs: DataFrame, old: Mapping[str, Column], new: Mapping[str, Column], expires: bool = False) -> DataFrame:
    """(_class, _side, columns): the stored row of a pair as it will be, its new row, or both for EXPIRE.

    ``old`` and ``new`` give the columns of either row; a column that only one of them names is NULL in the other.
    ``expires`` says whether the pairs may have that class.
    """
    kind = F.col("_class")
    side = F.when(kind == INSERT, NEW).otherwise(OLD)
    if expires:
        side = F.explode(F.when(kind == EXPIRE, F.array(F.lit(OLD), F.lit(NEW))).otherwise(F.array(side)))
    stored = F.col("_side") == OLD
    columns = [F.when(stored, old[c]).otherwise(new[c]) if c in old and c in new else F.when(stored, old[c]) if c in old
               else F.when(~stored, new[c]) for c in {**old, **new}]
    rows = pairs.withColumn("_side", side)
    return rows.select("_class", "_side", *[c.alias(name) for c, name in zip(columns, {**old, **new})])


def split(rows: DataFrame, kept: Sequence[str], added: Sequence[str], staged: Staged = unstaged) -> tuple[DataFrame, DataFrame]:
    """(stored rows, new rows) of an ``outcome``, which is worked out once if ``staged`` materialises it."""
    stored, new = split_slices(rows, kept, added, staged)
    return stored, new[NEW]


def split_slices(rows: DataFrame, kept: Sequence[str], added: Sequence[str], staged: Staged = unstaged, by: str = "",
                 slices: int = 1) -> tuple[DataFrame, dict[str, DataFrame]]:
    """As ``split``, with the new rows in so many slices of the column ``by``, under the value of ``SIDE`` they are staged by."""
    side, sides = F.col(SIDE), [NEW]
    if slices > 1:
        sides = [f"{NEW}-{i}" for i in range(slices)]
        of = F.concat(F.lit(f"{NEW}-"), F.pmod(F.xxhash64(by), F.lit(slices)).cast("string"))
        rows = rows.withColumn(SIDE, F.when(side == NEW, of).otherwise(side))
    rows = staged(rows, SIDE)
    return rows.where(side == OLD).select(*kept), {s: rows.where(side == s).select(*added) for s in sides}
