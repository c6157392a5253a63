"""Dense surrogate keys without a global sort (KEY-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, ShortType

from stratalake.operators.merge import Staged, unstaged

# A 64-bit id is cut into 18 + 23 + 23 bits, which bounds every window partition below:
# at most 2**18 new rows per bucket (ids are unique), at most 2**23 bucket counts per group
# and at most 2**23 group counts, whatever the ids are.
BUCKET_BITS = 18
GROUP_BITS = 23


def highest_key(table: DataFrame, key_col: str) -> Column:
    """The largest key given so far, 0 for an empty table, as a scalar subquery."""
    return F.coalesce(table.agg(F.max(F.col(key_col).cast("long"))).scalar(), F.lit(0).cast("long"))


def assign_keys(new_rows: DataFrame, id_col: str, key_col: str, base: Column | int = 0, staged: Staged = unstaged) -> DataFrame:
    """``new_rows`` with ``key_col`` = base + 1, 2, … in order of the unique whole number ``id_col``.

    A NULL id stops the job, because it has no place in that order. Rows are ranked inside narrow id ranges; a running total of the (pre-aggregated) range
    sizes says how many rows come before each range. ``staged`` may materialise the ranked rows and the totals: the
    rows are then worked out and shuffled once, and any later use of the result only adds the totals to the ranks.
    """
    base = F.lit(base).cast("long") if isinstance(base, int) else base
    given = F.coalesce(F.col(id_col).cast("long"), F.raise_error(F.lit(f"{id_col} is NULL")).cast("long"))
    bucket = F.shiftright(given, BUCKET_BITS)
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(id_col))
    ranked = new_rows.withColumn("_bucket", bucket).withColumn("_rank", rank)
    written = staged(ranked)
    if written is ranked:
        sizes = new_rows.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
    else:
        sizes = written.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    if isinstance(new_rows.schema[id_col].dataType, (ByteType, ShortType, IntegerType)):
        # A 32-bit id has at most 2**14 ranges: one short running total.
        offsets = sizes.select("_bucket", _running_total(Window.orderBy("_bucket")).alias("_before"))
    else:
        sizes = sizes.withColumn("_group", F.shiftright("_bucket", GROUP_BITS))
        group_sizes = sizes.groupBy("_group").agg(F.sum("_rows").alias("_rows"))
        near = sizes.select("_group", "_bucket", _running_total(
            Window.partitionBy("_group").orderBy("_bucket")).alias("_near"))
        far = group_sizes.select(F.col("_group").alias("_g"), _running_total(Window.orderBy("_group")).alias("_far"))
        # The null-safe match adds no filter to one side only, so both sides share one count of the sizes.
        offsets = near.join(far, F.col("_group").eqNullSafe(F.col("_g"))).select(
            "_bucket", (F.col("_near") + F.col("_far")).alias("_before"))
    return (
        written.join(staged(offsets), "_bucket")
        .withColumn(key_col, base + F.col("_before") + F.col("_rank"))
        .drop("_bucket", "_rank", "_before")
    )


def _running_total(window) -> Column:
    """Sum of the rows before the current one."""
    return F.coalesce(F.sum("_rows").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
