"""As-of joins: what was last, next or nearest in time, for a whole table of times in one plan.

Both sides are sorted together by key and time into parts of about the same number of rows, whatever the keys, so that
a key with most of the rows is many parts. Within a part a window carries the last row of the right side forward and
the next one back; what a part lacks comes from the last, or next, part of the key that has one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberwave.plans.shared import saved


def asof(left: DataFrame, right: DataFrame, *by: str, at: str = "time", direction: str = "nearest", prefix: str = "r_") -> DataFrame:
    """``left`` with the columns of one row of ``right`` each, prefixed; nulls where there is none.

    backward takes the last row at or before the time, forward the first after it, nearest the nearer of the two and
    the earlier one of two as near. Of rows of ``right`` at one time the last in order of its other columns counts as
    the last, the first as the next. Null keys are keys of their own; a null time on the left meets nothing.
    """
    return asof_each(left, right, *by, at=at, prefixes={direction: prefix})


def asof_each(left: DataFrame, right: DataFrame, *by: str, prefixes: dict[str, str], at: str = "time") -> DataFrame:
    """``asof`` in several directions at once, with a prefix for each: both sides are sorted together only once."""
    for direction in prefixes:
        if direction not in ("backward", "forward", "nearest"):
            raise ValueError(f"unknown direction: {direction}")
    keys = list(by)
    own = [c for c in left.columns if c not in (*keys, at)]
    theirs = [c for c in right.columns if c not in (*keys, at)]
    row = F.struct(F.col(at).alias(at), *(F.col(c).alias(c) for c in theirs))
    a = left.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_side"), (F.struct(*own) if own else F.lit(0)).alias("_own"))
    b = right.where(F.col(at).isNotNull()).select(*keys, F.col(at).alias("_at"), F.lit(0).alias("_side"), row.alias("_row"))
    both = a.unionByName(b, allowMissingColumns=True)
    order = [*keys, "_at", "_side", "_row"]
    # A right row stands before the left rows of its time, so that backward finds it and forward does not.
    parts = saved(both.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "parts")
    # What comes next is the last one in the opposite order: a frame that ends with the part would be gone over anew for each row.
    within, ends_at = Window.partitionBy(*keys, "_part"), (Window.unboundedPreceding, 0)
    behind = within.orderBy("_at", "_side", "_row").rowsBetween(*ends_at)
    ahead = within.orderBy(F.desc("_at"), F.desc("_side"), F.desc("_row")).rowsBetween(*ends_at)
    found = parts.select("*", F.last("_row", ignorenulls=True).over(behind).alias("_last"), F.last("_row", ignorenulls=True).over(ahead).alias("_next")).where("_side = 1")
    # A row for each key and part, its first and last row of the right side.
    ends = parts.groupBy(*keys, "_part").agg(F.min("_row").alias("_first"), F.max("_row").alias("_final"))
    over = Window.partitionBy(*keys).orderBy("_part")
    carried = ends.select(
        *(F.col(k).alias(f"_k_{k}") for k in keys),
        F.col("_part").alias("_k_part"),
        F.last("_final", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first("_first", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias("_after"),
    )
    same = F.col("_part") == F.col("_k_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    met = found.join(carried, same).withColumn("_last", F.coalesce("_last", "_before")).withColumn("_next", F.coalesce("_next", "_after"))
    picked = met.select("*", *(F.when(F.col("_at").isNotNull(), _chosen(d, at)).alias(f"_got_{d}") for d in prefixes))
    return picked.select(*keys, F.col("_at").alias(at), *(F.col("_own")[c].alias(c) for c in own), *(F.col(f"_got_{d}")[c].alias(f"{prefix}{c}") for d, prefix in prefixes.items() for c in (at, *theirs)))


def _chosen(direction: str, at: str) -> Column:
    last, following = F.col("_last"), F.col("_next")
    if direction == "backward":
        return last
    if direction == "forward":
        return following
    nearer = following[at] - F.col("_at") < F.col("_at") - last[at]
    return F.when(last.isNull() | (following.isNotNull() & nearer), following).otherwise(last)
