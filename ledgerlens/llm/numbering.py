"""Global row numbers and running totals without a single-task sort.

Rows are spread over a fixed number of buckets by a hash of their identity; each
bucket is ordered on its own, and a table of one row per bucket (a fixed bound,
so it is safe to broadcast and to scan in one task) gives what lies before it.
The numbers depend on the rows alone, not on how they were partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096


def bucket_of(identity: list[Column], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*identity), F.lit(buckets)).cast("int")


def starts(rows: DataFrame, bucket: str, amount: Column, buckets: int = BUCKETS) -> DataFrame:
    """Per bucket the sum of ``amount`` before it (``__start``) and over all buckets (``__total``)."""
    sums = rows.groupBy(bucket).agg(F.sum(amount).cast("long").alias("__sum"))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return sums.select(bucket, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"),
                       F.sum("__sum").over(every).alias("__total"))


def running(rows: DataFrame, order: list[str], amount: Column, *, bucket: str, into: str,
            total: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``into``: the sum of ``amount`` over all rows before this one, by bucket and then ``order``.

    ``bucket`` names an existing bucket column; rows equal in ``order`` must be
    equal in ``amount`` too, they are then interchangeable.
    """
    before = Window.partitionBy(bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    table = starts(rows, bucket, amount, buckets)
    out = rows.withColumn("__before", F.coalesce(F.sum(amount).over(before), F.lit(0)))
    out = out.join(F.broadcast(table), bucket, "left")  # at most `buckets` rows
    keep = [c for c in out.columns if c not in ("__before", "__start", "__total")]
    extra = [F.col("__total").alias(total)] if total else []
    return out.select(*keep, (F.col("__start") + F.col("__before")).cast("long").alias(into), *extra)
