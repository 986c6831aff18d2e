"""Final result ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_output(df: DataFrame, order: Sequence[Column | str], ordered: bool = True) -> DataFrame:
    """``ORDER BY`` of a check's result; ``ordered=False`` skips the global sort
    (its range-partitioning shuffle) when the consumer does not need row order.

    Spark's defaults put NULLs first ascending and last descending, as T-SQL does.
    """
    if not ordered or not order:
        return df
    return df.orderBy(*order)


def ranked_output(written: DataFrame, value: str, name: str = "posicao") -> DataFrame:
    """The rows of an ordered output read back, with the position of each (from 1; equal values share the first).

    ``written`` reads the files of an ordered write: they are numbered along the order, so a row's
    position is its index in its file plus the rows of the files before. The first position of
    a value is a grouped least, joined back: no window holds the rows of one value, and only the
    counts, one row per file, are summed in order.
    """
    rows = written.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    number = F.regexp_extract("__file", r"^part-(\d+)", 1).cast("long")
    ahead = Window.orderBy(number, "__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("__file").agg(F.count(F.lit(1)).alias("__rows")).select(
        "__file", F.coalesce(F.sum("__rows").over(ahead), F.lit(0)).alias("__start"))
    rows = rows.join(F.broadcast(starts), "__file").withColumn("__n", F.col("__start") + F.col("__row") + 1)
    first = rows.groupBy(F.struct(value).alias("__value")).agg(F.min("__n").cast("bigint").alias(name))
    out = rows.withColumn("__value", F.struct(value)).join(first, "__value")
    return out.select(*written.columns, name)
