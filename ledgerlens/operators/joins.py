"""Joins used by the checks.

No join of tables is hinted: the planner and AQE broadcast a side only when its
measured bytes are below the session's threshold, and split hot keys of a sort-merge
join. Only the key filter of :func:`semi_join_back`, bounded by construction, is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.labels import invert_groups, label_lookup


FILTER_BUCKETS = 1 << 20


def semi_join_back(detail: DataFrame, keys: DataFrame, on: str | Sequence[str], *,
                   buckets: int = FILTER_BUCKETS) -> DataFrame:
    """Detail rows whose key is among ``keys`` (``EXISTS``); never multiplies rows.

    The detail's scan is pruned before its shuffle by a filter of bounded size: the
    hash buckets that hold a key, at most ``buckets`` numbers whatever the input, so they
    can be broadcast. The exact semi join follows. The keys are made distinct before
    they are shuffled to it, so a hot key's rows do not land in one task on the side
    that AQE cannot split.
    """
    on = [on] if isinstance(on, str) else list(on)
    if buckets < 1 or buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    # a NULL key joins nothing; said here, both readers of the keys have the same plan, which is run once
    for k in on:
        keys = keys.filter(F.col(k).isNotNull())
    wanted = keys.select(*on).distinct()
    bucket = F.xxhash64(*on).bitwiseAND(F.lit(buckets - 1))
    held = wanted.select(bucket.alias("__bucket")).distinct()
    near = detail.withColumn("__bucket", bucket).join(F.broadcast(held), "__bucket", "left_semi").drop("__bucket")
    return near.join(wanted, on=on, how="left_semi")


def group_lookup(df: DataFrame, code_col: str, dim, *, default: str, name: str = "grupo",
                 dim_code_col: str = "cod_estabelecimento", dim_value_col: str = "grupo") -> DataFrame:
    """Attach a label per code, ``default`` when the code is not listed.

    ``dim`` may be a ``{group: codes}`` dict (compiled into ``CASE WHEN code IN
    (...)``: no join, no shuffle) or a DataFrame of (code, group). A DataFrame is
    de-duplicated per code (first group alphabetically) and joined as the planner chooses.
    """
    if isinstance(dim, dict):
        return df.withColumn(name, label_lookup(code_col, invert_groups(dim), default))
    d = (dim.groupBy(F.col(dim_code_col).alias("__code"))
            .agg(F.min(dim_value_col).alias("__label")))
    out = df.join(d, F.col(code_col) == F.col("__code"), "left")
    return out.withColumn(name, F.coalesce(F.col("__label"), F.lit(default))).drop("__code", "__label")
