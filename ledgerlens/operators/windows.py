"""Count-over-partition filters, written skew-proof on one exchange of the rows.

``COUNT(x) OVER (PARTITION BY k)`` as a window function sends every row of a key
to one task, and AQE cannot split a window partition. Here rows are exchanged once,
by (key, salt); the salt is a hash of the row, so a hot key is many tasks' rows.
Each task counts its (key, salt) groups in place. A window over these partial
counts, at most ``SALTS`` rows a key, gives the key's total, which is joined back
by (key, salt) to the same exchange: the rows are read and moved once, only partial
counts move again. The key is a struct, so a NULL key is a key like any other, as
in a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def _keys(partition) -> list[str]:
    return [partition] if isinstance(partition, str) else list(partition)


def _count_join_back(df: DataFrame, keys: list[str], count_expr, name: str, more_than, salts: int) -> DataFrame:
    if salts < 1 or salts & (salts - 1):
        raise ValueError("salts must be a power of two")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    salt = F.xxhash64("__row").bitwiseAND(F.lit(salts - 1))  # never NULL, so no reader gets a filter of its own
    # Both readers of the exchange need the whole row (the salt is a hash of it), so it is made once.
    spread = df.select(F.struct(*[F.col(f"`{k}`") for k in keys]).alias("__key"), row.alias("__row")).repartition(
        F.col("__key"), salt)
    spread = spread.withColumn("__salt", salt)
    partial = spread.groupBy("__key", "__salt").agg(count_expr("__row").alias("__n"))
    total = F.sum("__n").over(Window.partitionBy("__key"))
    totals = partial.withColumn(name, total).drop("__n")
    if more_than is not None:
        totals = totals.filter(F.col(name) > more_than)
    out = spread.join(totals, ["__key", "__salt"])
    return out.select(*[F.col(f"__row.`{c}`").alias(c) for c in df.columns], name)


def count_over(df: DataFrame, partition: str | Sequence[str], col: str, *, more_than=None,
               name: str = "qtd", salts: int = SALTS) -> DataFrame:
    """Rows with ``COUNT(col) OVER (PARTITION BY partition)`` attached (NULL ``col`` not counted),
    keeping only rows whose count is greater than ``more_than`` when given."""
    return _count_join_back(df, _keys(partition), lambda row: F.count(F.col(f"{row}.`{col}`")), name, more_than, salts)


def count_rows_over(df: DataFrame, partition: str | Sequence[str], *, more_than=None,
                    name: str = "qtd", salts: int = SALTS) -> DataFrame:
    """Rows with ``COUNT(*) OVER (PARTITION BY partition)`` attached, optionally filtered ``> more_than``.
    A NULL partition key forms its own group, as in a window."""
    return _count_join_back(df, _keys(partition), lambda row: F.count(F.lit(1)), name, more_than, salts)
