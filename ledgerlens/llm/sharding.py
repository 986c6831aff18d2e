"""Sharding by a Feistel permutation over global row numbers (DataFrame functions only).

Rows get gapless global numbers 0 to n - 1. A Feistel network over the rectangle
``a * b >= n`` with a, b near the square root of n permutes the numbers; values
from n upwards walk on along their cycle until they fall below n (cycle walking),
which makes it a permutation of 0 to n - 1 again. ``shard = p mod k`` and
``slot = p div k``: counts differ by at most one, slots are gapless, and both
follow from the row number, the seed and n alone.

At most ``a * b - n`` values lie outside, and a walk meets each at most once, so
that many steps always suffice: ``WALK`` steps serve practically all rows and
the proven number of steps serves whatever is left.

Defined results: null texts have size 1 and CRC 0; repeated rows are counted
first and written out again in chunks of ``CHUNK`` that are dealt out evenly (the
chunk numbers themselves in two steps), so a hot row is never one task's work nor
one long array; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.numbering import bucket_of, running

ROUNDS = 6
WALK = 16
CHUNK = 4096


def feistel(x: Column, a: Column, b: Column, seed: int, rounds: int = ROUNDS) -> Column:
    """One pass of the network over 0 to a * b - 1; ``rounds`` must be even.

    A value is (left, right) with left below a and right below b; every round adds
    a keyed hash of one half to the other, modulo that half's size.
    """
    def round_(acc: Column, i: Column) -> Column:
        left, right = acc["l"], acc["r"]
        even = i % 2 == 0
        return F.struct(
            F.when(even, F.pmod(left + F.pmod(F.xxhash64(F.lit(seed), i, right), a), a)).otherwise(left).alias("l"),
            F.when(even, right).otherwise(F.pmod(right + F.pmod(F.xxhash64(F.lit(seed), i, left), b), b)).alias("r"))

    right = F.pmod(x, b)
    start = F.struct(((x - right) / b).cast("long").alias("l"), right.alias("r"))
    steps = F.array(*[F.lit(i) for i in range(rounds)])
    return F.aggregate(steps, start, round_, lambda acc: acc["l"] * b + acc["r"])


def permuted(number: Column, n: Column, a: Column, b: Column, seed: int) -> Column:
    """The permutation of 0 to n - 1 that the network and cycle walking give."""
    def step(x: Column, _: Column) -> Column:
        return F.when(x < n, x).otherwise(feistel(x, a, b, seed))

    first = feistel(number, a, b, seed)
    near = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first, step)
    far = F.aggregate(F.sequence(F.lit(1).cast("long"), a * b - n + 1), near, step)
    return F.when(near < n, near).otherwise(far)


def copied(numbered: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Every row ``copies`` times, ``at`` counting up from its ``first``.

    Rows of more than ``chunk`` copies are cut into ranges of ``chunk`` squared, the
    ranges dealt out, cut into ranges of ``chunk``, and dealt out again.
    """
    def cut(rows: DataFrame, size: int) -> DataFrame:
        begin = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(size).cast("long")))
        others = [c for c in rows.columns if c not in ("first", "copies")]
        return rows.withColumn("begin", begin).select(
            *others, (F.col("first") + F.col("begin")).alias("first"),
            F.least(F.lit(size).cast("long"), F.col("copies") - F.col("begin")).alias("copies"))

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts, F.xxhash64("first"))

    # a number, as AQE would merge the few small ranges into one task
    parts = int(numbered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = numbered.filter(F.col("copies") <= chunk)
    many = dealt(cut(dealt(cut(numbered.filter(F.col("copies") > chunk), chunk * chunk)), chunk))
    return few.unionByName(many).withColumn(
        "at", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1)))


def shard_rows(rows: DataFrame, identity: list[str], *, shards: int, seed: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Every row with ``row_number``, ``shard`` and ``slot`` added.

    ``identity`` lists all columns of ``rows`` that matter (they are what is
    returned); rows equal in them are interchangeable.
    """
    named = rows.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(identity)])
    keys = named.columns
    counted = named.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    counted = counted.withColumn("bucket", bucket_of([F.col(k) for k in keys]))
    numbered = running(counted, keys, F.col("copies"), bucket="bucket", into="first", total="n")
    a = F.ceil(F.sqrt(F.col("n"))).cast("long")
    each = copied(numbered, chunk).select(*keys, "n", a.alias("a"), F.ceil(F.col("n") / a).cast("long").alias("b"), "at")
    p = permuted(F.col("at"), F.col("n"), F.col("a"), F.col("b"), seed)
    return each.withColumn("p", p).select(
        *[F.col(k).alias(c) for k, c in zip(keys, identity)], F.col("at").alias("row_number"),
        F.pmod(F.col("p"), F.lit(shards)).cast("int").alias("shard"),
        ((F.col("p") - F.pmod(F.col("p"), F.lit(shards))) / shards).cast("long").alias("slot"))
