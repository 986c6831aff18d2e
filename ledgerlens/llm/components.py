"""Connected components over an edge table by repeated smallest-neighbour stars; rows picked by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import checkpoint_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """The table written to the session's shared checkpoint folder and read back."""
    checkpoint_dir(df.sparkSession, local_fallback=True)
    return df.checkpoint(eager=True)


def components(edges: DataFrame) -> DataFrame:
    """Per node of ``edges`` (``a``, ``b`` longs): the node and ``root``, the smallest node it can reach.

    Alternates large stars (every node links its larger neighbours to its
    smallest) and small stars (every node links its smaller neighbours and itself
    to its smallest) until the edges are stars around the roots; rounds grow with
    the logarithm of the longest path. Each round is checkpointed. Rows per round
    never exceed the edges, and a hot node is pre-aggregated by ``min``.
    """
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = cut_lineage(links)
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        links = cut_lineage(small.select("e.*").filter("a <> b").distinct())
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def one_row_each(df: DataFrame, row_id: Column, row_key: Column, keep: DataFrame) -> DataFrame:
    """One row of ``df`` per row of ``keep`` (``id``, ``key``, ``rows``: how many rows of ``df`` have both), all columns unchanged.

    Rows alone under their id and key are a semi join. Of repeated ones, the row with
    the least hash of its columns stays: an aggregate that leaves each task with one
    row per key, so a row repeated without end is in no one task's group.
    """
    keep = cut_lineage(keep)
    columns = [F.col(f"`{c}`") for c in df.columns]
    keyed = df.select(*columns, row_id.alias("__id"), row_key.alias("__key"))

    def among(found: DataFrame) -> DataFrame:
        return keyed.join(found, keyed["__id"].eqNullSafe(found["id"]) & (keyed["__key"] == found["key"]), "left_semi")

    single = among(keep.filter("rows = 1")).select(*columns)
    repeated = keep.filter("rows > 1")
    if repeated.isEmpty():
        return single
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    least = among(repeated).groupBy("__id", "__key").agg(F.min_by(F.struct(*columns), F.xxhash64(*hashed)).alias("__row"))
    return single.union(least.select(*[F.col(f"__row.`{c}`") for c in df.columns]))
