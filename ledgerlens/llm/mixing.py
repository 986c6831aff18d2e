"""Mixing sources to target weights by blocks of words, multinomial draws and index permutations.

The words of a source's documents are laid end to end, in an order that follows
from a hash of the documents, and cut into blocks of ``block`` words; only the
last block, the tail, may be shorter. A source's target says how many words the
mix takes from it, so how many slots (uses of a block) it fills: as many whole
rounds over its blocks as fit, then part of one more round, whose last slot takes
only the words that the target still lacks. So a source's taken words are its
target, rounded, and no word is taken more often than its source's rounds.

Output shards hold ``shard_blocks`` slots on average. How many of them each source
fills is a multinomial draw: every source's slots are dealt to the shards with
equal chances, which is the multinomial over sources of each shard given the
totals (first to ranges of shards, then within them, so a hot source is many
tasks' work). Draws are seeded by source and range alone; a task run again draws
the same. A source's slots are numbered along its shards, and a slot's number
within its round is mapped to a block by a pseudorandom permutation of the
source's whole blocks, another one each round; the tail comes last in its round.
Slots and pieces of documents are then joined by (source, block).

Targets: sources in order of code point, null last, weigh ``weights``, repeating;
they share the size of all sources by weight. A target stops at ``most`` times its
source's size, and the excess is shared again by weight until none is above.

Defined results: null texts have size 0, and rows of size 0 take nothing; rows that
repeat id, source and size are counted once and written out again in chunks, each
with its own place; a null source is a source of its own; an empty table or one
without words takes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.components import cut_lineage
from ledgerlens.llm.numbering import BUCKETS, bucket_of
from ledgerlens.llm.sharding import copied, permuted

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK = 512
SHARD_BLOCKS = 1024
SEED = 17
SPACES = r"[\x20\x09-\x0D]"
NOT_SPACES = r"[^\x20\x09-\x0D]+"


def sizes(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: ``id``, ``source`` and ``size``, the number of words of the text."""
    marked = F.regexp_replace(F.regexp_replace(F.col(text_col).cast("string"), NOT_SPACES, "x"), SPACES + "+", "")
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
                     F.coalesce(F.length(marked), F.lit(0)).cast("long").alias("size"))


def in_order(values: DataFrame, col: str) -> DataFrame:
    """Adds ``at``, a row's number from 0 in order of ``col``, nulls last; the values are different.

    Ranges are sorted each on its own, and a row's number adds the rows of the ranges before.
    """
    last = values.select(F.col(col).isNull().alias("none"), col, *[c for c in values.columns if c != col])
    ranged = cut_lineage(last.repartitionByRange(F.col("none"), F.col(col)).withColumn(
        "part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))  # one row per partition
    own = F.row_number().over(Window.partitionBy("part").orderBy("none", col)) - 1
    return ranged.withColumn("own", own).join(F.broadcast(starts), "part").select(
        *values.columns, (F.col("start") + F.col("own")).cast("long").alias("at"))


def targets(sources: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``at``, ``weight`` and ``target`` to one row per source (``source``, ``source_size``).

    Every round shares what the full sources leave over among the others; a round
    is one aggregate of three numbers, and fills at least one more source.
    """
    listed = in_order(sources, "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    listed = cut_lineage(listed.withColumn("weight", weight.cast("long")))
    cap = F.col("source_size") * most
    level, full = None, -1
    while True:
        above = F.lit(False) if level is None else cap <= F.col("weight") * F.lit(level)
        row = listed.agg(F.sum("source_size").alias("total"), F.sum(F.when(above, cap).otherwise(0)).alias("stopped"),
                         F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("open"),
                         F.count_if(above).alias("full")).first()
        if not row["total"] or not row["open"] or row["full"] == full:
            break
        full, level = row["full"], (row["total"] - row["stopped"]) / row["open"]
    share = F.lit(0.0) if level is None else F.col("weight") * F.lit(float(level))
    return listed.withColumn("target", F.least(cap.cast("double"), share))


def layout(rows: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK,
           ) -> tuple[DataFrame, DataFrame]:
    """(documents, sources): every row with the place ``start`` of its words in its source; what each source fills.

    Sources have ``at``, ``source_size``, ``target``, ``take`` (whole words), ``full`` (blocks that are
    whole) and ``blocks``. Rows of a source are spread over buckets, so a hot source is many tasks' work.
    """
    counted = rows.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
    counted = cut_lineage(counted.withColumn("bucket", bucket_of([F.col("id"), F.col("size")])))
    words = F.col("size") * F.col("copies")
    sums = cut_lineage(counted.groupBy("source", "bucket").agg(F.sum(words).alias("words")))
    sources = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    sources = targets(sources, weights=weights, most=most)
    size = F.col("source_size")
    whole = ((size - F.pmod(size, F.lit(block))) / block).cast("long")
    sources = cut_lineage(sources.withColumn("take", F.round("target").cast("long")).withColumn("full", whole).withColumn(
        "blocks", F.col("full") + (F.pmod(size, F.lit(block)) > 0).cast("long")))

    # at most BUCKETS rows a source
    in_source = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("begin", F.coalesce(F.sum("words").over(in_source), F.lit(0))).drop("words")
    starts = _same(starts, sources.select("source", "at", "source_size", "target"), ["source"])
    in_bucket = Window.partitionBy("source", "bucket").orderBy("id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("own", F.coalesce(F.sum(words).over(in_bucket), F.lit(0)))
    placed = _same(placed, starts, ["source", "bucket"])
    first = placed.select("id", "size", "source", "at", "source_size", "target", "copies",
                          (F.col("begin") + F.col("own")).alias("place"), F.lit(0).cast("long").alias("first"))
    each = copied(first.withColumnRenamed("at", "of"))
    docs = each.select("id", "source", "size", "source_size", "target", F.col("of").alias("source_at"),
                       F.col("at").alias("copy"), (F.col("place") + F.col("at") * F.col("size")).alias("start"))
    return docs, sources


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys that may be null."""
    named = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return left.join(named, cond).drop(*[f"__{k}" for k in keys])


def slots(sources: DataFrame, *, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> DataFrame:
    """Every slot: ``shard``, ``source_at``, ``slot`` (its number in the source), ``block`` and ``words`` it takes."""
    size, take = F.col("source_size"), F.col("take")
    rounds = F.when(size > 0, ((take - F.pmod(take, F.greatest(size, F.lit(1)))) / F.greatest(size, F.lit(1)))).otherwise(
        F.lit(0)).cast("long")
    rest = take - rounds * size
    drawn = sources.withColumn("slots", rounds * F.col("blocks") + F.ceil(rest / block).cast("long")).filter("slots > 0")
    drawn = cut_lineage(drawn.select("at", "slots", "take", "source_size", "full", "blocks"))
    total = drawn.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-total // shard_blocks))
    ranges = max(1, int(np.ceil(np.sqrt(shards))))
    width = -(-shards // ranges)

    kept = ["at", "take", "source_size", "full", "blocks"]  # carried along, so that no join meets a hot source

    def deal(batches: Iterator[pa.RecordBatch], of_ranges: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if of_ranges:
                    lows = np.arange(0, shards, width)
                    wide = np.minimum(lows + width, shards) - lows
                    key = [seed, row["at"]]
                else:  # to the shards of one range
                    lows = np.arange(row["low"], min(row["low"] + width, shards))
                    wide = np.ones(len(lows))
                    key = [seed, row["at"], 1 + row["low"]]
                counts = np.random.default_rng(key).multinomial(row["n"], wide / wide.sum())
                firsts = row["first"] + np.cumsum(counts) - counts
                some = counts > 0
                same = [pa.array(np.full(some.sum(), row[c], dtype=np.int64)) for c in kept]
                own = [pa.array(v[some].astype(np.int64)) for v in (lows, firsts, counts)]
                yield pa.RecordBatch.from_arrays(same + own, names=[*kept, "low", "first", "n"])

    schema = ", ".join(f"{c} long" for c in [*kept, "low", "first", "n"])
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    coarse = drawn.select(*kept, F.lit(0).cast("long").alias("first"), F.col("slots").alias("n")).mapInArrow(
        lambda b: deal(b, True), schema)
    fine = coarse.repartition(parts, "at", "low").mapInArrow(lambda b: deal(b, False), schema)
    each = fine.repartition(parts, "at", "low").select(*kept, F.col("low").alias("shard"), F.explode(
        F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot"))
    inner = F.pmod(F.col("slot"), F.col("blocks"))
    turn = ((F.col("slot") - inner) / F.col("blocks")).cast("long")
    n = F.greatest(F.col("full"), F.lit(1))
    a = F.ceil(F.sqrt(n)).cast("long")
    key = F.xxhash64(F.lit(seed), F.col("at"), turn)
    mixed = permuted(F.least(inner, n - 1), n, a, F.ceil(n / a).cast("long"), key)
    at_block = F.when(inner < F.col("full"), mixed).otherwise(inner)
    begun = turn * F.col("source_size") + inner * block  # words taken by the slots before
    length = F.least(F.lit(block), F.col("source_size") - at_block * block)
    return each.select("shard", F.col("at").alias("source_at"), "slot", at_block.alias("block"),
                       F.least(length, F.col("take") - begun).cast("long").alias("words"))


def pieces(docs: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """The part of each document in each block: ``low`` and ``high`` are places in the block."""
    begin = ((F.col("start") - F.pmod(F.col("start"), F.lit(block))) / block).cast("long")
    end = F.col("start") + F.col("size")
    last = ((end - 1 - F.pmod(end - 1, F.lit(block))) / block).cast("long")
    spread = docs.filter("size > 0").withColumn("block", F.explode(F.sequence(begin, last)))
    low = F.greatest(F.col("start") - F.col("block") * block, F.lit(0))
    high = F.least(end - F.col("block") * block, F.lit(block))
    return spread.select("id", "copy", "source_at", "size", "start", "block", low.alias("low"), high.alias("high"))


def mixture(docs: DataFrame, sources: DataFrame, *, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS,
            seed: int = SEED) -> DataFrame:
    """The mix: per use of a document's part, ``shard``, ``source_at``, ``slot``, ``id``, ``from_word`` and ``n_words``.

    A block has at most ``block`` documents and as many slots as its source has rounds.
    """
    used = slots(sources, block=block, shard_blocks=shard_blocks, seed=seed)
    parts = pieces(docs, block=block)
    out = parts.join(used, ["source_at", "block"])
    n = F.least(F.col("high"), F.col("words")) - F.col("low")
    return out.filter(n > 0).select(
        "shard", "source_at", "slot", "id", "copy", "start",
        (F.col("block") * block + F.col("low") - F.col("start")).alias("from_word"), n.alias("n_words"))


def taken(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS,
          seed: int = SEED) -> DataFrame:
    """Per row: the id, ``size``, ``source_size``, ``target`` (its source's) and ``taken`` words."""
    rows = sizes(df, id_col=id_col, text_col=text_col, source_col=source_col)
    docs, sources = layout(rows, weights=weights, most=most, block=block)
    mix = mixture(docs, sources, block=block, shard_blocks=shard_blocks, seed=seed)
    # rows with words have places of their own in their source
    sums = mix.groupBy("source_at", "start").agg(F.sum("n_words").alias("taken"))
    some = docs.filter("size > 0").join(sums, ["source_at", "start"], "left")
    out = some.select("id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")).unionByName(
        docs.filter("size = 0").select("id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken")))
    return out.withColumnRenamed("id", id_col)
