"""SimHash near-dedup with pigeonhole blocks.

A fingerprint's 64 bits are split into ``blocks`` blocks. Fingerprints that
differ in at most ``max_bits`` bits agree on at least ``blocks - max_bits`` whole
blocks, so every choice of that many blocks is a key: close pairs share a key
and are joined on it, then verified by Hamming distance.

Rows with equal fingerprints are one node from the start, so copies make no
pairs. Within a key the members are taken in order of fingerprint in cells of
``CELL``: pairs inside a cell are checked directly. If a key has more members
than one cell, the members beyond are linked by an exact way of linear size: two
members are within three bits if and only if one of them can flip at most one
bit and the other at most two to meet at the same value (other limits: half the
bits, rounded down and up), so each member goes to all those values and each
value with a near member links all its members to that one. Only bits outside
the key's blocks are flipped, and a value has no more members than flips.

Defined results: null, empty and blank texts have fingerprint zero and are
linked like any other; the component is the smallest identifier reachable (nulls
ignored; null if there is none); of rows that repeat identifier and fingerprint
one stays; empty tables give no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.batches import map_slices
from ledgerlens.llm.components import components, cut_lineage, one_row_each

SHINGLE_WORDS = 3
MAX_BITS = 3
BLOCKS = 6
CELL = 64
SEED = 42


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The SimHash of a text as a signed 64-bit number."""
    parts = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not parts:
        return 0
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    else:
        shingles = list(map(b" ".join, zip(*(parts[i:] for i in range(words)))))
    n = len(shingles)
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), dtype=">u8", count=n).view(np.uint8)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 65536):
        part = hashes[8 * at:8 * (at + 65536)].reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """Per row: ``id``, ``h`` (a hash of the text that tells rows of one id apart) and ``fp`` (signed)."""
    def run(piece):
        return {"id": piece.column(0), "h": piece.column(1),
                "fp": pa.array([fingerprint(t, words) for t in piece.column(2).to_pylist()], type=pa.int64())}

    rows = _keyed(df, id_col, text_col)
    return map_slices(rows, run, "id long, h long, fp long")


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))


def block_masks(blocks: int = BLOCKS, max_bits: int = MAX_BITS) -> list[int]:
    """A mask (signed) for each choice of ``blocks - max_bits`` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(block[i] for i in chosen) for chosen in combinations(range(blocks), blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def flips(mask: int, max_bits: int) -> tuple[list[int], int]:
    """XOR patterns (signed) of bits outside ``mask`` up to the larger half of ``max_bits``; how many are within the smaller half."""
    free = [1 << i for i in range(64) if not mask >> i & 1]
    near, far = max_bits // 2, max_bits - max_bits // 2
    patterns = [sum(bits) for n in range(far + 1) for bits in combinations(free, n)]
    within = sum(1 for n in range(near + 1) for _ in combinations(free, n))
    return [x - (1 << 64) if x >> 63 else x for x in patterns], within


def links(nodes: DataFrame, *, max_bits: int = MAX_BITS, blocks: int = BLOCKS, cell: int = CELL) -> DataFrame:
    """Edges (``a``, ``b``) that connect exactly the fingerprints (``fp``) reachable within ``max_bits`` bits.

    Not every close pair of a crowded key is listed, but each stays connected.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3")
    masks = block_masks(blocks, max_bits)
    keyed = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).cast("byte").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("v"))
        for k, m in enumerate(masks)])).alias("key")).select("fp", "key.t", "key.v")
    in_key = Window.partitionBy("t", "v").orderBy("fp")
    placed = keyed.withColumn("at", F.row_number().over(in_key))
    # a key's first cell: each member with those before it, at most cell * (cell - 1) / 2 pairs
    ahead = F.collect_list(F.when(F.col("at") <= cell, F.col("fp"))).over(in_key.rowsBetween(-cell, -1))
    first = placed.filter(F.col("at") <= cell + 1).withColumn("ahead", ahead)
    close = first.filter((F.col("at") > 1) & (F.col("at") <= cell)).select(
        "fp", F.explode("ahead").alias("other")).filter(
        F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits).select(
        F.col("fp").alias("a"), F.col("other").alias("b"))
    crowded = placed.filter(F.col("at") == cell + 1).select("t", "v")  # one row per crowded key
    members = keyed.join(crowded, ["t", "v"], "left_semi")
    return close.unionByName(_meeting(members, masks, max_bits)).distinct()


def _meeting(members: DataFrame, masks: list[int], max_bits: int) -> DataFrame:
    """Edges among members of crowded keys: every member at all values it reaches, linked at near members."""
    def run(batches):
        patterns = [flips(m, max_bits) for m in masks]
        patterns = [(np.array(p, dtype=np.int64), np.arange(len(p)) < n) for p, n in patterns]
        for batch in batches:
            for fp, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values, near = patterns[t]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), fp, dtype=np.int64)), pa.array(values ^ np.int64(fp)),
                     pa.array(near)], names=["fp", "value", "near"])

    met = members.select("fp", "t").mapInArrow(run, "fp long, value long, near boolean").distinct()
    hub = met.filter("near").groupBy("value").agg(F.min("fp").alias("hub"))
    out = met.join(hub, "value").filter("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b"))
    return out.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def near_groups(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: the id, ``fp`` (signed), ``component_id`` and ``kept`` (one row of each component)."""
    rows = cut_lineage(fingerprints(df, id_col=id_col, text_col=text_col, words=words).withColumn(
        "at", F.monotonically_increasing_id()))
    first = F.struct(F.col("id").isNull().alias("unknown"), "id", "h", "at")  # the row that stays has the least
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min(first).alias("first")))
    roots = components(links(nodes.select("fp"), max_bits=max_bits))
    labelled = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    labels = labelled.groupBy("root").agg(F.min("first").alias("stays"))
    label = labelled.select("fp", "root").join(labels, "root").select("fp", "stays")
    return rows.join(label, "fp").select(F.col("id").alias(id_col), "h", "fp", F.col("stays.id").alias("component_id"),
                                         (F.col("at") == F.col("stays.at")).alias("kept"))


def drop_near_copies(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                     words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, the one with the smallest id, all columns unchanged."""
    groups = near_groups(df, id_col=id_col, text_col=text_col, words=words, max_bits=max_bits)
    keep = groups.groupBy(F.col(id_col).alias("id"), F.col("h").alias("key")).agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")).filter("kept").select("id", "key", "rows")
    return one_row_each(df, F.col(id_col).cast("long"), F.xxhash64(F.col(text_col).cast("string")), keep)
