"""Exact top-k inner products with MaxScore.

A term is one component of the vectors; its posting list holds every vector of a
shard. For a query each term's bound is the most it can add: the query's weight
times the shard's largest (or, for negative weights, smallest) value. Terms are
ordered by bound. A first few vectors, scored in full, give a threshold: the k-th
best score so far. The terms whose bounds sum up to less than what a vector still
needs are non-essential: only the essential posting lists are traversed for all
vectors, and a vector is probed in the others, a few at a time, only while its
score so far plus the bounds left can still reach the threshold. Ties with the
threshold are kept, so results are exact. The shards' best are merged by score.

Vectors are split by a hash of their id into shards and queries into blocks;
every shard meets every block as one group of bounded size.

Defined results: rows with a null id, null vector, or null or non-finite
components take no part; of rows that repeat an id the smallest vector counts;
shorter vectors count as padded with zeros; ties go to the smaller id; a query
never finds its own id; empty tables give no rows. Sums beyond 64 bits are an
error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 16384
BLOCK_QUERIES = 2048
PROBE_TERMS = 8
RESULT = "query_id long, vec_id long, score long"


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def usable(vector: Column) -> Column:
    """Not null, and every component finite."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def matrix(rows: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def top_of_shard(ids: np.ndarray, postings: np.ndarray, query_id: int, query: np.ndarray, k: int,
                 high: np.ndarray, low: np.ndarray) -> list[tuple[int, int]]:
    """The k best (score, id) of a shard. ``postings``: one row per term, ids ascending along it."""
    bound = np.maximum(query * high, query * low)  # the most each term adds
    order = np.argsort(-bound, kind="stable")
    left = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0]])  # bounds from each term on
    others = ids != query_id
    seed = np.flatnonzero(others)
    if len(seed) > 4 * k:
        best_terms = order[:2]
        first = query[best_terms] @ postings[best_terms]
        first[~others] = np.iinfo(np.int64).min
        seed = np.argpartition(-first, 4 * k)[:4 * k]
        seed = seed[others[seed]]
    if not len(seed):
        return []
    seeds = query @ postings[:, seed]
    need = np.sort(seeds)[-k] if len(seeds) >= k else np.iinfo(np.int64).min
    # essential: the shortest run of terms beyond which the rest alone cannot reach the threshold
    essential = int(np.argmax(left < need)) if (left < need).any() else len(order)
    essential = min(max(essential, 1), len(order))  # vectors without terms all score 0
    terms = order[:essential]
    score = query[terms] @ postings[terms]
    alive = np.flatnonzero(others & (score + left[essential] >= need))
    score = score[alive]
    for at in range(essential, len(order), PROBE_TERMS):
        terms = order[at:at + PROBE_TERMS]
        score = score + query[terms] @ postings[np.ix_(terms, alive)]
        if len(score) > k:
            # a lower bound of the final scores is not known, so only the threshold prunes
            stay = score + left[min(at + PROBE_TERMS, len(order))] >= need
            alive, score = alive[stay], score[stay]
    best = np.lexsort((ids[alive], -score))[:k]
    return [(int(score[i]), int(ids[alive[i]])) for i in best]


def top_k(vectors: DataFrame, queries: DataFrame, k: int, *, id_col: str = "vec_id", vector_col: str = "vector",
          shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """For each query the ``k`` best vectors: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Both tables have an id and an array of longs.
    """
    def once(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec"))
        return rows.filter("id is not null and vec is not null").groupBy("id").agg(F.min("vec").alias("vec"))

    counts = vectors.agg(F.count(F.lit(1))).first()[0], queries.agg(F.count(F.lit(1))).first()[0]
    shards, blocks = (max(1, math.ceil(n / size)) for n, size in zip(counts, (shard_rows, block_queries)))
    spread = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    side = lambda df, own, n, other, m: df.select(
        "id", "vec", spread(n).alias(own), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))
    left = side(once(vectors), "shard", shards, "block", blocks)
    right = side(once(queries), "block", blocks, "shard", shards)

    def search(vecs: pa.Table, quers: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        out: list[tuple[int, int, int]] = []
        if vecs.num_rows and quers.num_rows:
            ids = vecs["id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            raw, asked = vecs["vec"].to_pylist(), quers["vec"].to_pylist()
            width = max(map(len, raw + asked), default=0)
            data, wanted = matrix(raw, width)[order], matrix(asked, width)
            ids = ids[order]
            top = float(np.abs(data.astype(np.float64)).max(initial=0)) * float(
                np.abs(wanted.astype(np.float64)).max(initial=0)) * max(width, 1)
            if top >= 2 ** 62:
                raise OverflowError("inner products may not fit 64 bits")
            # float64 products are exact below 2**53 and use fast kernels
            kind = np.float64 if top < 2 ** 53 else np.int64
            postings, wanted = np.ascontiguousarray(data.T).astype(kind), wanted.astype(kind)
            high, low = (postings.max(axis=1), postings.min(axis=1)) if width else (np.zeros(0), np.zeros(0))
            for q, query in zip(quers["id"].to_pylist(), wanted):
                out += [(q, i, s) for s, i in top_of_shard(ids, postings, q, query, k, high, low)]
        cols = list(zip(*out)) or [[], [], []]
        return pa.table([pa.array(c, type=pa.int64()) for c in cols], names=names)

    pairs = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(search, RESULT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
