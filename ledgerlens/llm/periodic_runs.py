"""Runs (maximal periodic stretches of words) by uniting suffix classes in order of decreasing LCP.

Two places of a text belong to one class at level L if the words from there on
agree for at least L words. Suffixes are sorted by doubling (numpy, many texts at
once; places whose window is unique leave the sort), LCPs of neighbours follow
from the doubled ranks, and Kruskal's order unites the classes of neighbours from
the highest LCP down: union-find over ordered sets of places, the smaller set put
into the larger. Places i < j that become neighbours in their set at level L agree
for exactly L words; if their distance d is within L, the words from i to j + L
have period d. It is the smallest one, as a smaller period q would put i + q
between them. If in addition the word before i differs from the word before j, the
stretch starts there and is a run; every run is seeded so once, by its first place
and the place one period on.

Only runs of at least ``MIN_LENGTH`` words and ``MIN_PERIODS`` periods are wanted.
Their seeds agree for at least ``MIN_LENGTH * (MIN_PERIODS - 1) / MIN_PERIODS``
words, so classes of lower LCP are never united, and a text without two such equal
windows costs its share of the first sorts only.

Memory grows with one batch of ``BATCH_WORDS`` words, or with the longest text (about
4 bytes a word and doubling).

Defined results: null and empty texts have no words and no runs; texts are read
whole; rows that repeat are results of their own; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import claim

MIN_LENGTH = 24
MIN_PERIODS = 3
BATCH_WORDS = 200_000
CHUNK = 512

Run = tuple[int, int, int]  # start, length, period


class Places:
    """An ordered set of places in chunks, so that an insertion moves a bounded number of them."""

    __slots__ = ("chunks", "lasts", "size")

    def __init__(self, first: int):
        self.chunks, self.lasts, self.size = [[first]], [first], 1

    def add(self, place: int) -> tuple[int, int]:
        """Puts a place in; its neighbours (-1: none)."""
        chunks, lasts = self.chunks, self.lasts
        c = bisect_left(lasts, place)
        if c == len(lasts):
            c -= 1
            lasts[c] = place
        chunk = chunks[c]
        k = bisect_left(chunk, place)
        chunk.insert(k, place)
        self.size += 1
        before = chunk[k - 1] if k else chunks[c - 1][-1] if c else -1
        after = chunk[k + 1] if k + 1 < len(chunk) else chunks[c + 1][0] if c + 1 < len(chunks) else -1
        if len(chunk) > 2 * CHUNK:
            chunks[c:c + 1] = [chunk[:CHUNK], chunk[CHUNK:]]
            lasts[c:c + 1] = [chunk[CHUNK - 1], chunk[-1]]
        return before, after

    def __iter__(self) -> Iterator[int]:
        for chunk in self.chunks:
            yield from chunk


def ranks(words: np.ndarray, texts: np.ndarray, seed: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks of the windows of 1, 2, 4, ... words at every place, until all are unique; places still shared at ``seed`` words.

    A rank is the number of windows that sort before. Windows of different texts
    always differ: each text ends with a word of its own (the caller's).
    """
    n = len(words)
    key = texts * (int(words.max(initial=0)) + 1) + words
    live, out, h, shared = np.arange(n), [], 0, np.empty(0, dtype=np.int64)
    rank = np.zeros(n, dtype=np.int64)
    while True:
        if h:
            key = rank[live] * n + rank[live + h]
        order = np.argsort(key, kind="stable")
        at, key = live[order], key[order]
        new = np.r_[True, key[1:] != key[:-1]]
        old = np.r_[True, rank[at[1:]] != rank[at[:-1]]]
        place = np.arange(len(at))
        sub = np.maximum.accumulate(np.where(new, place, 0))
        group = np.maximum.accumulate(np.where(old, place, 0))
        rank = rank.copy()
        rank[at] += sub - group
        out.append(rank.astype(np.int32) if n < 1 << 31 else rank)
        alone = new & np.r_[new[1:], True]
        live = at[~alone]
        h = h * 2 or 1
        if h <= seed:
            shared = live
        if not len(live):
            return out, shared


def seeded(words: np.ndarray, texts: np.ndarray, min_length: int, min_periods: int) -> dict[int, list[Run]]:
    """Per text that has any, its runs, with starts counted over all words."""
    least = -(-min_length * (min_periods - 1) // min_periods)  # words on which a seed's places agree
    levels, shared = ranks(words, texts, least)
    if not len(shared):
        return {}
    order = shared[np.argsort(levels[-1][shared], kind="stable")]
    a, b = order[:-1], order[1:]
    lcp = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][np.minimum(a + lcp, len(words) - 1)] == levels[k][np.minimum(b + lcp, len(words) - 1)]
        lcp[same] += 1 << k
    edges = np.flatnonzero(lcp >= least)  # equal windows lie in one text
    edges = edges[np.lexsort((-lcp[edges], texts[a[edges]]))]
    out: dict[int, list[Run]] = {}
    owner = texts[a[edges]]
    cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(edges) else []
    for low, high in zip(cuts, [*cuts[1:], len(edges)]):
        some = edges[low:high]
        found = unite(a[some].tolist(), b[some].tolist(), lcp[some].tolist(), words, min_length, min_periods,
                      texts)
        if found:
            out[int(owner[low])] = found
    return out


def unite(first: list[int], second: list[int], lcp: list[int], words: np.ndarray, min_length: int, min_periods: int,
          texts: np.ndarray) -> list[Run]:
    """The runs of one text, from neighbouring suffixes in order of decreasing LCP."""
    parent: dict[int, int] = {}
    sets: dict[int, Places] = {}
    following: dict[int, int] = {}
    runs: list[Run] = []

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    at, end = 0, len(lcp)
    while at < end:
        level, met = lcp[at], []
        while at < end and lcp[at] == level:
            x, y = root(first[at]), root(second[at])
            at += 1
            one, other = sets.pop(x, None) or Places(x), sets.pop(y, None) or Places(y)
            if one.size < other.size:
                x, y, one, other = y, x, other, one
            parent[y] = x
            sets[x] = one
            last = -1
            for place in other:
                before, after = one.add(place)
                if before >= 0:
                    following[before] = place
                    if before != last and (place - before) * (min_periods - 1) <= level:
                        met.append((before, place))
                if after >= 0:
                    following[place] = after
                    if (after - place) * (min_periods - 1) <= level:
                        met.append((place, after))
                else:
                    following.pop(place, None)
                last = place
        for i, j in met:
            d = j - i
            if level + d < min_length or following.get(i) != j:
                continue  # too short, or a place between them came in on this level
            if i == 0 or texts[i - 1] != texts[i] or words[i - 1] != words[j - 1]:
                runs.append((i, level + d, d))
    return runs


def find_runs(texts: list[list[bytes]], *, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[list[Run]]:
    """Each text's runs (start, length, period) in order of start, then period; texts are lists of words."""
    every = [w for words in texts for w in words]
    kinds = {w: i for i, w in enumerate(dict.fromkeys(every))}
    numbers = np.fromiter(map(kinds.__getitem__, every), dtype=np.int64, count=len(every))
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(lengths + 1)
    starts = ends - lengths - 1
    words = np.full(int(ends[-1]) if len(ends) else 0, len(kinds), dtype=np.int64)  # a text's last word is no word
    inside = np.ones(len(words), dtype=bool)
    inside[ends - 1] = False
    words[inside] = numbers
    owner = np.repeat(np.arange(len(texts)), lengths + 1)
    found = seeded(words, owner, min_length, min_periods) if len(words) else {}
    out = []
    for t, start in enumerate(starts.tolist()):
        out.append(sorted(((i - start, n, p) for i, n, p in found.get(t, ())), key=lambda r: (r[0], r[2])))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def greatest(runs: list[Run]) -> Run | None:
    """The run of greatest length / period, of equals the first start, then the smallest period."""
    best = None
    for run in runs:  # in order of start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


SCHEMA = ("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string")


def _digest(words: list[bytes], runs: list[Run]) -> tuple:
    best = greatest(runs)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest())


def _full(words: list[bytes], runs: list[Run]) -> tuple:
    return ([{"start": s, "length": n, "period": p} for s, n, p in runs],
            b" ".join(collapsed(words, runs)).decode("utf-8", "replace"))


def _by_text(df: DataFrame, id_col: str, text_col: str, prepare, result: Callable, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("periodic_runs")

        def flush(ids, texts):
            rows = [result(w, r) for w, r in zip(texts, find_runs(texts))]
            cols = [pa.array(ids, type=pa.int64())]
            cols += [pa.array(list(c), type=t) for c, t in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(cols, names=["id", *names])

        ids, texts, held = [], [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                doc, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                words = (text or "").encode("utf-8", "replace").split()
                words = prepare(doc, words) if prepare else words
                if held and held + len(words) > BATCH_WORDS:
                    yield flush(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(doc)
                texts.append(words)
                held += len(words) + 1
        if ids:
            yield flush(ids, texts)

    from pyspark.sql.pandas.types import to_arrow_schema

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    fields = list(to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema))
    names, kinds = [f.name for f in fields], [f.type for f in fields]
    return rows.mapInArrow(run, f"id long, {schema}").withColumnRenamed("id", id_col)


def collapse(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Per row: the id, ``runs`` (start, length, period) and ``collapsed``, the text without repeated periods."""
    return _by_text(df, id_col, text_col, prepare, _full,
                    "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def run_digests(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Per row: the id, ``n_runs``, the greatest run, and digests of all runs and of the collapsed text.

    ``prepare`` may change a text's words before (given the id and the words).
    """
    return _by_text(df, id_col, text_col, prepare, _digest, SCHEMA)
