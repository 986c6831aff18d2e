"""Phrase collocations by weighted acyclic automata.

Every word of a text gives one record: the words from there on, up to the depth or
the end of its piece. The count of a phrase is the number of records that start with
it, so counts are weights of prefixes.

* Each task takes its texts in shards of ``SHARD_WORDS`` words, sorts a shard's
  records and builds a count transducer from them in order: a state is closed when
  the next record leaves it, and a closed state with the arcs and weights of an
  earlier one is that one. An arc's weight is the number of records through it.
* A transducer is cut by prefix range (quantiles of a sample of the records; they
  bound the groups and have no part in the result) and sent to its range's group. There all
  are united level by level: arcs with equal prefixes are one, their weights are
  summed, and prefixes below the least count are left. Only a prefix of a range's
  border can lie in two ranges; these leave with part sums, which are added.
* First phrases of one and two words are counted, then longer ones along chains of
  frequent pairs (what holds a rare pair is rare). Tasks know the pairs by a bit
  filter of bounded size; what it lets through in error is counted and found rare.
* Parts of candidates are looked up by composing the transducer of the requested
  parts with that of the counts, group by group of a hash of the part.

Memory: a shard in a task; a range of about ``RANGE_WORDS`` words in a group (beyond
``MAX_RANGES`` ranges, 8e9 words, ranges grow with the input); at most
``FILTER_BITS`` bits of filter and ``SAMPLE_DOCS`` x ``SAMPLE_EACH`` records on the driver.

Defined results: a null language is ``und``; null and empty texts hold no words;
rows that repeat count again; empty tables give no rows. Products are exact
(decimals of 38 digits).
"""

from __future__ import annotations

import math
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.batches import claim
from ledgerlens.llm.components import cut_lineage

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
SHARD_WORDS = 300_000
RANGE_WORDS = 1_000_000
MAX_RANGES = 1 << 13
SAMPLE_DOCS = 2000
SAMPLE_EACH = 32
FILTER_BITS = 1 << 29
FILTER_HASHES = 4
LOOKUP_ROWS = 100_000
UNKNOWN = "und"
STOP = b"."
# Piece marks become full stops, which no word holds; A-Z become a-z.
BORDERS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b".......... abcdefghijklmnopqrstuvwxyz")

Gram = tuple[bytes, ...]


def words_and_stops(text: str | None) -> list[bytes]:
    """The words of a text in order, with a stop (``.``) at every border of pieces."""
    return (text or "").encode("utf-8", "replace").translate(BORDERS).replace(b".", b" . ").split()


class Transducer:
    """States with arcs (word, weight, next state); the last state is the root. ``total`` is the root's own weight."""

    def __init__(self, words: list[bytes], first: np.ndarray, arcs: np.ndarray, total: int):
        self.words, self.first, self.arcs, self.total = words, first, arcs, total

    def to_bytes(self) -> bytes:
        """Lengths of words, arcs in columns (words as steps) and words, compressed."""
        lengths = np.fromiter(map(len, self.words), dtype=np.int32, count=len(self.words))
        wide = np.int32 if max(self.arcs.max(initial=0), len(self.words)) < 1 << 31 else np.int64
        cols = [np.diff(self.arcs[:, 0], prepend=0), self.arcs[:, 1], self.arcs[:, 2]]
        head = [len(self.words), len(self.first), len(self.arcs), self.total, int(wide is np.int64)]
        raw = b"".join([np.array(head, dtype=np.int64).tobytes(), lengths.tobytes(),
                        np.diff(self.first).astype(np.int32).tobytes(), *[c.astype(wide).tobytes() for c in cols], *self.words])
        return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)

    @classmethod
    def from_bytes(cls, packed: bytes) -> Transducer:
        raw = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)
        n_words, n_first, n_arcs, total, long = np.frombuffer(raw, dtype=np.int64, count=5).tolist()
        at, wide = 40, np.int64 if long else np.int32
        lengths = np.frombuffer(raw, dtype=np.int32, count=n_words, offset=at)
        at += 4 * n_words
        fan = np.frombuffer(raw, dtype=np.int32, count=n_first - 1, offset=at)
        at += 4 * (n_first - 1)
        cols = np.frombuffer(raw, dtype=wide, count=3 * n_arcs, offset=at).reshape(3, -1).copy()
        cols[0] = np.cumsum(cols[0])
        ends = np.cumsum(lengths, dtype=np.int64) + at + 3 * n_arcs * wide().itemsize
        return cls([raw[b - n:b] for b, n in zip(ends.tolist(), lengths.tolist())],
                   np.r_[0, np.cumsum(fan, dtype=np.int64)], cols.T, total)


def padded(grams: list[tuple[int, ...]]) -> np.ndarray:
    """Grams of word numbers as rows of one length, -1 past a gram's end."""
    out = np.full((len(grams), max(map(len, grams), default=1)), -1, dtype=np.int64)
    for i, g in enumerate(grams):
        out[i, :len(g)] = g
    return out


def build(grams: np.ndarray, weights: np.ndarray, words: list[bytes], *, rolled: bool = True) -> Transducer:
    """The transducer of sorted, different grams of word numbers (rows, -1 past the end).

    Grams with equal words but for the last close their state at once; the states before are closed when the next
    such stem leaves them. ``rolled``: an arc weighs the grams through it; else only the gram that ends with it.
    """
    depth = grams.shape[1]
    stems, last = grams[:, :-1], grams[:, -1]
    starts = np.flatnonzero(np.r_[True, (stems[1:] != stems[:-1]).any(axis=1)]) if len(grams) else np.empty(0, dtype=np.int64)
    ends = np.r_[starts[1:], len(grams)].astype(np.int64)
    whole = last[starts] < 0  # the stem is a gram itself; it sorts first
    own = np.where(whole, weights[starts], 0)
    through = np.add.reduceat(weights, starts) if rolled and len(starts) else own
    leaves = np.stack([last, weights, np.zeros_like(last)], axis=1).astype(np.int64).tobytes()
    known: dict[bytes, int] = {b"": 0}
    closed: list[bytes] = [b""]
    arcs: list[list[int]] = [[]]
    total = [0]
    given: list[int] = [0]  # the state after the path, where its last arcs are closed
    path: tuple[int, ...] = ()

    def register(raw: bytes) -> int:
        state = known.get(raw)
        if state is None:
            state = known[raw] = len(closed)
            closed.append(raw)
        return state

    def close(keep: int) -> None:
        for k in range(len(path), keep, -1):
            inner, weight = arcs.pop(), total.pop()
            state = register(array("q", inner).tobytes()) if k < depth - 1 else given[0]
            arcs[-1] += (path[k - 1], weight, state)
            if rolled:
                total[-1] += weight

    first_leaf = starts + whole
    for row, low, high, weight in zip(stems[starts].tolist(), first_leaf.tolist(), ends.tolist(), through.tolist()):
        size = len(row)
        while size and row[size - 1] < 0:
            size -= 1
        stem = tuple(row[:size])
        same = 0
        for x, y in zip(path, stem):
            if x != y:
                break
            same += 1
        close(same)
        for _ in range(size - same):
            arcs.append([])
            total.append(0)
        path = stem
        total[-1] += weight
        if size == depth - 1:
            given[0] = register(leaves[24 * low:24 * high])
    close(0)
    root = leaves[24 * int(first_leaf[0]):] if depth == 1 and len(starts) else array("q", arcs[0]).tobytes()
    closed.append(root)
    sizes = np.fromiter(map(len, closed), dtype=np.int64, count=len(closed)) // 24
    flat = np.frombuffer(b"".join(closed), dtype=np.int64).reshape(-1, 3).copy()
    used, flat_words = np.unique(flat[:, 0], return_inverse=True)
    flat[:, 0] = flat_words.reshape(-1)
    return Transducer([words[w] for w in used.tolist()], np.r_[0, np.cumsum(sizes)], flat, total[0])


def compose(requests: list[Gram], counts: Transducer) -> list[int]:
    """The weight that ``counts`` gives each of the sorted requests (0: not in it), walking both in step."""
    number = {w: i for i, w in enumerate(counts.words)}
    first, arcs = counts.first.tolist(), counts.arcs.tolist()
    root = len(first) - 2
    states: list[tuple[int, int]] = [(root, 0)]  # along the path of the last request: state, weight of the arc into it
    path: list[bytes] = []
    out = []
    for gram in requests:
        same = 0
        while same < min(len(path), len(gram)) and path[same] == gram[same]:
            same += 1
        del states[same + 1:], path[same:]
        for word in gram[same:]:
            state, w = states[-1][0], number.get(word, -1)
            low, high = (first[state], first[state + 1]) if state >= 0 else (0, 0)
            k = bisect_left(arcs, w, low, high, key=lambda a: a[0]) if w >= 0 else high
            found = k < high and arcs[k][0] == w
            states.append((arcs[k][2], arcs[k][1]) if found else (-1, 0))
            path.append(word)
        out.append(states[-1][1])
    return out


class PairFilter:
    """A bit filter of pairs; it may let others through, never holds one of its own back."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(keys: list[bytes], size: int) -> np.ndarray:
        """One row of places per key; ``size`` is a power of two."""
        h = np.fromiter(map(xxhash.xxh64_intdigest, keys), dtype=np.uint64, count=len(keys))[:, None]
        step = np.arange(FILTER_HASHES, dtype=np.uint64)
        return (h + step * ((h >> np.uint64(32)) | np.uint64(1))) & np.uint64(size - 1)

    def has(self, keys: list[bytes]) -> np.ndarray:
        at = self.places(keys, 8 * len(self.bits))
        return ((self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def pair_key(lang: bytes, first: bytes, second: bytes) -> bytes:
    return b" ".join((lang, first, second))


def pair_filter(pairs: DataFrame) -> PairFilter:
    """The filter of frequent pairs (``lang``, ``phrase``), about 16 bits each; at most ``FILTER_BITS`` reach the driver."""
    size = 1 << min(int(math.log2(FILTER_BITS)), max(10, (16 * pairs.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [f"{a} {b}".encode() for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            if keys:
                at = PairFilter.places(keys, size).reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((at >> np.uint64(5)).astype(np.int64)),
                     pa.array(np.int64(1) << (at & np.uint64(31)).astype(np.int64))], names=["at", "bit"])

    set_bits = pairs.select("lang", "phrase").mapInArrow(run, "at long, bit long").groupBy("at").agg(
        F.bit_or("bit").alias("bits"))
    words = np.zeros(size // 32, dtype="<u4")
    for at, bits in set_bits.collect():  # at most size / 32 rows
        words[at] = bits
    return PairFilter(words.view(np.uint8))


def records(lang: bytes, listed: list[bytes], depth: int, pairs: PairFilter | None
            ) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """A shard's words in order, its different records in order (rows, -1 past the end), and how often each occurs.

    With ``pairs`` records follow chains of pairs in the filter, and hold three words or more.
    """
    words = sorted(set(listed) - {STOP})
    number = {w: i for i, w in enumerate(words)} | {STOP: -1}
    x = np.full(len(listed) + depth, -1, dtype=np.int64)
    x[:len(listed)] = np.fromiter(map(number.__getitem__, listed), dtype=np.int64, count=len(listed))
    linked = (x[:-1] >= 0) & (x[1:] >= 0)
    if pairs is not None:
        at = np.flatnonzero(linked)
        kinds, back = np.unique(x[at] * len(words) + x[at + 1], return_inverse=True)
        keys = [pair_key(lang, words[k // len(words)], words[k % len(words)]) for k in kinds.tolist()]
        good = pairs.has(keys) if keys else np.zeros(0, dtype=bool)
        linked[at] = good[back.reshape(-1)]
    n = len(listed)
    cols, chain = [x[:n]], np.ones(n, dtype=bool)
    for k in range(1, depth):
        chain = chain & linked[k - 1:k - 1 + n]
        cols.append(np.where(chain, x[k:k + n], -1))
    keep = cols[2] >= 0 if pairs is not None else cols[0] >= 0
    cols = [c[keep] + 1 for c in cols]  # 0: past the end
    if not len(cols[0]):
        return words, np.empty((0, depth), dtype=np.int64), np.empty(0, dtype=np.int64)
    low, high, base = np.zeros_like(cols[0]), np.zeros_like(cols[0]), len(words) + 1
    for c in cols[:3]:  # three words fit one key (shards have fewer than two million words)
        high = high * base + c
    for c in cols[3:]:
        low = low * base + c
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    new = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
    counts = np.diff(np.r_[new, len(high)])
    return words, np.stack([c[order][new] - 1 for c in cols], axis=1), counts


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(language, words and stops) of at most ``SHARD_WORDS`` words (a longer text is cut within, with an overlap)."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            listed = words_and_stops(text)
            held.setdefault(lang, []).extend(listed)
            held[lang].append(STOP)
            size += len(listed) + 1
            if size >= SHARD_WORDS:
                yield from held.items()
                held, size = {}, 0
    yield from held.items()


def borders(rows: DataFrame, depth: int) -> list[tuple[bytes, Gram]]:
    """Range borders (language, record): quantiles of the records of a sample of rows."""
    total = rows.count()
    some = rows.sample(min(1.0, SAMPLE_DOCS / max(total, 1)), seed=1).limit(2 * SAMPLE_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                listed = words_and_stops(text)
                step = len(listed) // SAMPLE_EACH + 1
                for at in range(len(listed) % step, len(listed), step):
                    gram = listed[at:at + depth]
                    gram = gram[:gram.index(STOP)] if STOP in gram else gram
                    if gram:
                        out.append((lang, gram, step))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.string()), pa.array([STOP.join(o[1]) for o in out], pa.binary()),
                 pa.array([o[2] for o in out], pa.int64())], names=["lang", "gram", "of"])

    found = some.mapInArrow(run, "lang string, gram binary, of long").toArrow()  # bounded by the sample
    if not found.num_rows:
        return []
    keys = sorted((lang.encode(), tuple(gram.split(STOP)), of) for lang, gram, of in zip(*[
        c.to_pylist() for c in found.columns]))
    sampled = sum(k[2] for k in keys)
    words = sampled * max(1.0, total / (2 * SAMPLE_DOCS) if total > 2 * SAMPLE_DOCS else 1.0)
    ranges = int(min(MAX_RANGES, max(1, words // RANGE_WORDS)))
    out, seen, step = [], 0, sampled / ranges
    for lang, gram, of in keys:
        seen += of
        if seen >= step * (len(out) + 1) and len(out) < ranges - 1 and (not out or out[-1] < (lang, gram)):
            out.append((lang, gram))
    return out


def count_prefixes(rows: DataFrame, cuts: list[tuple[bytes, Gram]], *, depth: int, least: int, shortest: int,
                   pairs: PairFilter | None = None) -> DataFrame:
    """Phrases (``lang``, ``phrase``, ``size``, ``f``) of ``shortest`` to ``depth`` words that occur ``least`` times or more.

    ``rows`` has ``lang`` and ``text``. With ``shortest`` 0 the empty phrase counts all words.
    """
    context = rows.sparkSession.sparkContext
    shared_cuts, shared_pairs = context.broadcast(cuts), context.broadcast(pairs)  # bounded, see the module

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("collocations")
        limits = shared_cuts.value
        for lang, listed in _shards(batches):
            key = lang.encode()
            words, grams, counts = records(key, listed, depth, shared_pairs.value)
            low, out = 0, []
            first = bisect_left(limits, (key, ()))

            def named(i: int) -> Gram:
                return tuple([words[w] for w in grams[i].tolist() if w >= 0])

            for r in range(first, len(limits) + 1):
                inside = r < len(limits) and limits[r][0] == key
                high = bisect_left(range(len(grams)), limits[r][1], low, key=named) if inside else len(grams)
                if high > low:
                    out.append((lang, r, build(grams[low:high], counts[low:high], words).to_bytes()))
                low = high
                if not inside:
                    break
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out]), pa.array([o[1] for o in out], pa.int32()),
                     pa.array([o[2] for o in out], pa.binary())], names=["lang", "range", "transducer"])

    def unite(table: pa.Table) -> pa.Table:
        lang, r = table.column(0)[0].as_py(), table.column(1)[0].as_py()
        limits = shared_cuts.value
        own = [limits[k][1] for k in (r - 1, r) if 0 <= k < len(limits) and limits[k][0] == lang.encode()]
        found = union((Transducer.from_bytes(raw.as_py()) for raw in table.column(2)), own, least, shortest)
        return pa.table([pa.array([lang] * len(found), pa.string()), pa.array([p.decode() for p, _, _ in found], pa.string()),
                         pa.array([k for _, k, _ in found], pa.int32()), pa.array([f for _, _, f in found], pa.int64())],
                        names=["lang", "phrase", "size", "f"])

    parts = rows.mapInArrow(shards, "lang string, range int, transducer binary")
    sums = parts.groupBy("lang", "range").applyInArrow(unite, "lang string, phrase string, size int, f long")
    return sums.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).filter((F.col("f") >= least) | (F.col("size") == 0))


def union(transducers: Iterable[Transducer], limits: list[Gram], least: int, shortest: int) -> list[tuple[bytes, int, int]]:
    """(phrase, words, weight) of the prefixes that weigh ``least``, and of all prefixes of ``limits`` with what they weigh here.

    All transducers are walked together, a level at a time; a prefix that weighs less is left with all that follows it.
    """
    number: dict[bytes, int] = {}
    firsts, arcs, roots, total, states, edges = [], [], [], 0, 0, 0
    for t in transducers:
        named = np.fromiter((number.setdefault(w, len(number)) for w in t.words), dtype=np.int64, count=len(t.words))
        own = np.empty(t.arcs.shape, dtype=np.int32)  # a range holds far fewer than 2 ** 31 states, a shard's weights are less
        own[:, 0] = named[t.arcs[:, 0]]
        own[:, 1] = t.arcs[:, 1]
        own[:, 2] = t.arcs[:, 2] + states
        firsts.append(t.first[:-1].astype(np.int64) + edges)
        arcs.append(own)
        states += len(t.first) - 1
        edges += len(own)
        roots.append(states - 1)
        total += t.total
    words = list(number)
    first = np.concatenate([*firsts, [edges]])
    arc = np.concatenate(arcs)
    out = [(b"", 0, total)] if shortest == 0 else []
    state, prefix = np.array(roots, dtype=np.int64), np.zeros(len(roots), dtype=np.int64)
    phrases: list[bytes] = [b""]
    on_limit = [0 for _ in limits]  # the prefix of each limit, -1 when it is left
    size = 0
    while len(state):
        size += 1
        fan = first[state + 1] - first[state]
        begin = np.repeat(first[state] - np.cumsum(fan) + fan, fan) + np.arange(fan.sum())
        key = np.repeat(prefix, fan) * len(words) + arc[begin, 0]
        if not len(key):
            break
        kinds, back = np.unique(key, return_inverse=True)
        back = back.reshape(-1)
        weight = np.zeros(len(kinds), dtype=np.int64)
        np.add.at(weight, back, arc[begin, 1])
        keep = weight >= least
        places = []
        for limit, at in zip(limits, on_limit):
            wanted = -1 if at < 0 or len(limit) < size else at * len(words) + number.get(limit[size - 1], -(1 << 62))
            k = int(np.searchsorted(kinds, wanted)) if wanted >= 0 else len(kinds)
            here = k < len(kinds) and kinds[k] == wanted
            keep[k:k + 1] |= here
            places.append(k if here else -1)
        renamed = np.cumsum(keep) - 1
        on_limit = [int(renamed[k]) if k >= 0 else -1 for k in places]
        kept = np.flatnonzero(keep)
        before = phrases
        phrases = [(before[k // len(words)] + b" " if size > 1 else b"") + words[k % len(words)] for k in kinds[kept].tolist()]
        if size >= shortest:
            out += zip(phrases, [size] * len(phrases), weight[kept].tolist())
        follow = keep[back]
        state, prefix = arc[begin, 2][follow], renamed[back[follow]]
    return out


def look_up(parts: DataFrame, counts: DataFrame) -> DataFrame:
    """The parts (``lang``, ``phrase``) with their count ``f``, by composition in groups of a hash of the part."""
    groups = max(1, counts.count() // LOOKUP_ROWS)
    bucket = F.pmod(F.xxhash64("lang", "phrase"), F.lit(groups)).cast("int").alias("bucket")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        def grams(t: pa.Table) -> list[Gram]:
            return [(a.encode(), *b.encode().split(b" ")) for a, b in zip(t.column(1).to_pylist(), t.column(2).to_pylist())]

        wanted = sorted(grams(left))
        listed = sorted(zip(grams(right), right.column(3).to_pylist()))
        words = sorted({w for g, _ in listed for w in g})
        number = {w: i for i, w in enumerate(words)}
        table = padded([tuple([number[w] for w in g]) for g, _ in listed])
        found = compose(wanted, build(table, np.array([f for _, f in listed], dtype=np.int64), words, rolled=False))
        return pa.table([pa.array([g[0].decode() for g in wanted], pa.string()),
                         pa.array([b" ".join(g[1:]).decode() for g in wanted], pa.string()), pa.array(found, pa.int64())],
                        names=["lang", "phrase", "f"])

    # new names: both sides may come from one table
    left = parts.select(bucket, F.col("lang").alias("of"), F.col("phrase").alias("part")).groupBy("bucket")
    right = counts.select(bucket, F.col("lang").alias("in"), F.col("phrase").alias("counted"), "f").groupBy("bucket")
    return left.cogroup(right).applyInArrow(run, "lang string, phrase string, f long")


def phrase_counts(df: DataFrame, *, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST,
                  least: int = MIN_COUNT) -> DataFrame:
    """Per language the phrases of 1 to ``longest`` words that occur ``least`` times or more; the empty phrase counts all words."""
    rows = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                     F.col(text_col).cast("string").alias("text")).filter("text is not null")
    cuts = borders(rows, longest)
    short = cut_lineage(count_prefixes(rows, cuts, depth=min(2, longest), least=least, shortest=0))
    if longest <= 2:
        return short
    chosen = pair_filter(short.filter("size = 2"))
    long = count_prefixes(rows, cuts, depth=longest, least=least, shortest=3, pairs=chosen)
    return cut_lineage(short.unionByName(long))


def collocations(df: DataFrame, *, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST,
                 least: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """Per language the ``top`` phrases: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A candidate's score is that of its worst cut in two. Candidates inside a longer one of the same count are left out.
    """
    counts = phrase_counts(df, text_col=text_col, lang_col=lang_col, longest=longest, least=least)
    n = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    phrases = counts.filter("size > 0")
    found = phrases.filter("size > 1").withColumnRenamed("f", "a").withColumn("words", F.split("phrase", " "))

    # a longer phrase of the same count: so is the one word longer within it
    wider = found.filter("size > 2").select("lang", "a", F.explode(F.array(
        F.array_join(F.slice("words", F.lit(1), F.col("size") - 1), " "),
        F.array_join(F.slice("words", F.lit(2), F.col("size") - 1), " "))).alias("phrase"))
    wider = wider.groupBy("lang", "phrase").agg(F.max("a").alias("wider"))
    found = found.join(wider, ["lang", "phrase"], "left").filter("wider is null or wider < a").drop("wider")

    cut = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
                     F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"))
    parts = cut.select("lang", F.explode(F.array("left", "right")).alias("phrase")).distinct()
    known = cut_lineage(look_up(parts, phrases))
    cut = cut.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cut = cut.join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cut = cut.join(n, "lang")
    exact = "cast({} as decimal(20, 0))"
    score = F.expr(f"(cast(1000 as decimal(4, 0)) * ({exact.format('a')} * {exact.format('n')})) "
                   f"div ({exact.format('l')} * {exact.format('r')})")
    worst = cut.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("worst"))
    order = Window.partitionBy("lang").orderBy(F.desc("worst.score"), F.desc("a"), "phrase")
    return worst.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("worst.l").alias("l"),
        F.col("worst.r").alias("r"), "n", F.col("worst.score").alias("score"))
