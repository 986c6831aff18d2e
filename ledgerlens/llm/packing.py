"""Packing token sequences by non-negative least squares over length combinations.

A document longer than the window is cut at every full window; those pieces fill
sequences by themselves and a rest of 1 to window - 1 tokens remains. Rests are
binned by length (rounded up to ``GRID`` tokens). All combinations of at most
``PARTS`` bins that fill the window exactly are enumerated; non-negative least
squares finds how often to repeat each so that the combinations use up the
histogram of the bins. Repeats are rounded down to what the bins hold. Rests take
the planned places by their rank in their bin, so a sequence's number follows
from arithmetic. What remains is packed greedily: laid end to end and cut where a
window is full, so those sequences have no padding but for the last one.

Only the histogram (one row per bin) reaches the driver. Rows are spread over
buckets by a hash of their identifier, never by length, so a common length is
many tasks' work. Ranks are taken on rows without ids; only a rest that a window's end
divides gets its ids back, so it is hashed without tokenizing again.

Defined results: null and empty texts are the end id alone; repeated rows are
packed as often as they occur; empty tables give no rows. Sequences have at most
``window`` tokens, offsets are gapless from 0, sequence numbers are gapless.
"""

from __future__ import annotations

import os
import re
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import count as counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.batches import Memo, bounded, claim, releases, slices
from ledgerlens.llm.bpe import byte_alphabet
from ledgerlens.llm.numbering import BUCKETS, bucket_of, running
from ledgerlens.session import checkpoint_dir

WINDOW = 2048
GRID = 16
PARTS = 3
END_ID = 1
MEMO_BYTES = 120 << 20
# The tokenizer file's split pattern for lower-cased plain text, with marks of any alphabet.
WORDS = re.compile(r"[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)|\d|(?:[^\w\s]|_)+")
ODD_SPACES = "\x1c\x1d\x1e\x1f"
PIECES = "doc_id long, start long, length long, doc_tokens long, crc long, ids binary"


@lru_cache(maxsize=4096)
def plain(c: str) -> bool:
    """Whether a character passes composing and lower-casing as one letter, or is a mark that nothing changes."""
    if c.isascii():
        return c not in ODD_SPACES
    if unicodedata.normalize("NFC", c) != c or c == "\u03a3":  # a closing sigma is Python's own rule
        return False
    low = c.lower()
    if c.isalpha():
        return len(low) == 1 and low.isalpha() and unicodedata.normalize("NFC", low) == low
    return unicodedata.category(c)[0] in "PS" and low == c and unicodedata.combining(c) == 0


class PreTokenEncoder:
    """Ids of whole texts from a byte-level BPE that composes, lower-cases and splits texts into words and runs of marks.

    In a text of plain characters (see :func:`plain`; composed, without special
    strings) those steps are a lower-casing and one pattern. Each word's ids then come
    from the tokenizer's model, once, and repeated words from a memo bounded in bytes.
    Any other text goes to the tokenizer whole. ``by_word`` false does that for all texts.
    """

    def __init__(self, path: str, by_word: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer, self.by_word = Tokenizer.from_file(path), by_word
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = [*ODD_SPACES, *self.specials]
        self.alphabet = dict(enumerate(byte_alphabet()))
        self.memo = Memo(self.word_ids, MEMO_BYTES)

    def word_ids(self, word: str) -> bytes:
        letters = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def is_plain(self, text: str) -> bool:
        if text.isascii():  # the same as below for ASCII, told without a look at each character
            return not any(x in text for x in self.odd)
        return (all(map(plain, set(text))) and unicodedata.is_normalized("NFC", text)
                and not any(x in text for x in self.specials))

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        if self.by_word and self.is_plain(text):
            return b"".join(map(self.memo.__getitem__, WORDS.findall(text.lower())))
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


@lru_cache(maxsize=1)
def _encoder(path: str, by_word: bool) -> PreTokenEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return PreTokenEncoder(path, by_word)


releases("packing", _encoder.cache_clear)


def cut_documents(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                  end_id: int = END_ID, by_word: bool = True) -> DataFrame:
    """The pieces of every document: full windows, and the rest with its ids (``ids`` null for full windows)."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("packing")
        encoder = _encoder(path, by_word)
        for batch in batches:
            for piece in slices(batch, 128):
                cols: list[list] = [[], [], [], [], [], []]
                for doc, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    raw = encoder.encode(text or "") + end
                    n = len(raw) // 4
                    for start in range(0, n, window):
                        part = raw[4 * start:4 * (start + window)]
                        length = len(part) // 4
                        for c, v in zip(cols, (doc, start, length, n, zlib.crc32(part),
                                               None if length == window else part)):
                            c.append(v)
                kinds = [pa.int64()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds)],
                                                 names=["doc_id", "start", "length", "doc_tokens", "crc", "ids"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return bounded(rows).mapInArrow(run, PIECES)


def combinations(units: int, parts: int) -> list[tuple[int, ...]]:
    """All ways to write ``units`` as a sum of 1 to ``parts`` positive numbers, largest first."""
    out: list[tuple[int, ...]] = []

    def extend(chosen: tuple[int, ...], left: int) -> None:
        if left == 0:
            out.append(chosen)
        elif len(chosen) < parts:
            top = min(left, chosen[-1] if chosen else left)
            for n in range(top, (left - 1) // (parts - len(chosen)), -1):
                extend((*chosen, n), left - n)

    extend((), units)
    return out


def least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By normal equations; columns that are not independent go to the general solver."""
    try:
        x = np.linalg.solve(a.T @ a, a.T @ b)
        if np.abs(a.T @ (a @ x - b)).max() <= 1e-10 * max(1.0, float(np.abs(b).max())):
            return x
    except np.linalg.LinAlgError:
        pass
    return np.linalg.lstsq(a, b, rcond=None)[0]


def nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method."""
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    gain = a.T @ b
    for _ in range(rounds or 3 * a.shape[0]):
        gain[used] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= 1e-9 * max(1.0, float(np.abs(b).max(initial=0))):
            break
        used[best] = True
        while True:
            at = np.flatnonzero(used)
            try_x = least_squares(a[:, at], b)
            if (try_x > 1e-12).all():
                break
            low = try_x <= 1e-12
            step = np.min(x[at][low] / np.maximum(x[at][low] - try_x[low], 1e-300))
            x[at] += step * (try_x - x[at])
            used[at[x[at] <= 1e-12]] = False
            x[~used] = 0
            if not used.any():
                break
        x = np.zeros(a.shape[1])
        if used.any():
            x[np.flatnonzero(used)] = try_x
        gain = a.T @ (b - a @ x)
    return x


def plan(histogram: dict[int, int], units: int, parts: int = PARTS) -> list[tuple[tuple[int, ...], int]]:
    """How often to use each combination, never more of a bin than it holds."""
    combos = [c for c in combinations(units, parts) if all(histogram.get(k, 0) for k in c)]
    if not combos:
        return []
    a = np.zeros((units + 1, len(combos)))
    for j, c in enumerate(combos):
        for k in c:
            a[k, j] += 1
    b = np.array([histogram.get(k, 0) for k in range(units + 1)], dtype=float)
    scale = max(1.0, float(b.max()))
    x = nnls(a, b / scale) * scale
    left, out = dict(histogram), []
    for j in np.argsort(-x, kind="stable"):
        need = {k: combos[j].count(k) for k in combos[j]}
        n = min([int(x[j] + 1e-6), *(left[k] // m for k, m in need.items())])
        if n > 0:
            for k, m in need.items():
                left[k] -= n * m
            out.append((combos[j], n))
    return out


def places(planned: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """Planned places: (bin, first rank, end rank, first sequence, place in the sequence)."""
    used: dict[int, int] = {}
    out, first = [], 0
    for combo, n in planned:
        for place, k in zip(counter(), combo):
            at = used.get(k, 0)
            out.append((k, at, at + n, first, place))
            used[k] = at + n
        first += n
    return out


def pack(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         grid: int = GRID, parts: int = PARTS, end_id: int = END_ID, by_word: bool = True) -> DataFrame:
    """Per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``."""
    if window % grid:
        raise ValueError("the grid must divide the window")
    spark = df.sparkSession
    folder = f"{checkpoint_dir(spark, local_fallback=True).rstrip('/')}/packing-{uuid.uuid4().hex}"
    cut_documents(df, path, id_col=id_col, text_col=text_col, window=window, end_id=end_id,
                  by_word=by_word).write.parquet(folder)
    pieces = spark.read.parquet(folder)
    # a full window is a piece of that length: told so, the ids are read for the divided rests alone
    full_window = F.col("length") == window
    rest = pieces.filter(~full_window).drop("ids").withColumn("bin", F.ceil(F.col("length") / grid).cast("int"))
    histogram = {r[0]: r[1] for r in rest.groupBy("bin").count().collect()}  # at most window / grid rows
    planned = plan(histogram, window // grid, parts)
    slots = places(planned)
    n_planned = sum(n for _, n in planned)

    full = pieces.filter(full_window).select("doc_id", "start", "length", "crc", "doc_tokens")
    full = full.withColumn("bucket", bucket_of([F.col("doc_id"), F.col("start")]))
    full = running(full, ["doc_id", "start", "crc"], F.lit(1), bucket="bucket", into="at").select(
        "doc_id", "start", "length", "crc", "doc_tokens", "at", F.lit(0).cast("long").alias("offset"))

    ranked = _rank_in_bin(rest)
    table = spark.createDataFrame(slots, "bin int, low long, high long, first long, place int")
    at = ranked.join(F.broadcast(table.withColumnRenamed("bin", "of_bin")),  # at most bins x parts rows
                     (F.col("bin") == F.col("of_bin")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
                     "left")
    in_place = at.filter("low is not null").select(
        "doc_id", "start", "length", "crc", "doc_tokens", (F.col("first") + F.col("rank") - F.col("low")).alias("at"),
        "place")
    before = Window.partitionBy("at").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    in_place = in_place.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop("place")

    loose = at.filter("low is null").select("doc_id", "start", "length", "crc", "doc_tokens", "bucket")
    loose = running(loose, ["doc_id", "start", "crc"], F.col("length"), bucket="bucket", into="from")
    ends = F.least(F.col("length"), F.lit(window) - F.pmod(F.col("from"), F.lit(window)))
    loose = loose.withColumn("part", F.explode(F.filter(F.array(
        F.struct(F.lit(0).cast("long").alias("skip"), ends.cast("long").alias("n")),
        F.struct(ends.cast("long").alias("skip"), (F.col("length") - ends).cast("long").alias("n"))),
        lambda p: p["n"] > 0)))
    position = F.col("from") + F.col("part.skip")
    greedy = loose.select(
        "doc_id", (F.col("start") + F.col("part.skip")).alias("start"), F.col("part.n").alias("length"),
        F.when(F.col("part.n") == F.col("length"), F.col("crc")).alias("crc"), "doc_tokens",
        ((position - F.pmod(position, F.lit(window))) / window).cast("long").alias("at"),
        F.pmod(position, F.lit(window)).cast("long").alias("offset"),
        F.struct("doc_id", "start", "length", "crc").alias("rest"), "part")
    # Only rests that a window's end divides, at most one a sequence, need their ids again.
    divided = greedy.filter("crc is null").drop("crc")
    ids = pieces.filter(~full_window).select(F.struct("doc_id", "start", "length", "crc").alias("rest"), "ids")
    ids = ids.join(divided.select("rest").distinct(), "rest", "left_semi").dropDuplicates(["rest"])
    cut = F.expr("substring(ids, cast(4 * part.skip as int) + 1, cast(4 * part.n as int))")
    columns = ["doc_id", "start", "length", "crc", "doc_tokens", "at", "offset"]
    greedy = greedy.filter("crc is not null").select(*columns).unionByName(
        divided.join(ids, "rest").withColumn("crc", F.crc32(cut)).select(*columns))

    counts = pieces.agg(F.sum(F.when(full_window, 1).otherwise(0)).alias("n")).first()
    n_full = counts["n"] or 0
    parts_ = [(full, 0), (in_place, n_full), (greedy, n_full + n_planned)]
    out = [p.select(
        "doc_id", "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens",
        (F.col("at") + F.lit(base).cast("long")).alias("sequence_id"), "offset") for p, base in parts_]
    return out[0].unionByName(out[1]).unionByName(out[2])


def _rank_in_bin(rest: DataFrame) -> DataFrame:
    """``rank`` of every rest in its bin, by bucket and identifier; a bin's rows are spread over buckets.

    The table of counts has at most bins x ``BUCKETS`` rows whatever the input.
    """
    rows = rest.withColumn("bucket", bucket_of([F.col("doc_id"), F.col("start")]))
    order = Window.partitionBy("bucket", "bin").orderBy("doc_id", "start", "crc")
    counts = rows.groupBy("bucket", "bin").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("bin").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("ahead", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    ranked = rows.withColumn("own", F.row_number().over(order) - 1)
    return ranked.join(counts, ["bucket", "bin"]).withColumn("rank", (F.col("ahead") + F.col("own")).cast("long")).drop(
        "ahead", "own")
