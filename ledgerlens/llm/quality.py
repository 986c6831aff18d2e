"""A quality classifier on random-indexing word vectors.

Every word (a run of letters and digits, or of other marks; case kept) has a
sparse random index vector: a few +1 and -1 at places drawn from its bytes. A
word's vector adds to its index vector the scaled sum of the index vectors seen
around it in the training texts. A document's vector pools its words' vectors by
mean; six more numbers say how that mean came about: its length, the number of
words, the share of different ones, and the shares of words whose vector returns
one, two and three words on. A two-layer network in numpy gives a score, and a temperature fitted on
rows kept from its training calibrates the probability.

Fitting uses a bounded sample of the labelled rows: the ``FIT_ROWS`` rows whose
hashed ids come first. Every word of them gets a context vector, summed in Spark by
the word's hash (which is all its index vector depends on) and kept in half a byte
per dimension; words they lack are pooled by their index vectors. Sums are whole
numbers and rows are put in order, so a fit repeats exactly. Scoring reads every
whole text.

Defined results: null texts count as empty; a text without words pools to zero;
with no labelled rows every score is 0.5, with one class it is that class's
share; labels that are null are left out, and of repeated labels the smaller
counts; of rows that repeat a fitted id, fitting takes one, the one with the
smallest hash of its text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import bounded, claim, give_back, keep_rows, map_slices, releases, slices
from ledgerlens.llm.components import cut_lineage

DIMENSIONS = 128
NONZERO = 8
WINDOW = 2
FIT_ROWS = 12_000
LOCAL_WORDS = 32_768
LOCAL_PLACES = 1 << 24
CHUNK = 16_384
PACK = 4_096
HIDDEN = 32
EPOCHS = 60
MEMO_WORDS = 32_768
THRESHOLD = 0.3
FEATURES = DIMENSIONS + 6
WORDS = re.compile(r"\w+|[^\w\s]+")


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 11) for w in words),
                       dtype=np.uint64, count=len(words))


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """One sparse random vector per word: eight places (seven bits each) and signs from the hash of its bytes."""
    draw = hashes[:, None]
    step = np.arange(NONZERO, dtype=np.uint64)
    place = (draw >> (step * np.uint64(7)) & np.uint64(DIMENSIONS - 1)).astype(np.int64)
    sign = (draw >> (step + np.uint64(56)) & np.uint64(1)).astype(np.int8) * 2 - 1
    out = np.zeros((len(hashes), DIMENSIONS), dtype=np.int8)
    for k in range(NONZERO):
        out[np.arange(len(hashes)), place[:, k]] += sign[:, k]
    return out


class Contexts:
    """Sums, per word, of the index vectors seen around it; ``take`` empties it."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.index = np.zeros((0, DIMENSIONS), dtype=np.int8)
        self.sums = np.zeros((0, DIMENSIONS), dtype=np.int32)
        self.places = 0

    def full(self) -> bool:
        return len(self.row) > LOCAL_WORDS or self.places > LOCAL_PLACES

    def rows_of(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.row]
        if new:
            used, need = len(self.row), len(self.row) + len(new)
            if need > len(self.hashes):
                size = max(2 * need, 4096)
                for name in ("hashes", "index", "sums"):
                    old = getattr(self, name)
                    grown = np.zeros((size, *old.shape[1:]), dtype=old.dtype)
                    grown[:used] = old[:used]
                    setattr(self, name, grown)
            self.hashes[used:need] = word_hashes(new)
            self.index[used:need] = index_vectors(self.hashes[used:need])
            self.row.update(zip(new, range(used, need)))
        return np.fromiter(map(self.row.__getitem__, words), dtype=np.int64, count=len(words))

    def add(self, part: tuple[list[str], int, int]) -> None:
        """Adds a part of a text as ``chunks`` gives it."""
        words, left, right = part
        at = self.rows_of(words)
        near = self.index[at]
        around = np.zeros((len(words), DIMENSIONS), dtype=np.int8)  # at most 2 * WINDOW * NONZERO
        for step in range(1, WINDOW + 1):
            around[step:] += near[:-step]
            around[:-step] += near[step:]
        at, around = at[left:len(at) - right], around[left:len(words) - right]
        order = np.argsort(at, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])
        self.sums[at[order][starts]] += np.add.reduceat(around[order], starts, axis=0, dtype=np.int32)
        self.places += len(at)

    def take(self) -> Iterator[pa.RecordBatch]:
        yield from coded(self.hashes[:len(self.row)], self.sums[:len(self.row)])
        self.clear()


def chunks(words: list[str]) -> Iterator[tuple[list[str], int, int]]:
    """A text's words in parts, each with its neighbours: the words, and how many of the first and last are neighbours."""
    for begin in range(0, len(words), CHUNK):
        end = min(begin + CHUNK, len(words))
        low, high = max(0, begin - WINDOW), min(len(words), end + WINDOW)
        yield words[low:high], begin - low, high - end


def packed(values: np.ndarray) -> np.ndarray:
    """Rows of numbers from -8 to 7, two in a byte."""
    halves = (values + 8).astype(np.uint8)
    return halves[:, ::2] | halves[:, 1::2] << 4


def unpacked(halves: np.ndarray) -> np.ndarray:
    out = np.empty((len(halves), DIMENSIONS), dtype=np.int8)
    out[:, ::2], out[:, 1::2] = halves & 15, halves >> 4
    return out - np.int8(8)


def coded(hashes: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of a word's hash and its sums in the fewest bytes a number; words without neighbours are left out."""
    top = np.zeros(len(sums), dtype=np.int64)
    for a in range(0, len(sums), PACK):
        top[a:a + PACK] = np.abs(sums[a:a + PACK]).max(axis=1)
    for kind, least, most in (("", 1, 7), ("<i1", 8, 127), ("<i2", 128, 32767), ("<i4", 32768, 2 ** 31 - 1), ("<i8", 2 ** 31, 2 ** 63 - 1)):
        rows = np.flatnonzero((top >= least) & (top <= most))
        for a in range(0, len(rows), PACK):
            part = rows[a:a + PACK]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[part].astype(np.int64)), pa.array(
                    [r.tobytes() for r in (sums[part].astype(kind) if kind else packed(sums[part]))], type=pa.binary())], names=["word", "sums"])


class Learned:
    """Context vectors by word hash (sorted), half a byte a dimension (``packed``); a row's length means nothing."""

    def __init__(self, hashes: np.ndarray, vectors: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.vectors = hashes[order], vectors[order]

    def __len__(self) -> int:
        return len(self.hashes)

    def add_to(self, vectors: np.ndarray, hashes: np.ndarray) -> None:
        """Adds the context part, scaled to the length of an index vector, to the rows of known words."""
        if not len(self.hashes):
            return
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = np.flatnonzero(self.hashes[at] == hashes)
        more = unpacked(self.vectors[at[known]]).astype(np.float32)
        more *= np.float32(np.sqrt(NONZERO)) / np.maximum(np.linalg.norm(more, axis=1, keepdims=True), 1e-9)
        vectors[known] += more


def in_halves(sums: np.ndarray) -> np.ndarray:
    """Each row scaled to at most 7, rounded and packed."""
    top = np.maximum(np.abs(sums).max(axis=1, initial=0), 1)[:, None]
    return packed(np.rint(sums * (7.0 / top)).astype(np.int8))


class Pooler:
    """Document vectors from word vectors."""

    def __init__(self, learned: Learned):
        self.learned, self.row, self.table = learned, {}, np.zeros((0, DIMENSIONS), dtype=np.float32)

    def rows_of(self, words: list[str]) -> None:
        """Gives every word (no word twice) a row in the table of unit vectors."""
        new = [w for w in words if w not in self.row]
        if len(self.row) + len(new) > MEMO_WORDS:
            self.row, new = {}, list(words)
        if not new:
            return
        hashes = word_hashes(new)
        vectors = index_vectors(hashes).astype(np.float32)
        self.learned.add_to(vectors, hashes)
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        used = len(self.row)
        if used + len(new) > len(self.table):
            grown = np.zeros((max(MEMO_WORDS, len(new)), DIMENSIONS), dtype=np.float32)  # pages come with the words
            grown[:used] = self.table[:used]
            self.table = grown
        self.table[used:used + len(new)] = vectors
        self.row.update(zip(new, range(used, used + len(new))))

    def pool(self, texts: list[str | None]) -> np.ndarray:
        """One row of ``FEATURES`` numbers per text."""
        out = np.zeros((len(texts), FEATURES), dtype=np.float64)
        for i, text in enumerate(texts):
            found = WORDS.findall(text or "")
            if not found:
                continue
            kinds, n = {w: k for k, w in enumerate(dict.fromkeys(found))}, len(found)
            order = np.fromiter(map(kinds.__getitem__, found), dtype=np.int64, count=n)
            counts = np.bincount(order).astype(np.float32)
            total = np.zeros(DIMENSIONS, dtype=np.float64)
            words = list(kinds)
            for a in range(0, len(words), 4096):
                part = words[a:a + 4096]
                self.rows_of(part)
                at = np.fromiter(map(self.row.__getitem__, part), dtype=np.int64, count=len(part))
                total += counts[a:a + 4096] @ self.table[at]
            same = [np.count_nonzero(order[step:] == order[:-step]) / n for step in (1, 2, 3)]
            out[i, :DIMENSIONS] = total / n
            out[i, DIMENSIONS:] = float(np.linalg.norm(total / n)), np.log1p(n), len(kinds) / n, *same
        return out


class Network:
    """Two layers (tanh, logistic), trained by Adam on whole batches in a fixed order; then a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.share = float(y.mean()) if len(y) else 0.5
        self.constant = len(y) < 10 or self.share in (0.0, 1.0)
        if self.constant:
            return
        rng = np.random.Generator(np.random.PCG64(5))
        tune = np.arange(len(y)) % 5 == 4
        self.mean, self.scale = x[~tune].mean(axis=0), x[~tune].std(axis=0) + 1e-6
        self.temperature = 1.0
        x = (x - self.mean) / self.scale
        self.w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        self._fit(x[~tune], y[~tune].astype(np.float64), rng)
        logits, target = self._logits(x[tune]), y[tune]
        grid = np.exp(np.linspace(-1.5, 2.5, 81))
        loss = [np.mean(np.logaddexp(0, logits / t) - target * logits / t) for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    def _fit(self, x: np.ndarray, y: np.ndarray, rng, batch: int = 128, rate: float = 2e-3, decay: float = 1e-3):
        m, v, t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for a in range(0, len(y), batch):
                rows = order[a:a + batch]
                h = np.tanh(x[rows] @ self.w[0] + self.w[1])
                d = (1 / (1 + np.exp(-(h @ self.w[2] + self.w[3]))) - y[rows]) / len(rows)
                back = np.outer(d, self.w[2]) * (1 - h * h)
                grads = [x[rows].T @ back + decay * self.w[0], back.sum(axis=0), h.T @ d + decay * self.w[2],
                         np.array([d.sum()])]
                t += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.w[i] = self.w[i] - rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3][0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant:
            return np.full(len(x), self.share)
        logits = np.clip(self._logits((x - self.mean) / self.scale) / self.temperature, -40, 40)
        return 1 / (1 + np.exp(-logits))


class QualityModel:
    def __init__(self, learned: Learned, network: Network):
        self.learned, self.network = learned, network

    def score(self, texts: list[str | None]) -> list[float]:
        return self.network.score(_pooler(self.learned).pool(texts)).tolist()


_POOLERS: dict[int, tuple[Learned, Pooler]] = {}


def _pooler(learned: Learned) -> Pooler:
    """The worker's pooler of these vectors, kept between batches."""
    if id(learned) not in _POOLERS:
        _POOLERS.clear()
        _POOLERS[id(learned)] = learned, Pooler(learned)
    return _POOLERS[id(learned)][1]


releases("quality", _POOLERS.clear)


def train(df: DataFrame, labels: DataFrame, use: Column, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", fit_rows: int = FIT_ROWS) -> QualityModel:
    """A model from the labelled rows where ``use`` (on ids) holds.

    ``fit_rows`` bounds what the driver receives: one vector per fitted row, and 72
    bytes per word of these rows.
    """
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & use).groupBy(id_col).agg(
        F.min(label_col).alias("label")).orderBy(F.xxhash64(F.col(id_col)), id_col).limit(fit_rows)
    chosen = {r[0]: r[1] for r in known.collect()}  # at most fit_rows pairs
    spark = df.sparkSession
    ids = spark.createDataFrame([(k, int(v)) for k, v in chosen.items()], "k long, label int")
    found = cut_lineage(df.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(ids), "k").select("k", "label", "text", F.xxhash64("text").alias("h"),
                                      F.monotonically_increasing_id().alias("at")))  # at most fit_rows ids
    one = cut_lineage(found.groupBy("k").agg(F.min("h").alias("h")))
    one = cut_lineage(found.select("k", "h", "at").join(F.broadcast(one), ["k", "h"]).groupBy("k").agg(
        F.min("at").alias("at")))
    rows = found.join(F.broadcast(one), ["k", "at"]).select("k", "label", "text")  # at most fit_rows rows

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("quality_fit")  # an earlier model's table goes
        seen = Contexts()
        for batch in batches:
            for piece in slices(batch):
                for text in piece.column(0).to_pylist():
                    for part in chunks(WORDS.findall(text or "")):
                        seen.add(part)
                        if seen.full():
                            yield from seen.take()
        yield from seen.take()
        batch = piece = None
        give_back()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("quality_fit")
        kinds = {DIMENSIONS * n: f"<i{n}" for n in (1, 2, 4, 8)}
        row: dict[int, int] = {}
        blocks: list[np.ndarray] = []
        for batch in batches:
            for word, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                at = row.setdefault(word, len(row))
                if at == PACK * len(blocks):
                    blocks.append(np.zeros((PACK, DIMENSIONS), dtype=np.int64))
                part, sums = part.as_buffer(), blocks[at // PACK][at % PACK]
                if part.size in kinds:
                    sums += np.frombuffer(part, dtype=kinds[part.size])
                else:
                    sums += unpacked(np.frombuffer(part, dtype=np.uint8)[None])[0]
        words = np.fromiter(row, dtype=np.int64, count=len(row))
        batch = part = sums = row = None
        for a in range(0, len(words), PACK):
            part = words[a:a + PACK]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.tobytes()], type=pa.binary()),
                 pa.array([in_halves(blocks.pop(0)[:len(part)]).tobytes()], type=pa.binary())], names=["words", "sums"])
        give_back()

    packs = bounded(rows.select("text")).mapInArrow(gather, "word long, sums binary").repartition("word").mapInArrow(
        add_up, "words binary, sums binary").collect()  # 72 bytes a word of at most fit_rows rows
    learned = Learned(np.frombuffer(b"".join(bytes(r["words"]) for r in packs), dtype=np.int64).view(np.uint64),
                      np.frombuffer(b"".join(bytes(r["sums"]) for r in packs), dtype=np.uint8).reshape(-1, DIMENSIONS // 2))
    del packs
    give_back()
    shared = spark.sparkContext.broadcast(learned)  # bounded by fit_rows

    def pool(piece):
        x = _pooler(shared.value).pool(piece.column(2).to_pylist())
        return {"k": piece.column(0), "label": piece.column(1), "x": [v.astype("<f8").tobytes() for v in x]}

    pooled = sorted((r["k"], r["label"], bytes(r["x"])) for r in map_slices(
        rows, pool, "k long, label int, x binary", owner="quality").collect())  # at most fit_rows vectors
    shared.destroy()
    x = np.array([np.frombuffer(b, dtype="<f8") for _, _, b in pooled]).reshape(-1, FEATURES)
    y = np.array([label for _, label, _ in pooled], dtype=np.float64)
    return QualityModel(learned, Network(x, (y > 0).astype(np.float64)))


def score(df: DataFrame, model: QualityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and ``score``."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by fit_rows

    def run(piece):
        return {"id": piece.column(0), "score": shared.value.score(piece.column(1).to_pylist())}

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_slices(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, score double",
                      owner="quality").withColumnRenamed("id", id_col)


def keep_good(df: DataFrame, model: QualityModel, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score at least ``threshold``, all columns unchanged."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    return keep_rows(df, text_col, lambda texts: [s >= threshold for s in shared.value.score(texts)],
                     owner="quality")
