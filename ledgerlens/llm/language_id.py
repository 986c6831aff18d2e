"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. The
vector of an n-gram binds its letters: each is permuted (rotated) once for every
letter that follows and they are multiplied element by element. A text bundles
(adds) the vectors of all its n-grams over lower-cased letters, runs of other
characters counting as one space; a language bundles its training texts. A text
is given the language whose prototype has the highest cosine with it.

Prototypes of all languages share much (common endings, the space), so their
mean is taken from each before comparing; with one language nothing is taken.

Training sums n-gram counts per language in Spark and bundles the counts, which
is the same sum; the model is one vector per language.

Defined results: null texts and texts without a letter get ``und`` and score 0,
as does every text if there is nothing to learn from; equal cosines go to the
smaller language name; n-grams need at least one letter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import bounded, claim, keep_rows, map_slices, releases, slices

DIMENSIONS = 1024
NGRAM = 3
SEED = 7
MEMO_NGRAMS = 60_000
SLICE = 64
GROUP = 1 << 17
MAX_LANGUAGES = 4096
UNKNOWN = "und"


@lru_cache(maxsize=4096)
def letter_vector(code: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    bits = np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, dimensions, dtype=np.int8)
    return (2 * bits - 1).astype(np.int8)


class NgramVectors:
    """Vectors of n-grams by packed code points (21 bits each), made when first seen, in a bounded table."""

    def __init__(self, dimensions: int = DIMENSIONS, limit: int = MEMO_NGRAMS):
        self.dimensions, self.limit, self.table = dimensions, limit, {}

    def one(self, packed: int) -> np.ndarray:
        vector = np.ones(self.dimensions, dtype=np.int8)
        for shift in range(NGRAM):  # the last letter is not rotated
            vector = vector * np.roll(letter_vector(packed >> (21 * shift) & 0x1FFFFF, self.dimensions), shift)
        return vector

    def get(self, codes: np.ndarray) -> np.ndarray:
        table, codes = self.table, codes.tolist()
        if len(table) + len(codes) > self.limit:
            table.clear()
        for c in codes:
            if c not in table:
                table[c] = self.one(c)
        out = np.empty((len(codes), self.dimensions), dtype=np.float32)
        for i, c in enumerate(codes):
            out[i] = table[c]
        return out


@lru_cache(maxsize=1)
def _vectors() -> NgramVectors:
    return NgramVectors()


releases("language_id", _vectors.cache_clear)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def ngrams(text: str | None) -> np.ndarray:
    """The packed n-grams of a text, repeats included; empty if it has no letter."""
    if not text:
        return np.empty(0, dtype=np.int64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, dtype=np.int64)
    codes[~letter] = 32
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = letter[1:] | letter[:-1]  # one space for each run of other characters
    codes = np.concatenate([[32], codes[keep], [32]])
    if codes[1] == 32:
        codes = codes[1:]
    if codes[-2] == 32:
        codes = codes[:-1]
    return codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:]


def bundles(texts: list[str | None]) -> np.ndarray:
    """One bundled vector per text; zero for texts without a letter.

    Texts are taken together while their n-grams are at most ``GROUP``, and a longer
    text is bundled in parts of that size, so memory does not grow with the texts.
    """
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    rows: list[int] = []
    parts: list[np.ndarray] = []

    def flush() -> None:
        if not parts:
            return
        every, at = np.unique(np.concatenate(parts), return_inverse=True)
        row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        counts = np.bincount(row * len(every) + at, minlength=len(parts) * len(every)).reshape(len(parts), len(every))
        np.add.at(out, rows, bundle(counts.astype(np.float32), every))
        rows.clear()
        parts.clear()

    held = 0
    for i, text in enumerate(texts):
        grams = ngrams(text)
        for a in range(0, len(grams), GROUP):
            part = grams[a:a + GROUP]
            if held + len(part) > GROUP:
                flush()
                held = 0
            rows.append(i)
            parts.append(part)
            held += len(part)
    flush()
    return out


def bundle(counts: np.ndarray, grams: np.ndarray, block: int = 2048) -> np.ndarray:
    out = np.zeros((counts.shape[0], DIMENSIONS), dtype=np.float32)
    for a in range(0, len(grams), block):
        out += counts[:, a:a + block] @ _vectors().get(grams[a:a + block])
    return out


class LanguageModel:
    """Languages in order of name, and a prototype for each (unit vectors, their mean taken out)."""

    def __init__(self, languages: list[str], sums: np.ndarray):
        unit = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12) if languages else sums
        self.languages = languages
        self.mean = unit.mean(axis=0) if len(languages) > 1 else np.zeros(DIMENSIONS)
        shifted = unit - self.mean
        self.prototypes = (shifted / np.maximum(np.linalg.norm(shifted, axis=1, keepdims=True), 1e-12)
                           if languages else shifted)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language and the cosine (0 to 1) for each text."""
        vectors = bundles(texts)
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        unit = vectors / np.maximum(norms, 1e-12) - self.mean
        unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)
        has_letter = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], dtype=bool)
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        cosine = unit @ self.prototypes.T
        best = np.argmax(cosine, axis=1)
        score = np.clip(cosine[np.arange(len(texts)), best], 0.0, 1.0)
        return ([self.languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letter)],
                [float(s) if ok else 0.0 for s, ok in zip(score, has_letter)])


def train(df: DataFrame, use: Column, *, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """A model from the rows where ``use`` holds and the language is not null.

    Each task sends n-gram counts per language, bounded by a flush; what reaches
    the driver is one row per language with ``DIMENSIONS`` sums. More than
    ``MAX_LANGUAGES`` different values are no languages and raise ``ValueError``.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        claim("language_id")
        for batch in batches:
            for piece in slices(batch, SLICE):
                langs, texts = piece.column(0).to_pylist(), piece.column(1).to_pylist()
                vectors = bundles(texts).astype(np.float64)
                for lang in set(langs):
                    part = vectors[[i for i, x in enumerate(langs) if x == lang]].sum(axis=0)
                    sums[lang] = sums[lang] + part if lang in sums else part
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.astype(np.int64).tolist() for v in sums.values()])],
                names=["lang", "sums"])

    rows = df.filter(use & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    parts = bounded(rows).mapInArrow(count, "lang string, sums array<long>")
    each = parts.select("lang", F.posexplode("sums").alias("at", "v")).groupBy("lang", "at").agg(F.sum("v").alias("v"))
    whole = each.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("s")).select("lang", "s.v")
    found = sorted((r["lang"], r["v"]) for r in whole.limit(MAX_LANGUAGES + 1).collect())
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different languages; is {lang_col!r} a language column?")
    return LanguageModel([x for x, _ in found], np.array([v for _, v in found], dtype=np.float64).reshape(-1, DIMENSIONS))


def predict(df: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``lang_pred`` and ``score``."""
    def run(piece):
        langs, scores = model.predict(piece.column(1).to_pylist())
        return {"id": piece.column(0), "lang_pred": langs, "score": scores}

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_slices(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double",
                      SLICE, owner="language_id").withColumnRenamed("id", id_col)


def keep_known(df: DataFrame, model: LanguageModel, *, text_col: str = "text") -> DataFrame:
    """The rows whose language is known, all columns unchanged; rows predicted ``und`` go."""
    return keep_rows(df, text_col, lambda texts: [x != UNKNOWN for x in model.predict(texts)[0]],
                     owner="language_id")
