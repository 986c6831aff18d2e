"""Arrow helpers: texts of a record batch in small slices, and row transforms that keep other columns."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_ROWS = 256
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
LONG_KEY = 64
ENTRY_BYTES = 220
_RELEASES: dict[str, Callable[[], None]] = {}
_OWNER = [""]


def releases(owner: str, release: Callable[[], None]) -> None:
    """Names what drops the tables that an operator keeps in a Python worker between batches."""
    _RELEASES[owner] = release


def claim(owner: str) -> None:
    """A worker that goes over to another operator first drops what the one before kept."""
    if _OWNER[0] != owner:
        for name, release in _RELEASES.items():
            if name != owner:
                release()
        _OWNER[0] = owner
        give_back()


def give_back() -> None:
    """Hands memory that is free again to the system, which the worker would keep while it waits for other tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError, TypeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


class Memo(dict):
    """A dictionary that computes missing values and starts afresh at ``limit`` bytes; long keys aren't kept."""

    def __init__(self, compute: Callable, limit: int):
        super().__init__()
        self.compute, self.limit, self.used = compute, limit, 0

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) > LONG_KEY:
            return value
        size = ENTRY_BYTES + len(key) + (0 if value.__class__ is int else len(value))
        self.used += size
        if self.used > self.limit:
            self.clear()
            self.used = size
        self[key] = value
        return value


def bounded(df: DataFrame) -> DataFrame:
    """``df``, whose session sends Python at most ``BATCH_BYTES`` at a time.

    Rows are whole texts, and Spark's 10,000 of them would be held several times over,
    by the executor and by each of its workers. A lower setting is left as it is.
    """
    conf = df.sparkSession.conf
    held = re.fullmatch(r"(\d+)([kmg]?)b?", conf.get(BATCH_CONF).lower())
    if held is None or int(held[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[held[2]] > BATCH_BYTES:
        conf.set(BATCH_CONF, f"{BATCH_BYTES}b")
    return df


def slices(batch: pa.RecordBatch, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``rows`` rows, so that Python copies stay small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str,
               rows: int = SLICE_ROWS, owner: str = "") -> DataFrame:
    """``fn`` turns a slice of the input into columns (name -> list or array) of ``schema``.

    ``schema`` is a DDL string; the output has just its columns. Empty input gives no rows.
    """
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(owner)
        for batch in batches:
            for piece in slices(batch, rows):
                cols = fn(piece)
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in
                     (cols[n] for n in names)], names=names)
        batch = piece = cols = None
        give_back()

    return bounded(df).mapInArrow(run, schema)


def keep_rows(df: DataFrame, text_col: str, decide: Callable[[list], list], owner: str = "") -> DataFrame:
    """The rows of ``df`` for which ``decide`` (texts -> booleans) is true, all columns unchanged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(owner)
        for batch in batches:
            for piece in slices(batch):
                texts = piece.column(piece.schema.get_field_index(text_col)).to_pylist()
                yield piece.filter(pa.array(decide(texts), type=pa.bool_()))
        batch = piece = texts = None
        give_back()

    return bounded(df).mapInArrow(run, df.schema)


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text leaves ``fold``; an id of null counts as the empty text."""
    crc = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return (F.pmod(crc, F.lit(folds)) == fold)
