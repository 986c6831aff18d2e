"""Token counts with a whole-token shortcut.

Offline, every vocabulary string is put through the tokenizer on its own: those
that the pre-token pattern keeps whole and that merge to one token are proven
single. In a text, a pre-token that is such a string counts one without any
merge; only the rest are merged. The proof depends on the vocabulary alone, so
it is a bitmap of one bit per id that tasks receive.

Defined results: null and empty texts have 0 bytes and 0 tokens.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import Memo, map_slices, releases
from ledgerlens.llm.bpe import ByteBpe, cut, load

MEMO_BYTES = 120 << 20


def prove_single(bpe: ByteBpe) -> bytes:
    """A bitmap by id: set where the vocabulary string, alone, is one pre-token and one token."""
    bits = bytearray(max(bpe.token_bytes) // 8 + 1)
    for i, raw in bpe.token_bytes.items():
        try:
            word = raw.decode()
        except UnicodeDecodeError:
            continue  # no text holds it as a pre-token
        if word not in bpe.specials and bpe.words.findall(word) == [word] and bpe.merge(raw) == [i]:
            bits[i >> 3] |= 1 << (i & 7)
    return bytes(bits)


class TokenCounter:
    """Counts tokens: proven strings directly, other pre-tokens by merging, both behind bounded memos."""

    def __init__(self, bpe: ByteBpe, single: bytes):
        self.bpe = bpe
        self.single = {raw.decode() for i, raw in bpe.token_bytes.items() if single[i >> 3] >> (i & 7) & 1}
        self.merged = Memo(lambda w: len(bpe.merge(w.encode())), MEMO_BYTES)
        self.chunks = Memo(self._chunk, MEMO_BYTES)

    def _chunk(self, chunk: str) -> int:
        single, merged = self.single, self.merged
        return sum([1 if w in single else merged[w] for w in self.bpe.pre_tokens(chunk)])

    def count(self, text: str | None) -> int:
        total = 0
        for part in self.bpe.parts(text or ""):
            total += 1 if part in self.bpe.specials else sum(map(self.chunks.__getitem__, cut(part)))
        return total


@lru_cache(maxsize=1)
def _counter(path: str, single: bytes) -> TokenCounter:
    return TokenCounter(load(path), single)


releases("token_count", _counter.cache_clear)


def count_tokens(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_bytes`` of the text in UTF-8 and ``n_tokens``."""
    single = prove_single(load(path))

    def run(piece):
        counter = _counter(path, single)
        return {"id": piece.column(0), "n_bytes": piece.column(2),
                "n_tokens": [counter.count(t) for t in piece.column(1).to_pylist()]}

    text = F.col(text_col).cast("string")
    rows = df.select(F.col(id_col).alias("id"), text.alias("text"),
                     F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    return map_slices(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long",
                      owner="token_count").withColumnRenamed("id", id_col)
