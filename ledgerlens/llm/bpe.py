"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A pre-token starts as its bytes. The leaves of a segment tree hold, for every
adjacent pair, its merge rank, and every node above the least rank of ``FAN`` nodes
below; so the root has the lowest rank, and the leftmost way down to it ends at the
next merge. A merge changes three leaves (the pair itself, the one before, the one
swallowed), each updated up to the root in logarithmic time, until the root holds
no mergeable pair. A pre-token of n bytes costs O(n log n) whatever its length; one
of up to ``FAN`` pairs is a root and its leaves, swallowed ones taken out.

Texts are cut where a space stands before a character that is no white space.
That is always a border between pre-tokens (the pattern attaches that space to
what follows), so chunks encode on their own and a memo bounded in bytes serves
the repeated ones (long chunks are not kept). Special strings split a text before that.

Defined results: null and empty texts have no ids and decode to the empty text.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import Memo, map_slices, releases

# The pre-token pattern of the tokenizer file's byte-level step.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_PAIR = 1 << 29
FAN_BITS = 5
FAN = 1 << FAN_BITS
MEMO_BYTES = 256 << 20
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next free one from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class ByteBpe:
    """A byte-level BPE read from a tokenizer file (JSON with vocabulary, merges and special strings)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes = {i: bytes(map(byte_of.__getitem__, t)) for t, i in vocab.items()}
        self.token_bytes.update({i: t.encode() for t, i in self.specials.items()})
        self.byte_ids = [vocab[c] for c in byte_alphabet()]
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a] << 20 | vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.words = regex.compile(PATTERN)
        longest_first = sorted(self.specials, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None

    def merge(self, word: bytes) -> list[int]:
        """The ids of one pre-token."""
        sym = [*map(self.byte_ids.__getitem__, word)]
        n, rank_of, made = len(sym), self.ranks.get, self.made
        if n < 2:
            return sym
        leaves = [rank_of(left << 20 | right, NO_PAIR) for left, right in zip(sym, sym[1:])]
        if n <= FAN + 1:  # the leaves and a root
            while (rank := min(leaves)) != NO_PAIR:
                i = leaves.index(rank)
                new = sym[i] = made[rank]
                del sym[i + 1]
                if i:
                    leaves[i - 1] = rank_of(sym[i - 1] << 20 | new, NO_PAIR)
                if i + 1 < len(leaves):
                    leaves[i] = rank_of(new << 20 | sym[i + 1], NO_PAIR)
                    del leaves[i + 1]
                elif i:
                    del leaves[i]
                else:
                    break
            return sym
        levels = [leaves]
        while len(levels[-1]) > FAN:
            below = levels[-1]
            levels.append([min(below[a:a + FAN]) for a in range(0, len(below), FAN)])
        top, lower = levels[-1], levels[-2::-1]
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        while (rank := min(top)) != NO_PAIR:
            i = top.index(rank)
            for level in lower:
                i = level.index(rank, i << FAN_BITS)
            j = after[i]
            k = after[j]
            new = sym[i] = made[rank]
            sym[j] = -1
            after[i] = k
            if k < n:
                before[k] = i
                leaves[i] = rank_of(new << 20 | sym[k], NO_PAIR)
                leaves[j] = NO_PAIR
            else:
                leaves[i] = NO_PAIR
            h = before[i]
            if h >= 0:
                leaves[h] = rank_of(sym[h] << 20 | new, NO_PAIR)
                self._lift(levels, h)
            self._lift(levels, i)
            if k < n:
                self._lift(levels, j)
        return [s for s in sym if s >= 0]

    @staticmethod
    def _lift(levels: list[list[int]], at: int) -> None:
        """Brings the nodes above a leaf up to date, to the first that stays as it is."""
        below = levels[0]
        for level in levels[1:]:
            at >>= FAN_BITS
            least = min(below[at << FAN_BITS:(at + 1) << FAN_BITS])
            if level[at] == least:
                return
            level[at] = least
            below = level

    def pre_tokens(self, chunk: str) -> list[str]:
        """The pre-tokens of a chunk without special strings.

        A space, letters and closing ASCII marks are told without the pattern:
        the space and letters are one pre-token, the marks another.
        """
        body = chunk.rstrip(MARKS)
        if (body[1:] if body[:1] == " " else body).isalpha():
            return [body] if len(body) == len(chunk) else [body, chunk[len(body):]]
        return self.words.findall(chunk)

    def chunk_ids(self, chunk: str) -> list[int]:
        """The ids of a chunk without special strings."""
        return list(chain.from_iterable([self.merge(w.encode()) for w in self.pre_tokens(chunk)]))

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text."""
        out: list[int] = []
        for part in self.parts(text):
            if part in self.specials:
                out.append(self.specials[part])
            else:
                for chunk in cut(part):
                    out += self.chunk_ids(chunk)
        return out

    def parts(self, text: str) -> list[str]:
        """The text split at special strings, which stand as parts of their own; empty parts left out."""
        if self.special is None or not any(s in text for s in self.specials):
            return [text] if text else []
        return [p for p in self.special.split(text) if p]

    def decode(self, ids) -> str:
        """The text of ids, special strings included; byte sequences that are no UTF-8 become U+FFFD."""
        return b"".join([self.token_bytes[i] for i in ids]).decode("utf-8", "replace")


ODD_SPACE = re.compile(r" (?=\s|\Z)")
BORDER = re.compile(r" (?=\S)")


def cut(text: str) -> list[str]:
    """A text in chunks, each but the first with its leading space; no pre-token crosses a border."""
    if ODD_SPACE.search(text) is None:
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + r for r in rest]
    borders = [m.start() for m in BORDER.finditer(text)]
    return [c for a, b in zip([0, *borders], [*borders, len(text)]) if (c := text[a:b])]


@lru_cache(maxsize=1)
def load(path: str) -> ByteBpe:
    """The tokenizer at ``path``, read once by each Python worker."""
    return ByteBpe(path)


@lru_cache(maxsize=1)
def _decimals(path: str) -> dict[int, str]:
    return {i: str(i) for i in load(path).token_bytes}


@lru_cache(maxsize=1)
def _chunk_texts(path: str) -> Memo:
    """Ids in decimal by chunk; pre-tokens stand beside the chunks, for each is a chunk of its own."""
    bpe, decimal = load(path), _decimals(path).__getitem__

    def text(chunk: str) -> str:
        words = bpe.pre_tokens(chunk)
        if len(words) == 1:
            return ",".join(map(decimal, bpe.merge(chunk.encode())))
        return ",".join(map(memo.__getitem__, words))

    memo = Memo(text, MEMO_BYTES)
    return memo


@lru_cache(maxsize=1)
def _bytes_by_text(path: str) -> dict[str, bytes]:
    decimals = _decimals(path)
    return {decimals[i]: b for i, b in load(path).token_bytes.items()}


def _release() -> None:
    for kept in (load, _decimals, _chunk_texts, _bytes_by_text):
        kept.cache_clear()


releases("bpe", _release)


def encode_text(path: str, text: str | None) -> str:
    """The ids of a text in decimal, joined by commas."""
    bpe, chunk_text = load(path), _chunk_texts(path)
    out: list[str] = []
    for part in bpe.parts(text or ""):
        if part in bpe.specials:
            out.append(str(bpe.specials[part]))
        else:
            out += map(chunk_text.__getitem__, cut(part))
    return ",".join(out)


def decode_text(path: str, ids_text: str) -> str:
    """The text of ids given in decimal, joined by commas."""
    if not ids_text:
        return ""
    return b"".join(map(_bytes_by_text(path).__getitem__, ids_text.split(","))).decode("utf-8", "replace")


def encode_decode(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, the token ids as an array and the text decoded from them."""
    def run(piece):
        ids = [encode_text(path, t) for t in piece.column(1).to_pylist()]
        lists = [[int(i) for i in s.split(",")] if s else [] for s in ids]
        return {"id": piece.column(0), "token_ids": pa.array(lists, type=pa.list_(pa.int32())),
                "decoded": [decode_text(path, s) for s in ids]}

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_slices(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, token_ids array<int>, decoded string",
                      owner="bpe").withColumnRenamed("id", id_col)


def round_trip_digests(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_tokens``, the SHA-256 of the ids (decimal, joined by commas) and of the decoded text."""
    def run(piece):
        n, ids_sha, text_sha = [], [], []
        for t in piece.column(1).to_pylist():
            ids = encode_text(path, t)
            n.append(ids.count(",") + 1 if ids else 0)
            ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
            text_sha.append(hashlib.sha256(decode_text(path, ids).encode()).hexdigest())
        return {"id": piece.column(0), "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": text_sha}

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_slices(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, "
                      "decoded_sha256 string", owner="bpe").withColumnRenamed("id", id_col)
