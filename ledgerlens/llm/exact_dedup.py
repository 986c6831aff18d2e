"""Exact dedup with Patricia-trie owners.

Texts are normalised (each run of white space becomes one space), and a text's
partition follows from its length and content hash, so equal texts meet in one
partition. There the full byte strings go into a compressed radix trie; the node
where a text ends stores the smallest identifier, how many rows hold it and how
many rows the text has in all. Before the shuffle each task does the same with
its own rows, so a group of copies sends one row per task, whatever its size.

A trie holds at most ``TRIE_BYTES`` of keys. Beyond that its largest subtree is
spilled: before the shuffle it is simply sent on (what is merged later stays
right); after it, the subtree's entries go to an unnamed scratch file of the
task, later texts below the same prefix follow them there, and each file is
merged by itself at the end, with subtrees spilled again if need be.

Decisions return to the rows by length, content hash and SHA-256 of the text.

Defined results: null texts count as empty; the smallest identifier ignores
nulls (null if a group has none else); of rows that repeat both identifier and
text exactly one is kept; empty tables give no rows.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import bounded, claim, give_back, slices
from ledgerlens.llm.components import cut_lineage, one_row_each

TRIE_BYTES = 96 * 1024 * 1024
NODE_BYTES = 200
OWNERS = "n_bytes long, hash long, sha string, keep_id long, keep_rows long, rows long"
PARTIAL = "n_bytes long, hash long, norm binary, keep_id long, keep_rows long, rows long"


def normalised(text: Column) -> Column:
    """Each run of the six ASCII white space characters as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def merged(a: tuple, b: tuple) -> tuple:
    """Owner entries (smallest id or None, rows holding it, rows) of the same text, joined."""
    if a[0] == b[0]:
        return a[0], a[1] + b[1], a[2] + b[2]
    least = b if a[0] is None or (b[0] is not None and b[0] < a[0]) else a
    return least[0], least[1], a[2] + b[2]


class Node:
    """``edge``: the bytes from the parent. ``owner``: set where a text ends. ``spill``: file of the subtree."""

    __slots__ = ("edge", "kids", "owner", "spill")

    def __init__(self, edge: bytes, owner: tuple | None = None):
        self.edge, self.kids, self.owner, self.spill = edge, {}, owner, None


def common(a: bytes, b: bytes) -> int:
    """How many leading bytes two strings share, by bisection over slices."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class PatriciaOwners:
    """A compressed radix trie from byte strings to owner entries within a budget of bytes.

    ``send``: called with (key, owner) of spilled entries; without it subtrees
    go to scratch files.
    """

    def __init__(self, budget: int = TRIE_BYTES, send=None):
        self.root, self.budget, self.send, self.held = Node(b""), budget, send, 0

    def add(self, key: bytes, owner: tuple) -> None:
        node, rest = self.root, key
        while True:
            if node.spill is not None:
                pickle.dump((rest, owner), node.spill)
                return
            if not rest:
                node.owner = owner if node.owner is None else merged(node.owner, owner)
                return
            kid = node.kids.get(rest[0])
            if kid is None:
                node.kids[rest[0]] = Node(rest, owner)
                self.held += len(rest) + NODE_BYTES
                break
            edge = kid.edge
            if rest.startswith(edge):
                node, rest = kid, rest[len(edge):]
                continue
            n = common(edge, rest)
            fork = Node(edge[:n])
            kid.edge = edge[n:]
            fork.kids[kid.edge[0]] = kid
            node.kids[rest[0]] = fork
            self.held += NODE_BYTES
            node, rest = fork, rest[n:]
        if self.held > self.budget:
            self.spill_largest()

    def spill_largest(self) -> None:
        """Moves out the heaviest child of the first fork, or deeper while one child holds half of it."""
        path, node, forked, held = b"", self.root, False, self.held
        while live := [k for k in node.kids.values() if k.spill is None]:
            weight, kid = max(((self._weight(k), k) for k in live), key=lambda x: x[0])
            if forked and weight * 2 < held:
                break
            forked = forked or len(node.kids) > 1
            path, node, held = path + kid.edge, kid, weight
        freed = self._weight(node)
        entries = self._walk(self._cut_off(node), b"")
        if self.send is not None:
            for rest, owner in entries:
                self.send(path + rest, owner)
        else:
            file = tempfile.TemporaryFile()
            for entry in entries:
                pickle.dump(entry, file)
            node.spill = file
        self.held -= max(0, freed - len(node.edge) - NODE_BYTES)

    @staticmethod
    def _cut_off(node: Node) -> Node:
        """What ends at or hangs below a node, which is bare after that."""
        top = Node(b"", node.owner)
        top.kids, top.spill, node.kids, node.owner, node.spill = node.kids, node.spill, {}, None, None
        return top

    def _weight(self, top: Node) -> int:
        total, todo = 0, [top]
        while todo:
            node = todo.pop()
            total += len(node.edge) + NODE_BYTES
            todo += node.kids.values()
        return total

    @staticmethod
    def _walk(top: Node, prefix: bytes, files: list | None = None) -> Iterator[tuple[bytes, tuple]]:
        """The entries of a subtree that was cut off, which ends with that: its nodes go one by one.

        Older spills move along, or are put into ``files`` with their paths.
        """
        todo = [(top, prefix)]
        del top
        while todo:
            node, path = todo.pop()
            path += node.edge
            if node.spill is not None:
                if files is not None:
                    files.append((path, node.spill))
                    continue
                yield from ((path + rest, owner) for rest, owner in _replay(node.spill))
            if node.owner is not None:
                yield path, node.owner
            todo += [(kid, path) for kid in node.kids.values()]

    def entries(self) -> Iterator[tuple[bytes, tuple]]:
        """All (key, owner), spilled subtrees last and one by one; the trie is empty after that."""
        files: list[tuple] = []
        yield from self._walk(self._cut_off(self.root), b"", files)
        self.held = 0
        for path, file in files:
            part = PatriciaOwners(self.budget)
            for rest, owner in _replay(file):
                part.add(rest, owner)
            for rest, owner in part.entries():
                yield path + rest, owner


def _replay(file) -> Iterator[tuple[bytes, tuple]]:
    """The entries of a scratch file, which ends with that."""
    file.seek(0)
    with file:
        while True:
            try:
                entry = pickle.load(file)
            except EOFError:
                return
            yield entry


def _emit(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=names)


def _batched(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], limit: int = 4 << 20):
    """Record batches of about ``limit`` bytes of keys each."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, bytes))
        if size >= limit:
            yield _emit(held, names, types)
            held, size = [], 0
    if held:
        yield _emit(held, names, types)


def owners(rows: DataFrame) -> DataFrame:
    """Per distinct text of ``rows`` (id, n_bytes, hash, norm): its owner entry, see ``OWNERS``."""
    i64, names = pa.int64(), ["n_bytes", "hash", "norm", "keep_id", "keep_rows", "rows"]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("exact_dedup")
        sent: list[tuple] = []
        trie = PatriciaOwners(send=lambda key, owner: sent.append((key, owner)))

        def row(key: bytes, owner: tuple) -> tuple:
            return int.from_bytes(key[:8], "big"), int.from_bytes(key[8:16], "big", signed=True), key[16:], *owner

        for batch in batches:
            for piece in slices(batch):
                ids, sizes, hashes, norms = (c.to_pylist() for c in piece.columns)
                for i, n, h, norm in zip(ids, sizes, hashes, norms):
                    trie.add(n.to_bytes(8, "big") + h.to_bytes(8, "big", signed=True) + norm, (i, 1, 1))
                if sent:
                    yield from _batched((row(*x) for x in sent), names, [i64, i64, pa.binary(), i64, i64, i64])
                    sent.clear()
        batch = piece = norms = norm = None
        yield from _batched((row(*x) for x in trie.entries()), names, [i64, i64, pa.binary(), i64, i64, i64])
        give_back()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        claim("exact_dedup")
        trie = PatriciaOwners()
        for batch in batches:
            for piece in slices(batch):
                sizes, hashes, norms, *owner = (c.to_pylist() for c in piece.columns)
                for n, h, norm, *own in zip(sizes, hashes, norms, *owner):
                    trie.add(n.to_bytes(8, "big") + h.to_bytes(8, "big", signed=True) + norm, tuple(own))
        batch = piece = norms = norm = None
        yield from _batched(
            ((int.from_bytes(k[:8], "big"), int.from_bytes(k[8:16], "big", signed=True),
              hashlib.sha256(k[16:]).hexdigest(), *o) for k, o in trie.entries()),
            ["n_bytes", "hash", "sha", "keep_id", "keep_rows", "rows"], [i64, i64, pa.string(), i64, i64, i64])
        give_back()

    partial = bounded(rows).mapInArrow(local, PARTIAL)
    return partial.repartition("n_bytes", "hash").mapInArrow(meet, OWNERS)


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = normalised(F.col(text_col).cast("string"))
    return df.select(F.col(id_col).cast("long").alias("id"), norm.alias("norm")).select(
        "id", F.octet_length("norm").cast("long").alias("n_bytes"), F.xxhash64("norm").alias("hash"), "norm")


def exact_groups(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of the normalised text."""
    keyed = _keyed(df, id_col, text_col)
    key = ["n_bytes", "hash", "sha"]
    table = cut_lineage(owners(keyed.select("id", "n_bytes", "hash", F.col("norm").cast("binary").alias("norm"))))
    rows = cut_lineage(keyed.select("id", "n_bytes", "hash", F.sha2(F.col("norm").cast("binary"), 256).alias("sha"),
                                    F.monotonically_increasing_id().alias("at")))
    # where rows repeat the id that stays: the first of them, pre-aggregated
    first = rows.join(table.filter("keep_rows > 1"), key).filter(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy(
        *key).agg(F.min("at").alias("first"))
    out = rows.join(table.join(first, key, "left"), key, "inner")
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & ((F.col("keep_rows") == 1) | (F.col("at") == F.col("first")))
    return out.select(F.col("id").alias(id_col), "keep_id", F.col("rows").alias("group_size"),
                      F.coalesce(kept, F.lit(False)).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, all columns unchanged: of equal texts the row with the smallest id."""
    groups = exact_groups(df, id_col=id_col, text_col=text_col)
    keep = groups.groupBy(F.col(id_col).alias("id"), F.col("text_sha256").alias("key")).agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")).filter("kept").select("id", "key", "rows")
    sha = F.sha2(normalised(F.col(text_col).cast("string")).cast("binary"), 256)
    return one_row_each(df, F.col(id_col).cast("long"), sha, keep)
