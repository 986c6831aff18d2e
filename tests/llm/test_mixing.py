import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.llm import mixing
from ledgerlens.llm.queries import op11_source_mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight; what is above the limit is taken off and shared among the others, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped, left = {}, dict(weight)
    while left:
        share = (sum(sizes.values()) - sum(stopped.values())) / sum(left.values())
        above = [s for s in left if share * left[s] > most * sizes[s]]
        if not above:
            return stopped | {s: share * w for s, w in left.items()}
        for s in above:
            stopped[s] = most * sizes[s]
            del left[s]
    return stopped


@pytest.mark.parametrize("seed", range(3))
def test_targets_equal_rounds_of_resharing(spark, seed):
    import random

    rng = random.Random(seed)
    sizes = {f"s{chr(0xE000 + i) if i % 4 else i}{i}": rng.choice([0, 1, 5, 40, 3000, 10**6]) for i in range(30)}
    sizes |= {None: 70, "": 10**5, "\U0001F600": 9}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(5)
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def check(rows, docs):
    """The laws of the result: sizes, targets, near the target, no row above three times its size."""
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len(WORD.findall(text or ""))
    target = plain_targets(dict(sizes)) if sum(sizes.values()) else dict.fromkeys(sizes, 0)
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = defaultdict(list)
    for d, text, source in docs:
        want[d].append((len(WORD.findall(text or "")), sizes[source], pytest.approx(target[source])))
    assert {d: len(v) for d, v in by_doc.items()} == {d: len(v) for d, v in want.items()}
    for d, v in want.items():
        got = sorted((r["size"], r["source_size"], r["target"]) for r in by_doc[d])
        assert got == sorted(v, key=lambda x: (x[0], x[1]))
    return sizes, target


def test_query_meets_its_targets(spark, sf):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = op11_source_mixing(spark, sf).collect()
    _, target = check(rows, docs)
    source = {d: s for d, _, s in docs}
    taken = defaultdict(int)
    for r in rows:
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - t) <= 0.5 for s, t in target.items())
    again = mixing.taken(spark.read.parquet(f"{sf}/documents.parquet").repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_mix_equals_a_plain_walk_over_the_words(spark):
    docs = [(i, "w " * ((i * 37) % 91), "abc"[i % 3]) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    placed, sources = mixing.layout(mixing.sizes(df), block=16)
    slots = [r.asDict() for r in mixing.slots(sources, block=16, shard_blocks=8).collect()]
    info = {r["at"]: r for r in sources.collect()}
    words = {a: [None] * r["source_size"] for a, r in info.items()}
    for r in placed.collect():
        for k in range(r["size"]):
            assert words[r["source_at"]][r["start"] + k] is None
            words[r["source_at"]][r["start"] + k] = r["id"]
    want, uses = defaultdict(int), defaultdict(int)
    for s in slots:
        block = words[s["source_at"]][16 * s["block"]:16 * s["block"] + s["words"]]
        assert len(block) == s["words"] > 0
        uses[s["source_at"], s["block"]] += 1
        for d in block:
            want[d] += 1
    for a, r in info.items():
        own = sorted(s["slot"] for s in slots if s["source_at"] == a)
        assert own == list(range(len(own)))
        assert sum(s["words"] for s in slots if s["source_at"] == a) == r["take"] == round(r["target"])
        counts = [uses[a, b] for b in range(r["blocks"])]
        assert max(counts) - min(counts) <= 1  # whole rounds over all blocks
    got = {r["doc_id"]: r["taken"] for r in mixing.taken(df, block=16, shard_blocks=8).collect()}
    assert got == {d: want[d] for d, _, _ in docs}
    shards = defaultdict(int)
    for s in slots:
        shards[s["shard"]] += 1
    assert len(shards) > 20 and max(shards.values()) < 30
    mix = mixing.mixture(placed, sources, block=16, shard_blocks=8).collect()
    assert sum(r["n_words"] for r in mix) == sum(want.values())
    size = {r["id"]: r["size"] for r in placed.collect()}
    assert all(0 <= r["from_word"] and r["from_word"] + r["n_words"] <= size[r["id"]] for r in mix)


def test_edge_rows(spark, edge_docs, no_docs):
    docs = edge_docs.withColumn("source", F.when(F.col("doc_id") % 2 == 0, "s"))
    rows = mixing.taken(docs).collect()
    check(rows, [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])
    assert mixing.taken(no_docs.withColumn("source", F.lit("x"))).collect() == []
    empty = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r["size"], r["source_size"], r["target"], r["taken"]) for r in mixing.taken(empty).collect()] == [(0, 0, 0.0, 0)] * 3


def test_repeated_rows_have_places_of_their_own(spark):
    docs = [(5, "a b c d e", "x")] * 2000 + [(i, "u v w", "y") for i in range(100, 200)]
    rows = mixing.taken(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    check(rows, docs)
    total = sum(r["taken"] for r in rows if r["doc_id"] == 5)
    assert abs(total - plain_targets({"x": 10_000, "y": 300})["x"]) <= 0.5


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=" \t\n\r\x0b\x0c\x1c\x85 ab　", max_size=30))
def test_word_pattern(text):
    assert len(WORD.findall(text)) == len(text.encode().split())
