import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import periodic_runs
from ledgerlens.llm.queries import op12_periodic_runs, planted_period


def plain_runs(words, min_length=24, min_periods=3):
    """Every period on its own: stretches on which words one period apart agree; of equal stretches the least period."""
    found, n = {}, len(words)
    for p in range(1, n // min_periods + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(min_length, min_periods * p):
                stretch = words[i:j + p]
                if not any(stretch[q:] == stretch[:-q] for q in range(1, p)):
                    found[i, j - i + p] = p
            i = j + 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=9),
                                   st.integers(1, 14)), max_size=5), min_size=1, max_size=4),
       st.sampled_from([(24, 3), (4, 2), (6, 3), (1, 2)]))
def test_runs_equal_every_period_tried(parts, limits):
    texts = [[w for base, n in text for w in base * n] for text in parts]
    got = periodic_runs.find_runs(texts, min_length=limits[0], min_periods=limits[1])
    assert got == [plain_runs(t, *limits) for t in texts]


def test_fibonacci_word_and_long_runs():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 3000:
        a, b = b, b + a
    same = [b"x"] * 30_000
    got = periodic_runs.find_runs([b[:800], same, [], [b"y"]])
    assert got[0] == plain_runs(b[:800]) and got[0]
    assert got[1:] == [[(0, 30_000, 1)], [], []]


def test_places_keep_order_and_neighbours():
    rng = random.Random(2)
    order = rng.sample(range(5000), 5000)
    places, held = periodic_runs.Places(order[0]), [order[0]]
    for p in order[1:]:
        before, after = places.add(p)
        held.append(p)
    held.sort()
    assert list(places) == held and max(map(len, places.chunks)) <= 2 * periodic_runs.CHUNK
    assert places.add(5000) == (4999, -1) and places.add(-5)[0] == -1


def expected(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else None
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_query_equals_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()
            if len((r.text or "").split()) < 700]
    got = {r[0]: tuple(r) for r in op12_periodic_runs(spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    want = {d: expected(d, t) for d, t in docs}
    assert {d: got[d] for d in want} == want
    assert sum(w[1] > 0 for w in want.values()) >= 5


def test_edge_rows(spark, edge_docs, no_docs):
    got = sorted(map(tuple, periodic_runs.run_digests(edge_docs, prepare=planted_period).collect()), key=str)
    want = sorted((expected(r.doc_id, r.text) for r in edge_docs.collect() if r.doc_id != 7), key=str)
    assert [g for g in got if g[0] != 7] == want
    assert [g[1:5] for g in got if g[0] == 7] == [(1, 0, 9000, 1)]
    assert [g[1] for g in got if g[0] is None] == [0, 0]
    assert periodic_runs.run_digests(no_docs).collect() == []


def test_collapsed_text(spark):
    text = "start " + "one two three " * 10 + "end"
    row = periodic_runs.collapse(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 30, 3)] and row["collapsed"] == "start one two three end"


def test_batches_do_not_matter(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [[b"%d" % x for x in rng.integers(0, 3, 60)] + [b"r", b"s"] * n for n in range(0, 30)]
    assert periodic_runs.find_runs(texts) == [periodic_runs.find_runs([t])[0] for t in texts]
