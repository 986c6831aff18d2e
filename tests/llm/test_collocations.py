import random
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import collocations as co


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n-\r]", low)]


def plain(rows, least=100, longest=5, top=2000):
    """Every phrase counted in a dictionary, every candidate against every longer one."""
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        scored = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in candidates.items()):
                continue
            score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = ["of", "Of", "the", "new", "york", "city", "Ü", "ü", "a\x0bb", "x", "漢字", "\x01", "it's"]
    marks = [" ", " ", "  ", "\t", ", ", ". ", "\n", "! ", ": "]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words[:rng.choice([3, 6, 13])]) + rng.choice(marks) for _ in range(rng.randint(0, 40)))
        rows.append((text + "New York City hall " * rng.randint(0, 3), rng.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", "fr"), ("of " * 300, "en")]


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, phrase string, f int")
    return sorted(map(tuple, co.collocations(df, **options).collect()))


def test_equal_to_brute_force_whatever_the_shards_and_ranges(spark, monkeypatch):
    rows = corpus(1)
    want = plain(rows, least=4)
    assert len(want) > 40 and {w[0] for w in want} >= {"en", "de", "und"}
    assert run(spark, rows, least=4) == want
    monkeypatch.setattr(co, "RANGE_WORDS", 150)
    monkeypatch.setattr(co, "SHARD_WORDS", 90)
    monkeypatch.setattr(co, "LOOKUP_ROWS", 20)
    assert run(spark, rows, least=4) == want
    assert run(spark, rows, least=4, top=3) == plain(rows, least=4, top=3)


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    rows = corpus(2, 60)
    monkeypatch.setattr(co, "FILTER_BITS", 1 << 10)
    monkeypatch.setattr(co.PairFilter, "has", lambda self, keys: np.ones(len(keys), dtype=bool))
    assert run(spark, rows, least=3) == plain(rows, least=3)


def test_empty_and_rare(spark, no_docs):
    assert co.collocations(no_docs).collect() == []
    assert run(spark, [("a b", "en")], least=2) == [] == run(spark, [(None, None), (" ,", "x")], least=1)


def test_products_beyond_64_bits(spark):
    rows = [("a b, " * 3000 + "c " * 40_000, "en")] * 40
    assert run(spark, rows) == plain(rows)


GRAMS = st.dictionaries(st.lists(st.integers(0, 3), min_size=1, max_size=4).map(tuple), st.integers(1, 3), max_size=25)
WORDS = [b"a", b"b", b"c", b"d"]


def made_of(grams, words, **options):
    return co.build(co.padded(sorted(grams)), np.array([grams[g] for g in sorted(grams)], dtype=np.int64), words, **options)


def prefix_sums(tables):
    sums = Counter()
    for grams in tables:
        for g, w in grams.items():
            for k in range(len(g) + 1):
                sums[g[:k]] += w
    return sums


@settings(max_examples=150, deadline=None)
@given(st.lists(GRAMS, min_size=1, max_size=4), st.integers(1, 6))
def test_union_sums_weights_by_prefix(tables, least):
    made = [co.Transducer.from_bytes(made_of(g, WORDS).to_bytes()) for g in tables]
    want = prefix_sums(tables)
    got = {p: w for p, _, w in co.union(made, [], least, 0)}
    named = {b" ".join(WORDS[i] for i in g): w for g, w in want.items() if w >= least}
    assert got == named | {b"": want[()]}
    limit = (b"b", b"c", b"a")
    at_limit = {p for p, _, _ in co.union(made, [limit], 10**9, 1)}
    assert at_limit == {b" ".join(limit[:k]) for k in (1, 2, 3) if want[tuple(WORDS.index(w) for w in limit[:k])]}


def test_equal_right_sides_are_one_state():
    grams = [(a, b, 3) for a in range(3) for b in range(3)]
    t = made_of(dict.fromkeys(grams, 1), WORDS)
    assert len(t.first) - 1 == 4 and len(t.arcs) == 3 + 3 + 1  # the end, a last word, a middle, the root


@settings(max_examples=100, deadline=None)
@given(GRAMS, st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=4).map(tuple), max_size=12))
def test_composition_looks_up(grams, wanted):
    names = [*WORDS, b"e"]
    counts = made_of(grams, names, rolled=False)
    requests = sorted({tuple(names[i] for i in g) for g in [*wanted, *grams]})
    by_name = {tuple(names[i] for i in g): w for g, w in grams.items()}
    assert co.compose(requests, counts) == [by_name.get(r, 0) for r in requests]


def test_pair_filter_holds_all_of_its_own(spark):
    pairs = [("en", f"w{i} v{i % 7}") for i in range(3000)]
    f = co.pair_filter(spark.createDataFrame(pairs, "lang string, phrase string"))
    assert f.has([f"{a} {b}".encode() for a, b in pairs]).all()
    assert f.has([b"en no%d way" % i for i in range(3000)]).mean() < 0.05
