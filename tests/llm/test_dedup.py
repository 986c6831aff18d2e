import hashlib
import re
import tracemalloc
from collections import defaultdict

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.llm import batches, exact_dedup, simhash
from ledgerlens.llm.components import components
from ledgerlens.llm.queries import op4_exact_dedup, op8_simhash_near_dedup


def norm(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def least(ids):
    return min((i for i in ids if i is not None), default=None)


def exact_by_hand(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out, seen = [], set()
    for i, t in rows:
        key = norm(t)
        first = least(groups[key])
        out.append((i, first, len(groups[key]), i == first and (i, key) not in seen,
                    hashlib.sha256(key.encode()).hexdigest()))
        seen.add((i, key))
    return sorted(out, key=str)


KEYS = st.lists(st.tuples(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), st.integers(0, 50)), max_size=60)


@settings(max_examples=200, deadline=None)
@given(KEYS, st.sampled_from([0, 700, 10**9]))
def test_trie_equals_a_dictionary_also_when_it_spills(rows, budget):
    want = {}
    for key, i in rows:
        want[key] = exact_dedup.merged(want[key], (i, 1, 1)) if key in want else (i, 1, 1)
    trie = exact_dedup.PatriciaOwners(budget)
    for key, i in rows:
        trie.add(key, (i, 1, 1))
    got = list(trie.entries())
    assert len(got) == len(want) and dict(got) == want
    sent = []
    trie = exact_dedup.PatriciaOwners(budget, send=lambda k, o: sent.append((k, o)))
    for key, i in rows:
        trie.add(key, (i, 1, 1))
    again = {}
    for key, owner in [*sent, *trie.entries()]:
        again[key] = exact_dedup.merged(again[key], owner) if key in again else owner
    assert again == want


def test_trie_entries_hold_no_second_copy_of_the_texts():
    trie = exact_dedup.PatriciaOwners(1 << 30)
    tracemalloc.start()
    for i in range(1000):
        trie.add(hashlib.sha256(str(i).encode()).digest() + b"x" * 10_000, (i, 1, 1))
    full = tracemalloc.get_traced_memory()[0]
    tracemalloc.reset_peak()
    n = sum(1 for _ in trie.entries())
    left, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert n == 1000 and peak < full + (1 << 20) and left < full / 10


def test_batches_to_python_are_bounded_in_bytes(spark):
    import pyarrow as pa

    def sizes(frames):
        for b in frames:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    before = spark.conf.get(batches.BATCH_CONF)
    try:
        spark.conf.unset(batches.BATCH_CONF)
        df = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
        owners = exact_dedup.exact_groups(df.select(F.lit(1).alias("doc_id"), "text"))
        assert [r.group_size for r in owners.limit(1).collect()] == [4000]
        got = df.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r.n for r in got) == 4000 and max(r.size for r in got) < batches.BATCH_BYTES + 100_000
        for held, want in (("1m", "1m"), ("512k", "512k"), ("1g", f"{batches.BATCH_BYTES}b"), ("100", "100")):
            spark.conf.set(batches.BATCH_CONF, held)
            batches.bounded(df)
            assert spark.conf.get(batches.BATCH_CONF).rstrip("b") == want.rstrip("b")
    finally:
        spark.conf.set(batches.BATCH_CONF, before)


def test_exact_edge_rows(edge_docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    for budget in (exact_dedup.TRIE_BYTES, 1):
        monkeypatch.setattr(exact_dedup, "TRIE_BYTES", budget)
        got = sorted(map(tuple, exact_dedup.exact_groups(edge_docs).collect()), key=str)
        assert got == exact_by_hand(rows)


def test_exact_drop_keeps_columns_and_one_row_of_each_group(edge_docs):
    out = exact_dedup.drop_copies(edge_docs)
    assert out.columns == edge_docs.columns
    kept = [(r.doc_id, norm(r.text)) for r in out.collect()]
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert len(kept) == len({norm(t) for _, t in rows}) == len(set(kept))
    assert sorted(kept, key=str) == sorted({(x[0], norm(t)) for x, t in (
        (x, t) for i, t in rows for x in exact_by_hand(rows)
        if x[3] and x[0] == i and x[4] == hashlib.sha256(norm(t).encode()).hexdigest())}, key=str)


def test_exact_query_on_a_fixture(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, op4_exact_dedup(spark, sf).collect()), key=str) == exact_by_hand(rows)


# ---- SimHash ---------------------------------------------------------------

def fp_by_hand(text, words=3):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    s = [" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] if len(w) >= words else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_by_hand(fps, max_bits=3):
    """fps: list of (id, fingerprint). Components over all pairs."""
    nodes = sorted({f for _, f in fps})
    root = {f: f for f in nodes}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if bin(a ^ b).count("1") <= max_bits:
                root[find(b)] = find(a)
    ids = defaultdict(list)
    for i, f in fps:
        ids[find(f)].append(i)
    return {(i, f): least(ids[find(f)]) for i, f in fps}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_of_edge_rows(edge_docs):
    got = sorted(((r.id, r.fp) for r in simhash.fingerprints(edge_docs).collect()), key=str)
    assert got == sorted(((r.doc_id, signed(fp_by_hand(r.text))) for r in edge_docs.collect()), key=str)


def test_blocks_meet_the_pigeonhole_bound():
    masks = simhash.block_masks()
    assert len(masks) == 20
    for bits in ([], [0], [3, 60], [0, 30, 63], [10, 11, 40]):
        x = sum(1 << b for b in bits)
        assert any(m % (1 << 64) & x == 0 for m in masks)


def test_links_connect_like_all_pairs_also_in_crowded_keys(spark):
    import random

    rng = random.Random(3)
    fps = set()
    for _ in range(25):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            x = base
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    rows = [(i, f) for i, f in enumerate(sorted(fps))]
    want = groups_by_hand(rows)
    nodes = spark.createDataFrame([(signed(f),) for _, f in rows], "fp long")
    for cell in (1, 3, 64):
        edges = simhash.links(nodes, cell=cell)
        found = {r.node: r.root for r in components(edges).collect()}
        groups = defaultdict(set)
        for i, f in rows:
            groups[found.get(signed(f), signed(f))].add(want[i, f])
        assert all(len(g) == 1 for g in groups.values()), cell  # nothing linked that is not close
        assert len(groups) == len(set(want.values())), cell  # nothing close left apart


def test_smaller_distances(spark):
    rows = [(0, 0), (1, 1), (2, 3), (3, 0b111111), (4, 1 << 40)]
    nodes = spark.createDataFrame([(f,) for _, f in rows], "fp long")
    for bits, cell in ((0, 64), (1, 1), (2, 1)):
        found = {r.node: r.root for r in components(simhash.links(nodes, max_bits=bits, cell=cell)).collect()}
        want = groups_by_hand(rows, bits)
        assert len({found.get(f, f) for _, f in rows}) == len(set(want.values())), (bits, cell)


def test_components_of_a_path_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 200), (5, 5)]
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_groups_of_edge_rows(edge_docs):
    fps = [(r.doc_id, fp_by_hand(r.text)) for r in edge_docs.collect()]
    want = groups_by_hand(fps)
    got = simhash.near_groups(edge_docs).collect()
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in got), key=str) == sorted(
        ((i, signed(f), want[i, f]) for i, f in fps), key=str)
    kept = [r for r in got if r.kept]
    assert len(kept) == len(set(map(str, (want[x] for x in fps)))) or len(kept) == len(set(want.values()))
    out = simhash.drop_near_copies(edge_docs)
    assert out.columns == edge_docs.columns
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted((r.doc_id for r in kept), key=str)


def test_simhash_query_on_a_fixture(spark, sf):
    rows = [(r.doc_id, fp_by_hand(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = groups_by_hand(rows)
    assert sorted(map(tuple, op8_simhash_near_dedup(spark, sf).collect())) == sorted(
        (i, f"{f:016x}", want[i, f]) for i, f in rows)


def test_empty_tables(no_docs):
    assert exact_dedup.exact_groups(no_docs).count() == 0 == exact_dedup.drop_copies(no_docs).count()
    assert simhash.near_groups(no_docs).count() == 0 == simhash.drop_near_copies(no_docs).count()


def test_hot_group_of_copies(spark):
    docs = spark.range(400, numPartitions=8).select(
        (F.col("id") + 5).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("one and the same text")).otherwise(F.col("id").cast("string")).alias("text"))
    out = {r.doc_id: r for r in exact_dedup.exact_groups(docs).collect()}
    assert out[8].keep_id == 5 and out[8].group_size == 134 and not out[8].kept and out[5].kept and out[6].group_size == 1


def test_components_that_share_an_id_each_keep_a_row(spark):
    texts = {"null, one": "alpha beta gamma delta epsilon", "null, two": "seven green bottles hang on the wall",
             "id, one": "rain falls softly over the old harbour", "id, two": "prime numbers have exactly two divisors"}
    rows = [(None if name[0] == "n" else 7, t) for name, t in texts.items()]
    rows += [rows[0], rows[2], (9, rows[2][1])]  # copies, one under a larger id
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r for r in simhash.near_groups(docs).collect() if r.kept]
    assert sorted((str(r.doc_id), r.component_id) for r in kept) == [("7", 7), ("7", 7), ("None", None), ("None", None)]
    assert sorted(r.text for r in simhash.drop_near_copies(docs).collect()) == sorted(texts.values())


def test_rows_repeated_whole_are_spread_over_tasks(spark):
    """A third of the rows are one row, others repeat an id with other columns: no window over them, one of each stays."""
    docs = spark.range(9000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 3000).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "the same text again and again").otherwise(
            F.concat(F.lit("text of many other words number "), (F.col("id") % 3000).cast("string"))).alias("text"),
        (F.col("id") % 2).alias("extra"))
    for groups, drop in ((exact_dedup.exact_groups, exact_dedup.drop_copies), (simhash.near_groups, simhash.drop_near_copies)):
        table = groups(docs)
        assert "Window" not in table._jdf.queryExecution().executedPlan().toString()
        kept = table.filter("kept")
        left = drop(docs)
        assert "Window" not in left._jdf.queryExecution().executedPlan().toString()
        assert left.columns == docs.columns and left.count() == kept.count()
        assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r.doc_id) for r in kept.collect())
    assert exact_dedup.drop_copies(docs).count() == 2001


def test_crowded_keys_are_cut_by_a_group_limit(spark):
    plan = simhash.links(spark.range(10).select(F.col("id").alias("fp")))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
