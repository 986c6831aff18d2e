import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import packing
from ledgerlens.llm.queries import op10_packing

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, docs, window):
    """Every id in exactly one piece, sequences gapless and not overfull."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(docs)
    for i, own in pieces.items():
        ids, at = docs[i], 0
        copies = sum(r.length for r in own) // len(ids)
        for r in sorted(own, key=lambda r: r.start):
            part = np.array(ids[r.start:r.start + r.length], dtype="<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part) and r.doc_tokens == len(ids) and r.length > 0
        covered = sorted(x for r in own for x in range(r.start, r.start + r.length))
        assert covered == sorted([*range(len(ids))] * copies), at
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    assert sorted(sequences) == list(range(len(sequences)))
    return sequences


def test_query_on_a_fixture(spark, sf):
    docs = {r.doc_id: ids_of(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sequences = check(op10_packing(spark, sf).collect(), docs, 2048)
    total = sum(map(len, docs.values()))
    assert total / (2048 * len(sequences)) > 0.97


@pytest.mark.parametrize("window,grid,parts,by_word", [(2048, 16, 3, True), (64, 1, 4, False), (64, 64, 2, True)])
def test_edge_rows(edge_docs, window, grid, parts, by_word):
    docs = edge_docs.filter("doc_id is not null")
    want = {r.doc_id: ids_of(r.text) for r in docs.collect()}
    packed = packing.pack(docs, PATH, window=window, grid=grid, parts=parts, by_word=by_word)
    check(packed.collect(), want, window)


def test_rows_without_id_are_packed(edge_docs):
    n = sum(len(ids_of(r.text)) for r in edge_docs.collect())
    assert packing.pack(edge_docs, PATH).agg(F.sum("length")).first()[0] == n


def test_empty_table(no_docs):
    assert packing.pack(no_docs, PATH).count() == 0


def test_ids_are_read_for_divided_rests_alone(spark):
    docs = spark.range(0, 300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") * 17).cast("int")).alias("text"))
    df = packing.pack(docs, PATH)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "isnull(ids" not in plan and "isnotnull(ids" not in plan
    scans = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in x]
    assert sum("ids:binary" in x for x in scans) == 1 < len(scans)
    check(df.collect(), {r.doc_id: ids_of(r.text) for r in docs.collect()}, 2048)


def test_plain_is_told_alike_for_ascii_texts():
    encoder = packing._encoder(PATH, True)
    for c in map(chr, range(128)):
        assert encoder.is_plain(f"a{c}b") == packing.plain(c)
    assert not any(encoder.is_plain(f"a {s} b") for s in encoder.specials)


def test_one_common_length(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("word " * 699).alias("text"))
    sequences = check(packing.pack(docs, PATH).collect(), {i: ids_of("word " * 699) for i in range(300)}, 2048)
    assert len(sequences) <= -(-300 * 700 // 2048) + 1


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(
    ["The", " ", "İ", "ß", "Σ", "ς", "́", "e", " ", "\x1c", "\x85", " ", "\n", "'S", "'s", "12", "²", "😀",
     "<|endoftext|>", "<|startoftext|>", "...", "漢"]), max_size=14).map("".join)))
def test_chunks_give_the_library_ids(text):
    got = packing._encoder(PATH, True).encode(text)
    assert np.frombuffer(got, dtype="<u4").tolist() == ids_of(text)[:-1]


def test_every_letter_before_marks_has_the_library_ids():
    encoder, lib = packing._encoder(PATH, True), packing._encoder(PATH, True).tokenizer
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isprintable() and c > 32]
    texts = [f"a{c}?. {c}! ba{c}b..." for c in chars]
    for at in range(0, len(texts), 4096):
        some = texts[at:at + 4096]
        for text, e in zip(some, lib.encode_batch_fast(some, add_special_tokens=False)):
            assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == e.ids, repr(text)


def test_upper_case_texts_of_all_kinds():
    for text in ["KED\u0130, EVDEK\u0130. SONRA GELD\u0130!", "\u0915\u095c\u0964 \u0958?", "\u039f\u0394\u039f\u03a3. \u03a3", "\u1112\u1161\u11ab?",
                 "it's WE'LL 'S '\u017f", "a\u00b2 \u0661\u0662 x", "e\u0301! E\u0301"]:
        got = packing._encoder(PATH, True).encode(text)
        assert np.frombuffer(got, dtype="<u4").tolist() == ids_of(text)[:-1], text


def test_memo_is_bounded_in_bytes():
    from ledgerlens.llm.batches import ENTRY_BYTES, LONG_KEY, Memo

    memo = Memo(lambda k: b"x" * 100, 50_000)
    for i in range(1000):
        memo[f"{i}"]
        assert sum(ENTRY_BYTES + len(k) + len(v) for k, v in memo.items()) <= 50_000
    memo["y" * (LONG_KEY + 1)]
    assert max(map(len, memo)) <= LONG_KEY


def test_combinations():
    got = packing.combinations(8, 3)
    assert sorted(got) == sorted({tuple(sorted((a, b, c), reverse=True)[:3 - (a, b, c).count(0)]) for a in range(9)
                                  for b in range(9) for c in range(9) if a + b + c == 8})


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6))
def test_nnls_meets_the_optimality_conditions(seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 3, (6, 15)).astype(float), rng.uniform(0, 5, 6)
    x = packing.nnls(a, b)
    gain = a.T @ (b - a @ x)
    assert (x >= 0).all() and gain.max() < 1e-6 and np.abs(gain[x > 1e-9]).max(initial=0) < 1e-6


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(1, 16), st.integers(1, 200), max_size=16))
def test_plan_uses_no_more_than_there_is(histogram):
    planned = packing.plan(histogram, 16)
    used = defaultdict(int)
    for combo, n in planned:
        assert sum(combo) == 16 and n > 0
        for k in combo:
            used[k] += n
    assert all(n <= histogram.get(k, 0) for k, n in used.items())
    slots = packing.places(planned)
    assert sum(high - low for _, low, high, _, _ in slots) == sum(used.values())
