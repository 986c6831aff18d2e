import hashlib
import random
import sys

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm import bpe, token_count
from ledgerlens.llm.queries import op3_bpe_round_trip, op5_token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = token_count.TokenCounter(bpe.load(PATH), token_count.prove_single(bpe.load(PATH)))
PARTS = st.sampled_from(["a", "the", " ing", " ", "  ", "\n", "\t", "\r\n", "'s", "'", "é", "ñ", "1", "²", "!", "😀", "漢",
                         "<|endoftext|>", "<|endof", "\x1c", "\x85", " ", "​", "́"])


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.lists(PARTS, max_size=15).map("".join), st.text(max_size=40)))
def test_ids_count_and_text_equal_the_library(text):
    ids = library_ids(text)
    assert bpe.load(PATH).encode(text) == ids
    assert bpe.encode_text(PATH, text) == ",".join(map(str, ids))
    assert bpe.load(PATH).decode(ids) == text == LIBRARY.decode(ids, skip_special_tokens=False)
    assert COUNTER.count(text) == len(ids)


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=0, max_size=60))
def test_merge_takes_the_leftmost_lowest_rank(word):
    """Against the plain definition: scan all pairs, merge the first one of lowest rank, repeat."""
    b = bpe.load(PATH)
    ids = [b.byte_ids[x] for x in word]
    while True:
        ranks = [(b.ranks[x << 20 | y], i) for i, (x, y) in enumerate(zip(ids, ids[1:])) if x << 20 | y in b.ranks]
        if not ranks:
            break
        rank, i = min(ranks)
        ids[i:i + 2] = [b.made[rank]]
    assert b.merge(word) == ids


def test_very_long_word():
    text = "ab" * 40_000
    assert bpe.load(PATH).encode(text) == library_ids(text)


def test_short_pre_token_is_a_root_and_its_leaves():
    b, calls = bpe.load(PATH), []
    sys.setprofile(lambda frame, event, arg: calls.append(frame.f_code.co_name) if event == "call" else None)
    try:
        ids = b.merge(b" thatrethenououentier")
    finally:
        sys.setprofile(None)
    assert ids == library_ids(" thatrethenououentier")
    assert set(calls) <= {"merge"}  # no node above the leaves is brought up to date


@pytest.mark.parametrize("n", [31, 32, 33, 34, 35, 500, 1024, 1025, 1057, 5000])
def test_words_about_the_size_of_nodes(n):
    word = "".join(random.Random(n).choices("abehinorst", k=n))
    assert bpe.load(PATH).merge(word.encode()) == library_ids(word)


def test_chunks_and_their_words_share_a_memo():
    memo = bpe._chunk_texts(PATH)
    memo.clear()
    assert bpe.encode_text(PATH, "a thonour, then thonour") == ",".join(map(str, library_ids("a thonour, then thonour")))
    assert memo[" thonour,"] == ",".join([memo[" thonour"], memo[","]])
    assert set(memo) == {"a", " thonour,", " thonour", ",", " then"}


def test_proven_strings_are_one_token():
    b = bpe.load(PATH)
    for word in sorted(COUNTER.single)[::500]:
        assert len(library_ids(word)) == 1
    assert len(COUNTER.single) > 40_000 and not set(b.specials) & COUNTER.single


def test_memo_starts_afresh():
    memo = bpe.Memo(lambda k: k * 2, 700)
    assert [memo[str(i)] for i in range(8)] == [str(i) * 2 for i in range(8)] and len(memo) <= 3


def test_long_chunks_are_not_kept(edge_docs):
    bpe.load(PATH)
    text = "\u6f22\u5b57\u4eee\u540d" * 2000
    bpe._chunk_texts(PATH).clear()
    assert bpe.encode_text(PATH, text) == ",".join(map(str, library_ids(text)))
    assert not bpe._chunk_texts(PATH)


def test_digests_of_edge_rows(edge_docs):
    got = sorted(map(tuple, bpe.round_trip_digests(edge_docs, PATH).collect()), key=str)
    want = []
    for r in edge_docs.collect():
        ids = library_ids(r.text or "")
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_encode_decode_keeps_real_outputs(edge_docs):
    for r in bpe.encode_decode(edge_docs, PATH).collect():
        assert r.decoded == LIBRARY.decode(r.token_ids, skip_special_tokens=False)


def test_counts_of_edge_rows(edge_docs):
    got = sorted(map(tuple, token_count.count_tokens(edge_docs, PATH).collect()), key=str)
    assert got == sorted(((r.doc_id, len((r.text or "").encode()), len(library_ids(r.text or "")))
                          for r in edge_docs.collect()), key=str)


@pytest.mark.parametrize("query", [op3_bpe_round_trip, op5_token_counts])
def test_queries_cover_the_table(spark, sf, query):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = query(spark, sf).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(library_ids(t)) for i, t in texts.items()}


def test_empty_tables(no_docs):
    assert bpe.round_trip_digests(no_docs, PATH).count() == 0
    assert token_count.count_tokens(no_docs, PATH).count() == 0
