import numpy as np
import zlib
from pyspark.sql import functions as F

from ledgerlens.llm import language_id, quality
from ledgerlens.llm.queries import op2_quality_classifier, op9_language_id

SF = "/root/testdata/sf0.01"


def held(i, folds, fold):
    return zlib.crc32(str(i).encode()) % folds == fold


def test_language_accuracy_on_the_held_out_fold(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op9_language_id(spark, SF).collect()
    assert {r.doc_id: r.held_out for r in rows} == {i: held(i, 3, 1) for i in lang}
    assert all(0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in out]) > 0.97


def test_ngram_vectors_bind_rotated_letters():
    v = language_id.NgramVectors()
    a, b, c = (language_id.letter_vector(ord(x)) for x in "abc")
    packed = int(language_id.ngrams("abc")[1])
    assert (v.one(packed) == np.roll(a, 2) * np.roll(b, 1) * c).all()


def test_bundles_equal_the_sum_over_ngrams():
    v = language_id.NgramVectors()
    for text in ("Hello, World!", "ÀÉ 12 ß", "a"):
        want = sum(v.one(int(g)).astype(int) for g in language_id.ngrams(text))
        assert (language_id.bundles([text, None])[0] == want).all()
    assert not language_id.bundles(["", None, "12"]).any()
    assert [len(language_id.ngrams(t)) for t in ("a", " a ", "ab  cd", "!!", "")] == [1, 1, 5, 0, 0]


def test_language_edge_rows(edge_docs, no_docs):
    model = language_id.train(edge_docs, F.lit(True))
    assert model.languages == ["en"]
    got = language_id.predict(edge_docs, model).collect()
    assert len(got) == edge_docs.count()
    unknown = {r.doc_id for r in got if r.lang_pred == "und"}
    assert unknown == {3, 4, 5, 12} and all(r.score == 0 for r in got if r.doc_id in unknown)
    kept = language_id.keep_known(edge_docs, model)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count() - 4
    assert language_id.predict(no_docs, model).count() == 0
    none = language_id.train(no_docs, F.lit(True))
    assert {r.lang_pred for r in language_id.predict(edge_docs, none).collect()} == {"und"}


def test_quality_on_the_held_out_fold(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op2_quality_classifier(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id, 5, 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    out = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = (np.array([s for s, y in out if y == k]) for k in (1, 0))
    assert (good[:, None] > bad[None]).mean() > 0.9
    assert np.mean([(s >= 0.3) == y for s, y in out]) > 0.9


def test_quality_repeats_exactly(spark, sf):
    a, b = (sorted(map(tuple, op2_quality_classifier(spark, sf).collect())) for _ in range(2))
    assert a == b


def index_of(words):
    return quality.index_vectors(quality.word_hashes(words))


def decoded(v):
    return np.frombuffer(v, dtype=f"<i{len(v) // 128}") if len(v) > 64 else quality.unpacked(np.frombuffer(v, np.uint8)[None])[0]


def test_contexts_equal_a_plain_loop(monkeypatch):
    words = "a b c a b d".split() * 300
    vector = dict(zip("abcd", index_of(list("abcd")).astype(int)))
    want = {w: np.zeros(quality.DIMENSIONS, dtype=int) for w in "abcd"}
    for i, x in enumerate(words):
        for j in range(max(0, i - 2), min(len(words), i + 3)):
            if j != i:
                want[x] += vector[words[j]]
    for chunk in (quality.CHUNK, 1, 2, 7, len(words)):
        monkeypatch.setattr(quality, "CHUNK", chunk)
        seen = quality.Contexts()
        for part in quality.chunks(words):
            seen.add(part)
        got = {}
        for batch in seen.take():
            for h, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got[h] = decoded(v)
        assert not seen.row and len(got) == 4
        for w, h in zip("abcd", quality.word_hashes(list("abcd")).astype(np.int64)):
            assert (got[int(h)] == want[w]).all()


def test_sums_of_every_size_are_coded():
    sums = np.zeros((6, quality.DIMENSIONS), dtype=np.int64)
    sums[:, 3] = 0, 7, -7, 127, -128, 2 ** 40
    sums[5, 4] = -32768
    rows = [r for b in quality.coded(np.arange(6, dtype=np.uint64), sums) for r in zip(*(c.to_pylist() for c in b.columns))]
    assert {h: len(v) for h, v in rows} == {1: 64, 2: 64, 3: 128, 4: 256, 5: 1024}
    assert all((decoded(v) == sums[h]).all() for h, v in rows) and len(rows) == 5


def test_pooling_is_the_mean_of_word_vectors_also_when_the_table_starts_afresh(monkeypatch):
    texts = ["one two two!", None, "three four five", "one"]
    learned = quality.Learned(quality.word_hashes(["two"]), quality.packed(np.full((1, quality.DIMENSIONS), 7)))
    whole = quality.Pooler(learned).pool(texts)
    monkeypatch.setattr(quality, "MEMO_WORDS", 3)
    small = quality.Pooler(learned)
    assert np.allclose(whole, small.pool(texts)) and not whole[1].any()
    v = index_of(["one", "two", "!"]).astype(float)
    v[1] += np.sqrt(quality.NONZERO / quality.DIMENSIONS)  # a constant vector as long as an index vector
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    assert np.allclose(whole[0, :quality.DIMENSIONS], (v[0] + 2 * v[1] + v[2]) / 4, atol=1e-6)
    assert np.allclose(whole[0, -3:], [1 / 4, 0, 0])


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, quality.FEATURES))
    y = (x[:, 0] + rng.normal(size=2000) > 0).astype(float)
    s = quality.Network(x, y).score(x)
    assert abs(s.mean() - y.mean()) < 0.05 and ((s > 0.5) == y).mean() > 0.7


def test_quality_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (9, 0), (9, 1)], "doc_id long, quality int")
    for known in (labels, labels.limit(0)):
        model = quality.train(edge_docs, known, F.lit(True))
        rows = quality.score(edge_docs, model).collect()
        assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows} == {0.5}
    assert quality.score(no_docs, model).count() == 0
    kept = quality.keep_good(edge_docs, model)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()


def test_quality_rare_words_get_contexts(spark):
    """Two languages, the second of rarer words: all 9,000 words of the fitted rows have a learned vector."""
    texts = [" ".join(f"{lang}{(j + k) % n}" for k in range(60))
             for lang, n, copies in (("a", 5000, 3), ("b", 4000, 1)) for j in range(0, n, 60) for _ in range(copies)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    learned = quality.train(docs, labels, F.lit(True)).learned
    words = [f"a{j}" for j in range(5000)] + [f"b{j}" for j in range(4000)]
    assert len(learned) == 9000 and set(learned.hashes) == set(quality.word_hashes(words))
    assert (np.abs(quality.unpacked(learned.vectors)).max(axis=1) == 7).all()


def test_quality_fits_one_row_per_id(spark, monkeypatch):
    """Rows that repeat a fitted id (copies, and other texts) neither reach the driver nor change the fit."""
    fitted = []
    monkeypatch.setattr(quality, "Network", lambda x, y, real=quality.Network: fitted.append(len(y)) or real(x, y))
    rows = [(i, f"text of row {i} with words {'good' if i % 2 else 'bad'} " + f"w{i % 7} " * 5) for i in range(40)]
    more = rows[3:4] * 500 + rows[20:30]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    scores = []
    for extra in ([], more):
        docs = spark.createDataFrame(rows + extra, "doc_id long, text string").repartition(5)
        model = quality.train(docs, labels, F.lit(True))
        scores.append(model.score([t for _, t in rows]))
        docs = docs.unionByName(docs.filter("doc_id = 5").withColumn("text", F.lit("another text")))
        quality.train(docs, labels, F.lit(True))
    assert scores[0] == scores[1] and max(fitted) == 40


def test_long_texts_are_bundled_in_bounded_parts(monkeypatch):
    rng = np.random.default_rng(3)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9FA5, n))) for n in (5_000, 20, 0, 3_000)] + [None, "word " * 400]
    want = language_id.bundles(texts)
    monkeypatch.setattr(language_id, "GROUP", 257)
    assert (language_id.bundles(texts) == want).all()
    sizes = []
    plain = language_id.bundle
    monkeypatch.setattr(language_id, "bundle", lambda counts, grams: sizes.append(counts.size) or plain(counts, grams))
    language_id.bundles(texts)
    assert max(sizes) <= 257 * 3


def test_a_dirty_language_column_is_refused(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 3)
    rows = spark.createDataFrame([(i, "some text", f"l{i}") for i in range(4)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        language_id.train(rows, F.lit(True))


def test_language_tables_and_batches_are_small(spark, monkeypatch):
    from ledgerlens.llm import batches

    asked, get = [], language_id.NgramVectors.get
    monkeypatch.setattr(language_id.NgramVectors, "get", lambda self, codes: asked.append(len(codes)) or get(self, codes))
    text = "".join(chr(0x4E00 + i * 7 % 6000) for i in range(9000))
    whole = language_id.bundles([text])[0]
    assert sum(asked) > 5000 and max(asked) <= 2048
    grams = language_id.ngrams(text)
    assert (whole == sum(get(language_id._vectors(), grams[a:a + 500]).sum(axis=0) for a in range(0, len(grams), 500))).all()
    spark.conf.unset(batches.BATCH_CONF)
    language_id.train(spark.createDataFrame([("ein Wort", "de")], "text string, lang string"), F.lit(True))
    assert spark.conf.get(batches.BATCH_CONF) == f"{batches.BATCH_BYTES}b"


def test_a_worker_hands_freed_memory_back():
    """Rows of 1 KB among others that stay: the C library keeps their pages unless told."""
    import subprocess
    import sys

    code = """
import numpy as np
from ledgerlens.llm import batches
held = lambda: int(open("/proc/self/statm").read().split()[1]) * 4096
rows = [np.ones(1024, dtype=np.int8) for _ in range(120_000)]
full, stay = held(), rows[::1000]
batches._RELEASES["table"] = rows.clear
batches.claim("another")
assert full - held() > 80e6, (full, held())
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


def test_fitting_and_dedup_drop_what_stages_before_kept(spark, monkeypatch):
    from ledgerlens.llm import batches, exact_dedup

    docs = spark.createDataFrame([(i, f"text {i} of words") for i in range(12)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    ran, plain = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, *a: ran.append(f) or plain(self, f, *a))
    quality.score(docs, quality.train(docs, labels, F.lit(True)))
    exact_dedup.exact_groups(docs)
    assert len(ran) == 6
    dropped = []
    monkeypatch.setitem(batches._RELEASES, "before", lambda: dropped.append("before"))
    for k, f in enumerate(ran, 1):
        monkeypatch.setattr(batches, "_OWNER", ["before"])
        assert not [b for b in f(iter([])) if b.num_rows]
        assert len(dropped) == k


def test_fitting_takes_batches_of_bounded_bytes(spark, monkeypatch):
    from ledgerlens.llm import batches

    seen, plain = [], type(spark.range(1)).mapInArrow
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda self, f, *a: seen.append(
        (f.__name__, spark.conf.get(batches.BATCH_CONF))) or plain(self, f, *a))
    spark.conf.unset(batches.BATCH_CONF)
    docs = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string")
    quality.train(docs, docs.select("doc_id", F.lit(1).alias("quality")), F.lit(True))
    assert ("gather", f"{batches.BATCH_BYTES}b") in seen


def test_the_table_of_word_vectors_is_bounded():
    learned = quality.Learned(np.zeros(0, dtype=np.uint64), np.zeros((0, quality.DIMENSIONS // 2), dtype=np.uint8))
    pooler = quality.Pooler(learned)
    for a in range(0, 70_000, 7_000):
        pooler.pool([" ".join(f"w{i}" for i in range(a, a + 7_000))])
        assert len(pooler.row) <= quality.MEMO_WORDS and pooler.table.nbytes <= 16 << 20


def test_sums_of_more_words_than_a_block(spark, monkeypatch):
    """Words of one task in several blocks get the sums that they get in one."""
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 53}" for j in range(90))) for i in range(9)],
                                 "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    found = []
    for pack in (quality.PACK, 5):
        monkeypatch.setattr(quality, "PACK", pack)
        seen = quality.Contexts()
        for r in docs.collect():
            for part in quality.chunks(quality.WORDS.findall(r.text)):
                seen.add(part)
        found.append(sorted(r for b in seen.take() for r in zip(*(c.to_pylist() for c in b.columns))))
        learned = quality.train(docs, labels, F.lit(True)).learned
        found.append((learned.hashes.tolist(), learned.vectors.tolist()))
    assert found[0] == found[2] and found[1] == found[3] and len(found[1][0]) == 53
