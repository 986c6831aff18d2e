import re
import zlib

import corpus_pipeline
from pyspark.sql import functions as F

from ledgerlens.llm import language_id, quality
from test_dedup import groups_by_hand, fp_by_hand, norm
from test_packing import check, ids_of


def by_hand(spark, docs, labels):
    """The same decisions row by row in plain Python; the models are the operators' own."""
    rows = docs.collect()
    model = language_id.train(docs, F.lit(True))
    rows = [r for r in rows if model.predict([r.text])[0][0] != "und"]
    kept = spark.createDataFrame(rows, docs.schema)
    model = quality.train(kept, labels, F.lit(True))
    rows = [r for r in rows if model.score([r.text])[0] >= 0.3]
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault(norm(r.text), r)
    rows = list(first.values())
    groups = groups_by_hand([(r.doc_id, fp_by_hand(r.text)) for r in rows])
    return [r for r in rows if groups[r.doc_id, fp_by_hand(r.text)] == r.doc_id]


def test_stages_are_the_named_five():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "quality_classifier", "exact_dedup", "simhash_near_dedup", "packing"]


def test_run_equals_plain_python(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = {r.doc_id: ids_of(r.text) for r in by_hand(spark, docs, spark.read.parquet(f"{sf}/labels.parquet"))}
    check(corpus_pipeline.run(spark, sf).collect(), want, 2048)


def test_stages_on_edge_and_empty_rows(spark, edge_docs, no_docs, tmp_path, sf):
    for table, docs in (("edge", edge_docs), ("none", no_docs)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, sf)
            if name != "packing":
                assert out.columns == docs.columns and out.schema == docs.schema, name
            path = str(tmp_path / f"{table}-{k}")
            out.write.parquet(path)
            docs = spark.read.parquet(path)
        assert (docs.count() == 0) == (table == "none")
