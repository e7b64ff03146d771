"""The pipeline against brute force, and its stages at the edges."""

from catamill.session import table
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import brute_components, brute_counts, odd, texts_of  # noqa: F401


def test_pipeline(spark, sf):
    docs = table(spark, sf, "documents")
    texts = texts_of(sf)
    one = corpus_pipeline.rules_stage(spark, docs, sf)
    assert one.columns == docs.columns
    kept = {r.doc_id for r in one.collect()}
    assert not any(n < 50 or 100 * rep > 50 * n for n, *_, rep in (brute_counts(texts[k]) for k in kept))
    good = {r.doc_id for r in table(spark, sf, "labels").where("quality = 1").collect()}
    assert all(k in kept for k in good if (c := brute_counts(texts[k]))[0] >= 50 and 100 * c[-1] <= 50 * c[0])
    two = corpus_pipeline.classifier_stage(spark, docs.where(F.col("doc_id").isin(*kept)), sf)
    kept = {r.doc_id for r in two.collect()}
    assert two.columns == docs.columns
    three = corpus_pipeline.near_duplicates_stage(spark, docs.where(F.col("doc_id").isin(*kept)), sf)
    want = {c for k, _, c in brute_components([(k, texts[k]) for k in kept])}
    assert {r.doc_id for r in three.collect()} == want and three.columns == docs.columns
    out = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == want


def test_stages_at_the_edges(spark, sf, odd):  # noqa: F811
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, sf)
        assert out.columns == (odd.columns if name != "packing" else ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        out.collect()
        assert stage(spark, odd.limit(0), sf).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "q r s t u v"), (2, None), (2, None), (3, "x y z w v u")]
    left = corpus_pipeline.near_duplicates_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf)
    rows += [(4, "one text of an id"), (4, "another text of that id"), (5, "another text of that id")]
    assert sorted((r.doc_id, r.text) for r in left.where("doc_id is not null").collect()) in ([(1, "a b c d e f"), (2, None), (3, "x y z w v u")],)
    # Both texts of an id that stands twice stay; a copy under another id goes.
    left = corpus_pipeline.near_duplicates_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf)
    assert sorted((r.doc_id, r.text) for r in left.where("doc_id > 3").collect()) == [(4, "another text of that id"), (4, "one text of an id")]
