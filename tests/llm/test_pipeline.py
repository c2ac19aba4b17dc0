"""The pipeline's stages, each on what its predecessor kept."""

import collections

import corpus_pipeline
from llm.test_text_operators import expected_components, expected_removals, frame, rows_of, words


def test_stages(spark, docs_frame):
    documents = docs_frame
    columns = documents.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, documents, "").checkpoint()
        kept[name] = (documents, out)
        if name != "encode":
            assert out.columns == columns
        documents = out
    before, after = kept["near_dedup"]
    groups = expected_components(rows_of(before))
    assert sorted(r.doc_id for r in after.collect()) == sorted(g[0] for g in groups if g[3])
    before, after = kept["substring_dedup"]
    gone = {i: n for i, _, n, _ in expected_removals(rows_of(before))}
    sizes = {i: len(words(t)) for i, t in rows_of(before)}
    assert {i: len(words(t)) for i, t in rows_of(after)} == {i: sizes[i] - gone[i] for i in sizes}
    before, after = kept["mix_sources"]
    total = sum(len(words(t)) for _, t in rows_of(before))
    assert abs(sum(len(words(t)) for _, t in rows_of(after)) - total) < 0.05 * total
    before, after = kept["encode"]
    assert collections.Counter(r.doc_id for r in after.collect()) == collections.Counter(i for i, _ in rows_of(before))
    assert after.where("not lossless").count() == 0


def test_empty_tables(spark):
    documents = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        documents = stage(spark, documents, "")
        assert documents.count() == 0


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and set(out.columns) >= {"doc_id", "ids"}
