"""Copies of a page in the pipeline's line stage."""

import corpus_pipeline


def test_a_group_of_copies_survives(spark):
    rows = [(i, f"head\nown {i}\nmore {i}", "en", "s", 0) for i in range(44)]
    rows += [(100 + i, "head\ncopied line\nanother one", "en", "s", 0) for i in range(6)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    got = corpus_pipeline.own_lines(spark, spark.createDataFrame(rows, schema), "")
    left = {r["doc_id"]: r["text"] for r in got.collect()}
    assert len(left) == len(rows) and left[3] == "own 3\nmore 3"
    assert all(left[100 + i] == "copied line\nanother one" for i in range(6))
