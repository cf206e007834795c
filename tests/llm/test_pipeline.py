"""The pipeline's stages against brute force."""

import corpus_pipeline
from tests.llm.test_lines import slow as slow_lines
from tests.llm.test_packing import check_sequences
from tests.llm.test_simhash import slow_components, slow_fingerprint
from tests.llm.test_substring import slow as slow_passages
from threadloom.llm import lines, packing


def documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    text = rows[3][1]
    changed = text.replace(" ", "  ", 3).replace("the", "teh", 1)
    extra = [
        (1001, None, None, "src0", 0), (1002, "12 34 !!", None, "src0", 8), (1003, "", "en", "src0", 0),
        (1004, text, "en", "src1", len(text)), (1005, changed, "en", None, len(changed)),
        (1006, rows[5][1], None, "src2", None), (1006, rows[5][1], None, "src2", None),
        (None, rows[7][1] + " And one more sentence.", "en", "src3", 5),
    ]
    return spark.createDataFrame(rows + extra, docs.schema).selectExpr("*", "doc_id AS key", "1 AS _removed2", "'x' AS host")


def test_stages_match_brute_force(spark):
    docs = documents(spark)
    stages = dict(corpus_pipeline.STAGES)

    known = stages["language"](spark, docs, "")
    assert known.columns == docs.columns
    rejected = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in known.collect()}
    assert rejected == {1001, 1002, 1003}
    known = spark.createDataFrame(known.collect(), docs.schema)

    cleaned = stages["lines"](spark, known, "")
    assert cleaned.columns == docs.columns
    rows = [(r["doc_id"], r["source"], r["text"]) for r in known.collect()]
    want = [(d, t) for d, _, t, n in slow_lines(rows, lines.RATIO, lines.MIN_PAGES) if not n or t.strip(" ")]
    assert sorted(((r["doc_id"], r["text"]) for r in cleaned.collect()), key=repr) == sorted(want, key=repr)
    cleaned = spark.createDataFrame(cleaned.collect(), docs.schema)

    distinct = stages["near duplicates"](spark, cleaned, "")
    assert distinct.columns == docs.columns
    order = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)
    rows = sorted(cleaned.collect(), key=order)
    least = slow_components([(i, slow_fingerprint(r["text"], 5)) for i, r in enumerate(rows)], 10)
    want = [rows[i] for i in sorted({*least.values()})]
    got = sorted(distinct.collect(), key=order)
    assert [(r["doc_id"], r["text"]) for r in got] == [(r["doc_id"], r["text"]) for r in want]
    assert len(got) < len(rows) - 3
    distinct = spark.createDataFrame(got, docs.schema)

    fresh = stages["passages"](spark, distinct, "")
    assert fresh.columns == docs.columns
    want = [(d, t) for d, t, n, _ in slow_passages([(r["doc_id"], r["text"]) for r in got]) if not n or t.strip(" ")]
    assert sorted(((r["doc_id"], r["text"]) for r in fresh.collect()), key=repr) == sorted(want, key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in fresh.where("doc_id < 1000").collect())

    packed = [tuple(r) for r in packing.pack(fresh, corpus_pipeline.bpe.default_path("word_bpe_49k.json")).collect()]
    packed = [(d, s, n, bytes(i), t, q, o) for d, s, n, i, t, q, o in packed]
    assert check_sequences(packed, dict(fresh.select("doc_id", "text").collect())) < 0.05
    assert stages["packing"](spark, fresh, "").count() == len(packed)


def test_whole_run_and_empty_tables(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 100
    docs = documents(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        assert out.count() == 0
        assert name == "packing" or out.columns == docs.columns
