"""The pipeline's near-duplicate and later stages against brute force, and clashing column names."""

import corpus_pipeline
from tests.llm.test_lines import slow as slow_lines
from tests.llm.test_packing import check_sequences
from tests.llm.test_pipeline import documents
from tests.llm.test_simhash import slow_components, slow_fingerprint
from tests.llm.test_substring import slow as slow_passages
from threadloom.llm import lines, packing, substring

CLASHING = [
    "_dropped", "_kept", "_host", "_keys", "_key", "_runs", "_removed", "_sentences", "_mark", "_id",
    "own", "mark", "whole", "row", "rest", "fp", "component", "n", "keys", "page", "pages", "high", "low",
    "ids", "start", "length", "lang_pred", "score", "_text",
]


def order(row):
    return row["doc_id"] is not None, row["doc_id"] or 0


def test_near_duplicates_are_simhash_groups(spark):
    docs = documents(spark)
    rows = [tuple(r) for r in docs.collect()]
    text = rows[10][1]
    rows += [(2000 + i, text + f" w{i}", "en", "s", 1, 2000 + i, 1, "x") for i in range(4)]
    rows += [(3000, "some words of one text", lang, "s", 1, 3000, 1, "x") for lang in ("en", None, "en")]
    docs = spark.createDataFrame(rows, docs.schema)
    got = corpus_pipeline.distinct_documents(spark, docs, "").collect()
    held = sorted(docs.collect(), key=order)
    least = slow_components([(i, slow_fingerprint(r["text"], 3)) for i, r in enumerate(held)], 2)
    want = [held[i] for i in sorted({*least.values()})]
    assert sorted(map(order, got)) == [order(r) for r in want]
    # texts of a group whose least id is held once are that row's
    once = {r["doc_id"] for r in held if sum(x["doc_id"] == r["doc_id"] for x in held) == 1}
    texts = lambda found: sorted(repr(r[:2]) for r in found if r["doc_id"] in once)
    assert texts(got) == texts(want)
    again = corpus_pipeline.distinct_documents(spark, docs.orderBy("text"), "").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert len(got) < len(rows) - 6


def test_later_stages(spark):
    docs = documents(spark).where("text IS NOT NULL AND text <> ''")
    fresh = corpus_pipeline.new_passages(spark, docs, "")
    assert fresh.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = [(d, t) for d, t, n, _ in slow_passages(rows) if not n or t.strip(" ")]
    assert sorted(((r["doc_id"], r["text"]) for r in fresh.collect()), key=repr) == sorted(want, key=repr)
    few = fresh.where("doc_id < 300").dropDuplicates(["doc_id"])
    few = spark.createDataFrame(few.collect(), few.schema)
    packed = [tuple(r) for r in packing.pack(few, corpus_pipeline.bpe.default_path("word_bpe_49k.json")).collect()]
    packed = [(d, s, n, bytes(i), t, q, o) for d, s, n, i, t, q, o in packed]
    assert check_sequences(packed, dict(few.select("doc_id", "text").collect())) < 0.05
    assert corpus_pipeline.sequences(spark, few, "").count() == len(packed)


def test_names_that_clash(spark):
    docs = documents(spark).where("doc_id < 60 OR doc_id > 1000 OR doc_id IS NULL").drop("host")
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    clashing = plain.selectExpr("*", *[f"concat('{c}', doc_id) AS `{c}`" for c in CLASHING])
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, clashing, "")
        want = stage(spark, plain, "")
        if name == "packing":
            assert found.select("doc_id", "length").exceptAll(want.select("doc_id", "length")).count() == 0
            continue
        assert found.columns == clashing.columns
        rows = found.collect()
        assert all(r[c] == (None if r["doc_id"] is None else f"{c}{r['doc_id']}") for r in rows for c in CLASHING)
        assert sorted([r[:5] for r in rows], key=repr) == sorted(map(tuple, want.collect()), key=repr)
        clashing = spark.createDataFrame(rows, clashing.schema)
        plain = clashing.select(*plain.columns)


def test_operators_name_their_counts_beside_the_caller_s(spark):
    df = spark.createDataFrame(
        [(i, "s", "head\nown", "mine", "too") for i in range(9)],
        "doc_id long, source string, text string, _dropped string, _Removed string",
    )
    found = lines.drop_lines(df)
    assert found.columns == [*df.columns, "_dropped_"]
    assert {(r["_dropped"], r["_dropped_"]) for r in found.collect()} == {("mine", 2)}
    want = slow_lines([(i, "s", "head\nown") for i in range(9)], lines.RATIO, lines.MIN_PAGES)
    assert {n for *_, n in want} == {2}
    found = substring.drop_repeats(df)
    assert found.columns == [*df.columns, "_removed_", "_sentences"]
    assert {(r["_Removed"], r["_removed_"]) for r in found.collect()} == {("too", 0)}
