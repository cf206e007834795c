"""Repeated passages inside one long sentence, and in scripts without blanks."""

import random

import pytest

from threadloom.llm import substring
from threadloom.llm.substring import LONG, clauses_of, sentences_of


def left(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return dict(substring.drop_repeats(df).select("doc_id", "text").collect())


def test_a_passage_of_over_50_words_never_stays(spark):
    rnd = random.Random(8)

    def words(n):
        return [f"w{rnd.randrange(10**6)}" for _ in range(n)]

    rows, passages = [], {}
    for i in range(60):
        passages[i] = words(rnd.randint(51, 90))
        rows.append((i, " ".join(words(rnd.randint(0, 60)) + passages[i] + words(rnd.randint(0, 60))) + "."))
        rows.append((1000 + i, " ".join(words(rnd.randint(0, 60)) + passages[i] + words(rnd.randint(0, 60)))))
    got = left(spark, rows)
    for i, passage in passages.items():
        assert got[i] == dict(rows)[i]
        assert " ".join(passage) not in got[1000 + i]
        kept, own = set(got[1000 + i].split()), set(dict(rows)[1000 + i].split()) - set(passage)
        # the words around it stay but for a clause at either end
        assert len(own - kept) <= 2 * substring.WINDOW
        assert len(kept & set(passage)) <= 4 * substring.WINDOW


@pytest.mark.parametrize("mark", ["。", "，"])
def test_scripts_without_blanks(spark, mark):
    rnd = random.Random(9)

    def run(n):
        return "".join(chr(0x4E00 + rnd.randrange(5000)) + (mark if k % 9 == 8 else "") for k in range(n))

    passage = run(90)
    rows = [(1, run(30) + passage + run(20)), (2, run(25) + passage + run(40)), (3, run(100))]
    got = left(spark, rows)
    assert got[1] == rows[0][1] and got[3] == rows[2][1]
    assert passage not in got[2] and len(got[2]) < len(rows[1][1]) - 50


def test_clauses_join_to_the_sentence_and_short_ones_stay():
    rnd = random.Random(10)
    for n in [0, 1, LONG, LONG + 1, 500, 5000]:
        text = " \t".join(rnd.choices(["a", "bc", "กข", "é", "x."], k=n))
        assert "".join(sentences_of(text)) == text
        assert "".join(clauses_of(text)) == text
    plain = " ".join(f"w{i}" for i in range(LONG))
    assert clauses_of(plain) == [plain]
    assert len(clauses_of(plain + " more")) > 5
    assert "".join(sentences_of("word " * 100_000)) == "word " * 100_000
