"""Substring dedup against brute force."""

import random

from threadloom.llm import substring


def slow(rows, min_sentences=2, min_words=20):
    """First occurrence by key of every run stays; rows with equal keys do not see each other."""
    parsed = [(k, substring.sentences_of(t or "")) for k, t in rows]

    def runs(sentences):
        for i in range(len(sentences)):
            for j in range(i + min_sentences, len(sentences) + 1):
                text = [" ".join(s.lower().split()) for s in sentences[i:j]]
                if sum(len(s.split()) for s in text) >= min_words:
                    yield i, j, tuple(text)
                    break

    order = lambda k: (k is not None, k or 0)
    first = {}
    for key, sentences in parsed:
        for _, _, run in runs(sentences):
            first[run] = min(first.get(run, order(key)), order(key))
    out = []
    for (key, text), (_, sentences) in zip(rows, parsed, strict=True):
        gone, seen = set(), set()
        for i, j, run in runs(sentences):
            if first[run] < order(key) or run in seen:
                gone |= set(range(i, j))
            seen.add(run)
        kept = None if text is None else "".join(s for i, s in enumerate(sentences) if i not in gone)
        out.append((key, kept, len(gone), len(sentences)))
    return sorted(out, key=repr)


def sample():
    rnd = random.Random(2)

    def sentence():
        return " ".join(rnd.choices("one two three four five six".split(), k=rnd.randint(1, 18))).capitalize() + rnd.choice(".!?")

    passages = [[sentence() for _ in range(rnd.randint(1, 9))] for _ in range(5)]
    rows = []
    for i in range(150):
        body = [sentence() for _ in range(rnd.randint(0, 8))]
        for _ in range(rnd.choice([0, 1, 2])):
            body[len(body) // 2 : len(body) // 2] = rnd.choice(passages)
        rows.append((i * 17 % 151, rnd.choice([" ", "\n", " \t"]).join(body)))
    whole = " ".join(passages[0] + passages[1])
    return rows + [
        (None, whole), (None, None), (500, None), (501, ""), (502, whole), (502, whole),
        (502, " ".join(passages[2])), (503, "No end " * 20_000), (504, (whole + "\n") * 200),
        (505, "\n\n  "), (506, whole.upper()),
    ]


def test_matches_brute_force(spark):
    rows = sample()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "'k' AS key", "text", "1 AS high", "current_date() AS n"
    )
    got = substring.drop_repeats(df)
    assert got.columns == [*df.columns, "_removed", "_sentences"]
    have = got.select("doc_id", "text", "_removed", "_sentences").collect()
    assert sorted(map(tuple, have), key=repr) == slow(rows)
    assert sum(r["_removed"] for r in have) > 300
    assert substring.drop_repeats(df.limit(0)).count() == 0


def test_sentences_join_to_the_text():
    for _, text in sample():
        assert "".join(substring.sentences_of(text or "")) == (text or "")


def test_a_long_passage_of_two_sentences_goes_and_chance_repeats_stay(spark):
    passage = " ".join(f"w{i}" for i in range(30)) + ". " + " ".join(f"v{i}" for i in range(25)) + "."
    rows = [(1, f"Mine. Yes. {passage} End."), (2, f"Other. {passage} Yes. No."), (3, "Yes. No. Ok.")]
    got = dict(substring.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
               .select("doc_id", "text").collect())
    assert got[1] == rows[0][1] and got[3] == rows[2][1]
    assert got[2] == "Other. Yes. No."
