"""Two tokenizers aligned, against whole texts aligned pair by pair."""

import random
from collections import Counter
from hashlib import sha256

import pytest

from threadloom.llm import alignment, queries
from threadloom.llm.bpe import default_path

PATHS = [default_path(queries.BYTE_VOCABULARY), default_path(queries.PIECE_VOCABULARY)]


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(*PATHS)


def slow(texts, aligner):
    """Each text's n_a, n_b, groups as text and links, from the libraries on whole texts."""
    out = []
    for text in texts:
        a = aligner.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = aligner.b.encode(text) if text else []
        joined = [b"".join(data[i] for i in ids) for data, ids in ((aligner.bytes_a, a), (aligner.bytes_b, b))]
        if not text or joined != [(" " + text).encode()] * 2:
            out.append((0, 0, [], []))
            continue
        tokens, ends = [], []
        for data, ids in ((aligner.bytes_a, a), (aligner.bytes_b, b)):
            at, stops = 0, []
            for i in ids:
                at += len(data[i])
                stops.append(at)
            tokens.append(list(zip(stops, ids, strict=True)))
            ends.append(set(stops))
        at_end = dict(tokens[1])  # no token is empty, so each end is of one token
        links = [(i, at_end[p]) for p, i in tokens[0] if p in at_end]
        groups, before = [], 0
        for stop in sorted(ends[0] & ends[1]):
            sides = [",".join(str(i) for p, i in side if before < p <= stop) for side in tokens]
            groups.append("|".join(sides))
            before = stop
        out.append((len(a), len(b), groups, links))
    return out


def check(spark, rows, aligner, partitions=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 row", "2 same", "3 key")
    aligned = alignment.align(df.repartition(partitions), *PATHS)
    got = sorted(map(tuple, alignment.score(aligned).select(
        "key", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum").collect()), key=repr)
    found = slow([t for _, t in rows], aligner)
    counts = Counter(pair for *_, links in found for pair in links)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    want = [
        (key, n_a, n_b, len(groups), len(links), ";".join(groups),
         sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links))
        for (key, _), (n_a, n_b, groups, links) in zip(rows, found, strict=True)
    ]
    assert got == sorted(want, key=repr)
    return got


ODD = [
    None, "", " ", "  ", "a ", " a", "  a  b  ", "\n", "\n a\n  b\n\n", "a\tb", "tail\n", "a \n b", "▁x", "a▁b c", "x ▁",
    "<|endoftext|>", "a <|endoftext|> b", "<s> </s> <unk> <0x41> <0x0A>", "don't I'LL we've", "ﬁ ½ ´ é é Å",
    "汉字 kanji 日本", "🙂🙃 👩‍👩‍👧", "a b", "​", "\x00a\x1c b", "a\x1c b", "a　 b", "1234567890 12 1", "http://x.y/z?q=1",
    "Hello, World! The end.", "ÉCOLE naïve façade", "a  b", "́ a", "____ ----- ====", "x" * 300,
]


def test_odd_texts(spark, aligner):
    check(spark, list(enumerate(ODD)) + [(None, "no key"), (3, "twice"), (3, "twice")], aligner)


def test_random_texts(spark, aligner):
    rnd = random.Random(7)
    parts = ["the ", " of", "ing", "Tion", "é", "\n", "  ", "<|endoftext|>", "▁", "字", "🙂", "1", "23", "'s", ".", ",", "\t", "́", "-"]
    parts += [chr(rnd.randint(33, 0x2FFF)) for _ in range(60)]
    rows = [(i, "".join(rnd.choices(parts, k=rnd.choice([1, 4, 15, 60])))) for i in range(600)]
    rows += [(1000 + i, "the same text, again and again. " * 3) for i in range(40)]
    rows += [(2000, "a very long one, of many words " * 500)]
    got = check(spark, rows, aligner)
    assert sum(n > 0 for _, n, *_ in got) > 300


def test_generations_change_nothing(spark, aligner, monkeypatch):
    texts = [f"word{i} other{i % 7} thing" for i in range(40)]
    monkeypatch.setattr(alignment, "GENERATION", 5)
    small = alignment.Aligner(*PATHS)
    whole = slow(texts, aligner)
    for text, (n_a, n_b, groups, _) in zip(texts * 2, whole * 2, strict=True):
        found = [small.known({*small.units(text)})[u] for u in small.units(text)]
        assert (sum(f[0] for f in found), sum(f[1] for f in found)) == (n_a, n_b)
        assert ";".join(f[2] for f in found) == ";".join(groups)


def test_identity_groups_stay_out_of_the_pairs(spark, aligner):
    rows = [(1, "the and of to in"), (2, "zyzzyva qwrtpsdf")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    plain, odd, vector = sorted(alignment.align(df, *PATHS).collect(), key=lambda r: (r["row"] is None, r["row"]))
    assert plain["pairs"] == [] and sum(plain["same_times"]) == 5
    assert odd["pairs"] and vector["key"] is None and sum(vector["pair_times"]) == 5 + sum(odd["same_times"])
    ids = [(p >> 32, p & 0xFFFFFFFF) for p in vector["pairs"]]
    assert all(aligner.bytes_a[a] == aligner.bytes_b[b] for a, b in ids)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.score(alignment.align(df, *PATHS)).count() == 0


def test_query(spark, aligner):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.op11_alignment(spark, sf).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = slow([t for _, t in rows], aligner)
    assert len(got) == len(rows)
    for (key, _), (n_a, n_b, groups, links) in zip(rows, found, strict=True):
        digest = sha256(";".join(groups).encode()).hexdigest() if groups else ""
        r = got[key]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) == (n_a, n_b, len(groups), len(links), digest)
