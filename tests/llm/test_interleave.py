"""Stratified sharding against a plain ranking, and what every shard must look like."""

from collections import Counter
from hashlib import md5
from math import floor

from threadloom.llm import interleave


def slow(rows, n_shards, seed=interleave.SEED):
    """Rows (key, source, weight) to (row, shard, slot)."""
    number = lambda text: int(md5(text.encode()).hexdigest()[:13], 16) / 16**13
    show = lambda v: "" if v is None else str(v)
    low = lambda row: tuple((v is not None, v or 0) for v in row)
    seen, strata = Counter(), {}
    for row in rows:
        token = md5("|".join([str(seed), *map(show, row), str(seen[row])]).encode()).hexdigest()
        name = "null" if row[1] is None else "=" + row[1]
        strata.setdefault(name, []).append((token, [(v is not None, v or type(v or 0)()) for v in row], seen[row], row))
        seen[row] += 1
    order = []
    for name, members in strata.items():
        members.sort(key=lambda m: (m[0], low(m[3]), m[2]))
        phase = number(f"{seed}|{name}")
        order += [((i + phase) / len(members), name, i, m[3]) for i, m in enumerate(members)]
    order.sort(key=lambda o: o[:3])
    total, out, sizes = len(order), [], Counter()
    for position, (_, _, _, row) in enumerate(order):
        shard = floor(position * n_shards / total)
        out.append((row, shard, sizes[shard]))
        sizes[shard] += 1
    return out


def placed(df, n_shards, **options):
    rows = interleave.interleave(df, n_shards, **options).collect()
    return sorted(((tuple(r["row"]), r["shard"], r["slot"]) for r in rows), key=repr)


def test_matches_plain_ranking(spark, monkeypatch):
    rows = [(i, f"s{i % 7}", i % 3) for i in range(400)]
    rows += [(1000 + i, "hot", 0) for i in range(500)]
    rows += [(7, "copies", 1)] * 300 + [(None, None, None)] * 5 + [(9, None, 1), (9, "", 1), (9, "null", 1)]
    rows += [(5000 + i, f"single{i}", 0) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, shard string, slot int").repartition(5)
    want = sorted(slow(rows, 24), key=repr)
    assert placed(df, 24, stratum="shard") == want
    # the parts of the plan change nothing
    monkeypatch.setattr(interleave, "BUCKETS", 5)
    monkeypatch.setattr(interleave, "COPIES_TOGETHER", 64)
    assert placed(df.repartition(2), 24, stratum="shard") == want


def test_shards_match_the_mixture(spark):
    rows = [(i, "big" if i % 3 else f"s{i % 5}") for i in range(3000)]
    out = placed(spark.createDataFrame(rows, "doc_id long, source string"), 7)
    assert sorted(r for r, _, _ in out) == sorted(rows)
    sizes = Counter(s for _, s, _ in out)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(7):
        assert sorted(n for _, s, n in out if s == shard) == list(range(sizes[shard]))
    total = Counter(source for _, source in rows)
    for (source, _), n in Counter((r[1], s) for r, s, _ in out).items():
        assert abs(n - total[source] / 7) <= 2, source


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, source string")
    assert placed(empty, 3) == []
    few = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, source string")
    assert sorted(s for _, s, _ in placed(few, 24)) == [0, 12]
    assert placed(few, 1)[0][1:] in ((0, 0), (0, 1))
    assert placed(few, 2, seed=1) == placed(few.repartition(2), 2, seed=1)
    long = spark.createDataFrame([(1, "a", "x" * 300_000, [1]), (1, "a", "", None)], "doc_id long, source string, text string, more array<int>")
    assert len(placed(long, 2)) == 2


def test_files(spark, tmp_path):
    rows = [(i, f"s{i % 4}", "text " * (i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    interleave.write_shards(df, 6, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    got = sorted(((tuple(r["row"]), r["shard"], r["slot"]) for r in back.collect()), key=repr)
    assert got == placed(df, 6)


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, source string")
    plan = interleave.interleave(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
