"""Queries over groups that no row can hold."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import types as T

from threadloom.operators import listing
from threadloom.plans import catalog
from threadloom.plans.catalog import QUERIES

ANSWERS, COMMENTS = 40, 300


@pytest.fixture
def tables(spark, tmp_path, monkeypatch):
    """One hot question, one hot answer; a row holds less than either, a part 20 of a group."""
    monkeypatch.setattr(listing, "ROW_BYTES", 2048)
    monkeypatch.setattr(listing, "MAX_GROUP", 20)
    monkeypatch.setattr("threadloom.operators.threads.MAX_GROUP", 20)
    monkeypatch.setattr(catalog, "MAX_GROUP", 20, raising=False)
    day = datetime.datetime(2020, 1, 1)
    shapes = {
        "customer": (
            "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
            [(1, "one", 1, 1.0, "A"), (2, "two", 1, 1.0, "B")],
        ),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
            "o_orderdate timestamp_ntz, o_orderpriority string",
            [(i, 1, "O", 10.0, day, "low") for i in range(1, ANSWERS + 1)],
        ),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, "
            "l_linestatus string, l_shipdate timestamp_ntz",
            [(2, i, 1, 1, "ARN"[i % 3], "O", day) for i in range(COMMENTS)],
        ),
        "supplier": (
            "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
            [(1, "s", 1, 1.0)],
        ),
    }
    for name, (schema, rows) in shapes.items():
        spark.createDataFrame(rows, T.StructType.fromDDL(schema)).write.parquet(
            str(tmp_path / f"{name}.parquet")
        )
    return str(tmp_path)


def test_hot_comments(spark, tables):
    rows = {r["id"]: r for r in QUERIES["e2_nest_hot_comments"](spark, tables).collect()}
    assert len(rows) == 2 + ANSWERS + 1
    assert [rows[i]["n_comments"] for i in ("o1", "c1", "o2", "o3")] == [100, 100, 100, 0]
    assert [rows[i]["least"] for i in ("o1", "c1", "o3")] == ["2-1-0", "2-1-1", None]


def test_hot_thread(spark, tables):
    found = {r["thread_key"]: r for r in QUERIES["e4_hot_thread"](spark, tables).collect()}
    assert tuple(found["c1"]) == ("c1", ANSWERS, "o1", 200, 100)
    assert tuple(found["c2"]) == ("c2", 0, None, 0, 0)
