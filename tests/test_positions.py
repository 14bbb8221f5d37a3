"""Positions, limits, roll-ups and joins, with one key holding a large share."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gleanspark.operators import positions, resources


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows; key 0 holds a third of them, null keys a tenth."""
    ids = spark.range(3000).withColumn("n", (F.col("id") * 7919) % 3001)
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 50)
    return ids.withColumn("k", key.cast("int")).select("k", "n", F.concat(F.lit("v"), "id").alias("v")).persist()


def expected_positions(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["k"]].append(r["n"])
    return {(k, n): (i + 1, len(ns)) for k, ns in groups.items() for i, n in enumerate(sorted(ns))}


@pytest.mark.parametrize("ranges", [1, 7, None])
def test_positions_equal_brute_force(skewed, ranges):
    df = positions.with_position(skewed, ("n",), ("k",), ranges)
    found = {(r["k"], r["n"]): (r["position"], r["group_rows"]) for r in df.collect()}
    assert found == expected_positions(skewed.collect())


def test_hot_key_is_cut_into_ranges(skewed, monkeypatch):
    written = []
    real = positions.materialize
    monkeypatch.setattr(positions, "materialize", lambda df: written.append(real(df)) or written[-1])
    assert positions.with_position(skewed, ("n",), ("k",), 30).count() == 3000
    sizes = [r["count"] for r in written[0].where("k = 0").groupBy("_range").count().collect()]
    assert len(sizes) > 5 and max(sizes) < 300  # the hot key alone has over 1000 rows


def test_full_copies_are_cut_into_ranges(spark, monkeypatch):
    written = []
    real = positions.materialize
    monkeypatch.setattr(positions, "materialize", lambda df: written.append(real(df)) or written[-1])
    copies = spark.range(1000).selectExpr("7L AS k", "3L AS n").unionByName(spark.range(2000).selectExpr("id % 5 AS k", "id AS n"))
    rows = positions.with_position(copies, ("n",), ("k",), 30).where("k = 7").collect()
    assert sorted(r["position"] for r in rows) == list(range(1, 1001))
    sizes = [r["count"] for r in written[0].where("k = 7").groupBy("_range").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 400


@pytest.mark.parametrize("limit,offset", [(100, 50), (None, 2900), (-1, 0), (5000, 0), (0, 0), (10, 5000)])
def test_limit_ordered(skewed, limit, offset):
    found = [r["n"] for r in positions.limit_ordered(skewed, ("n",), limit, offset).collect()]
    everything = sorted(r["n"] for r in skewed.collect())
    end = None if limit in (None, -1) else offset + limit
    assert sorted(found) == everything[offset:end]


@pytest.mark.parametrize("limit,offset", [(5, 0), (5, 3), (1500, 2), (-1, 4), (-1, 0)])
def test_limit_rows(skewed, limit, offset):
    found = defaultdict(list)
    for r in positions.limit_rows(skewed, ("k",), ("n",), limit, offset).collect():
        found[r["k"]].append(r["n"])
    groups = defaultdict(list)
    for r in skewed.collect():
        groups[r["k"]].append(r["n"])
    end = None if limit == -1 else offset + limit
    expected = {k: sorted(ns)[offset:end] for k, ns in groups.items()}
    assert {k: sorted(v) for k, v in found.items()} == {k: v for k, v in expected.items() if v}


def test_limit_indexed_rows(spark):
    rows = spark.range(10).withColumnRenamed("id", "row_idx")
    assert [r[0] for r in positions.limit_indexed_rows(rows, 3, 2).collect()] == [2, 3, 4]
    assert positions.limit_indexed_rows(rows, -1, 4).count() == 6


@pytest.mark.parametrize("limit,offset,parts", [(5, 0, 1), (20, 7, 5), (100, 90, 3), (-1, 60, 4)])
def test_tied_orders_keep_their_limit(spark, limit, offset, parts):
    rows = spark.range(400).selectExpr("CAST(id % 3 AS INT) AS k", "1 AS n", "id AS v").repartition(parts)
    cut = positions.limit_rows(rows, ("k",), ("n",), limit, offset).collect()
    sizes = {0: 134, 1: 133, 2: 133}
    expected = {k: n - offset if limit == -1 else min(limit, n - offset) for k, n in sizes.items()}
    assert Counter(r["k"] for r in cut) == expected and len({r["v"] for r in cut}) == len(cut)


def test_rolled_up_packages_count_their_resources(skewed):
    rolled = resources.rollup_packages(skewed, "k").collect()
    sizes = Counter(r["k"] for r in skewed.collect() if r["k"] is not None)
    assert Counter(r["k"] for r in rolled) == sizes
    assert all(r["num_resources"] == sizes[r["k"]] for r in rolled)


def test_last_writer_wins(spark):
    rows = [("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z"), (None, 3, "n")]
    df = spark.createDataFrame(rows, "key string, pos int, v string")
    found = {tuple(r) for r in positions.last_writer_wins(df, ("key",), ("pos",)).collect()}
    assert found == {("a", 1, "y"), ("b", 0, "z"), (None, 3, "n")}


def test_pending_work_and_keep_accepted(spark):
    work = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1)], "storage_key string, n int")
    done = spark.createDataFrame([("a",), ("a",), ("z",)], "storage_key string")
    assert {tuple(r) for r in resources.pending_work(work, done).collect()} == {("b", 1), ("c", 1)}
    rows = spark.createDataFrame([(1, "a/b"), (1, "a-b"), (2, "a/b")], "package_id int, id string")
    accepted = spark.createDataFrame([(1, "a/b")], "package_id int, id string")
    assert [tuple(r) for r in resources.keep_accepted(rows, accepted).collect()] == [(1, "a/b")]
