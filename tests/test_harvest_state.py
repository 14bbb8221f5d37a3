"""Cycles in trees, catalogues that change, lanes, nested records and published parts against brute force."""

from __future__ import annotations

import heapq
import json
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanspark.operators import lanes, nested, snapshots, tree, typed
from gleanspark.session import materialize
from gleanspark.sinks import manifests, publish, read_published, run_in_parts, stage
from gleanspark.sources.fetch import fetch

# --- trees -----------------------------------------------------------------------------------


def brute_tree(rows):
    parents = {}
    for node, parent, _ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or "", r[2] is not None, r[2] or "")):
        parents.setdefault(node, parent)
    depths, cycles = {}, {}
    for node in parents:
        path, at = [], node
        while at is not None and at not in path:
            path.append(at)
            at = parents[at] if parents[at] in parents else None
        if at is None:
            depths[node] = len(path)
        else:
            ring = path[path.index(at) :]
            cycles[node] = ("cycle" if node in ring else "below", min(ring), len(ring))
    return depths, cycles


@pytest.mark.parametrize("seed", range(4))
def test_cycles_and_trees_by_brute_force(spark, seed):
    draw = random.Random(seed)
    names = [f"n{i:02d}" for i in range(40)]
    rows = [(n, draw.choice([None, "missing", *names] if seed else names), n.upper()) for n in names]
    rows += [rows[3], (names[5], names[6], "again"), (None, names[0], "nobody")]
    flat, stuck = tree.split_edges(spark.createDataFrame(rows, "node_id string, parent_id string, title string"))
    depths, cycles = brute_tree(rows)
    assert {r.node_id: r.depth for r in flat.collect()} == depths
    found = stuck.collect()
    assert len(found) == len(cycles) and {r.node_id: (r.kind, r.cycle_id, r.cycle_size) for r in found} == cycles


def test_a_long_chain_beside_a_ring(spark):
    chain = [(f"c{i:03d}", f"c{i - 1:03d}" if i else None, "t") for i in range(130)]
    ring = [(f"r{i:02d}", f"r{(i + 1) % 33:02d}", "t") for i in range(33)]
    edges = spark.createDataFrame([*chain, *ring, ("self", "self", "t")], "node_id string, parent_id string, title string")
    flat, stuck = tree.split_edges(edges)
    assert {r.node_id: r.depth for r in flat.collect()} == {f"c{i:03d}": i + 1 for i in range(130)}
    assert Counter((r.kind, r.cycle_id, r.cycle_size) for r in stuck.collect()) == {("cycle", "r00", 33): 33, ("cycle", "self", 1): 1}
    assert tree.tree_cycles(edges.where("node_id like 'c%'")).isEmpty()
    assert tree.flatten_edges(edges.limit(0)).isEmpty()


# --- snapshots -------------------------------------------------------------------------------


def test_a_package_seen_twice_counts_with_its_last_content(spark):
    schema = "id string, page_no int, title string, owner string"
    before = spark.createDataFrame([("a", 1, "x", None), ("b", 1, "x", "o"), ("c", 1, None, "o"), (None, 1, "n", "n")], schema)
    after = spark.createDataFrame([("a", 1, "y", None), ("a", 2, "x", None), ("c", 1, "", "o"), ("d", 1, "z", "o"), ("b", 1, "x", "o")], schema)
    content, order = ("title", "owner"), ("page_no",)
    old, new = snapshots.snapshot(before, content, order), snapshots.snapshot(after, content, order)
    assert {r.id: r.copies for r in new.collect()} == {"a": 2, "b": 1, "c": 1, "d": 1}
    assert {(r.id, r.change) for r in snapshots.snapshot_diff(old, new).collect()} == {("c", "changed"), ("d", "added")}
    every = {(r.id, r.change) for r in snapshots.snapshot_diff(new, old, unchanged=True).collect()}
    assert every == {("a", "unchanged"), ("b", "unchanged"), ("c", "changed"), ("d", "removed")}


def test_drift_counts_repeats_and_what_is_missing(spark):
    pages = spark.createDataFrame([("p", "a"), ("p", "a"), ("p", "b"), ("p", None), ("q", "a")], "portal string, id string")
    totals = spark.createDataFrame([("p", 5), ("q", 1), ("r", 2)], "portal string, total bigint")
    found = {r.portal: (r.seen, r.packages, r.repeated, r.missing) for r in snapshots.page_drift(pages, totals).collect()}
    assert found == {"p": (4, 2, 1, 3), "q": (1, 1, 0, 0), "r": (0, 0, 0, 2)}


# --- lanes -----------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(30))
def test_shares_are_those_of_one_item_at_a_time(seed):
    draw = np.random.default_rng(seed)
    loads, count, weight = draw.integers(0, 100, draw.integers(1, 12)).astype(float), int(draw.integers(1, 60)), float(draw.integers(1, 30))
    heap = [(x, i) for i, x in enumerate(loads)]
    heapq.heapify(heap)
    for _ in range(count):
        load, lane = heapq.heappop(heap)
        heapq.heappush(heap, (load + weight, lane))
    taken = lanes.shares(loads, count, weight)
    assert taken.sum() == count and taken.min() >= 0
    assert sorted(loads + taken * weight) == pytest.approx(sorted(x for x, _ in heap))


def test_lanes_are_near_equal_where_one_size_and_one_host_are_hot(spark):
    draw = random.Random(4)
    rows = [(f"https://hot.example/{i}", 1000) for i in range(400)] + [(f"https://h{i}.example/x", draw.randint(1, 20_000)) for i in range(600)]
    dealt = lanes.deal_lanes(spark.createDataFrame(rows, "url string, weight bigint"), 7).collect()
    assert sorted((r.url, r.weight) for r in dealt) == sorted(rows)
    sums, hot = Counter(), Counter()
    for r in dealt:
        sums[r.lane] += r.weight
        hot[r.lane] += "hot" in r.url
    mean = sum(sums.values()) / 7
    assert set(sums) == set(range(7)) and max(sums.values()) <= 1.1 * mean and min(sums.values()) >= 0.9 * mean


def test_lanes_of_few_items_and_of_none(spark):
    few = spark.createDataFrame([("a", 5), ("b", 5), ("c", 2**50)], "url string, weight bigint")
    assert sorted(r.lane for r in lanes.deal_lanes(few, 8).collect()) == sorted({r.lane for r in lanes.deal_lanes(few, 8).collect()})
    assert lanes.deal_lanes(few.limit(0), 8).count() == 0
    with pytest.raises(ValueError):
        lanes.deal_lanes(few, 0)


def test_a_lane_is_a_task(spark):
    work = spark.createDataFrame([(f"u/{i}", str(i * 1000) if i % 3 else "odd") for i in range(60)] + [("u/1", "5"), (None, "1")], "url string, size string")
    replies = fetch(work, lambda url, headers: (200, {}, url.encode()), 5, sizes="size").withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r.url for r in replies) == sorted(f"u/{i}" for i in range(60))
    weighed = work.where("url is not null").groupBy("url").agg(F.max(F.col("size").try_cast("bigint")).alias("s"))
    dealt = lanes.deal_lanes(weighed.select("url", lanes.expected_weight("s").alias("weight")), 5).collect()
    assert {r.url: r.task for r in replies} == {r.url: r.lane for r in dealt}


# --- nested records --------------------------------------------------------------------------


def test_types_come_from_all_rows(spark):
    texts = [{"b": 1, "a": {"x": 1}, "odd `name`": [1]}, {"a": {"y": "t"}, "b": 2.5, "c": None}, {"b": 3, "odd `name`": ["s"], "VOID": True}]
    rows = [(i, json.dumps(t)) for i, t in enumerate(texts)] + [(3, "[1]"), (4, "no json"), (5, None), (6, "{}")]
    records = spark.createDataFrame(rows, "row int, record string")
    frame = nested.nested_frame(records, order="row")
    assert frame.columns == ["b", "a", "odd `name`", "c", "VOID"]
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema}
    assert kinds == {"b": "double", "a": "struct<x:bigint,y:string>", "odd `name`": "array<string>", "c": "string", "VOID": "boolean"}
    got = frame.collect()
    assert [r["b"] for r in got] == [1.0, 2.5, 3.0, None, None, None, None]
    assert got[0]["a"].x == 1 and got[1]["a"].y == "t" and got[2]["odd `name`"] == ["s"]


def test_values_of_several_kinds_are_text(spark):
    rows = [(json.dumps({"v": v}),) for v in (1, "t", {"k": [1]}, None)]
    frame = nested.nested_frame(spark.createDataFrame(rows, "record string"))
    assert [r["v"] for r in frame.collect()] == ["1", "t", '{"k":[1]}', None]
    assert nested.nested_frame(spark.createDataFrame([], "record string")).columns == []


def test_each_dataset_has_its_own_schema(spark):
    rows = [("a", '{"y":1,"x":true}'), ("b", '{"y":"t"}'), ("a", '{"y":2,"z":[{"k":1}]}'), (None, '{"q":1}'), ("c", "[]")]
    found = {r.dataset_id: r for r in nested.infer_nested(spark.createDataFrame(rows, "dataset_id string, record string")).collect()}
    assert set(found) == {"a", "b", None} or set(found) == {"a", "b"}
    assert found["a"].header == ["y", "x", "z"]
    assert nested.settled_type(found["a"].schema) == "STRUCT<x: BOOLEAN, y: BIGINT, z: ARRAY<STRUCT<k: BIGINT>>>"
    assert nested.settled_type("OBJECT<VOID: VOID, a: OBJECT<>, `OBJECT<`: DECIMAL(3,1)>") == "STRUCT<VOID: STRING, a: STRING, `OBJECT<`: DOUBLE>"


def test_columns_of_flat_records_keep_their_order(spark):
    rows = [(1, '{"zeta": "1", "alpha": "x"}'), (2, '{"zeta": "2", "alpha": "", "mid": "1.5"}')]
    records = spark.createDataFrame(rows, "row_idx bigint, record string")
    frame = typed.records_to_df(records.withColumn("record", F.from_json("record", "map<string,string>")))
    assert [(f.name, f.dataType.simpleString()) for f in frame.schema] == [("zeta", "bigint"), ("alpha", "string"), ("mid", "double")]


# --- published parts -------------------------------------------------------------------------

SCHEMA = "storage_key string, run string"


def step_of(run):
    return lambda rows: rows.select("storage_key", F.lit(run).alias("run"))


def test_a_killed_run_leaves_nothing_half_seen(spark, tmp_path):
    destination = str(tmp_path)
    work = spark.createDataFrame([(f"k{i}",) for i in range(50)], "storage_key string")
    assert read_published(spark, destination, SCHEMA).isEmpty()
    killed = []

    def kill(part):
        killed.append(part)
        if len(killed) == 3:
            raise InterruptedError

    with pytest.raises(InterruptedError):
        run_in_parts(work, step_of("one"), destination, "one", SCHEMA, 5, before_publish=kill)
    seen = read_published(spark, destination, SCHEMA).count()
    assert 0 < seen < 50 and manifests(spark, destination).count() == 2
    more = work.unionByName(spark.createDataFrame([("new",)], "storage_key string"))
    done = run_in_parts(more, step_of("two"), destination, "two", SCHEMA, 5).collect()
    assert sorted(r.storage_key for r in done) == sorted([*(f"k{i}" for i in range(50)), "new"])
    assert Counter(r.run for r in done)["one"] == seen
    # Nothing is left to do.
    assert run_in_parts(more, step_of("three"), destination, "three", SCHEMA, 5).where("run = 'three'").isEmpty()


def test_the_last_manifest_of_a_name_counts(spark, tmp_path):
    destination = str(tmp_path)
    for run in ("old", "new"):
        publish(spark, destination, "same", stage(spark.createDataFrame([("k", run)], SCHEMA), destination, "same"))
    stage(spark.createDataFrame([("k", "unseen")], SCHEMA), destination, "other")
    assert [tuple(r) for r in read_published(spark, destination, SCHEMA).collect()] == [("k", "new")]
    assert [r.rows for r in manifests(spark, destination).collect()] == [1]


def test_walks_write_leaves_once_and_end_with_their_cycles(spark, monkeypatch):
    """Rounds go by the longest way round or into a cycle, and over folders alone."""
    rows = [(f"c{i:04}", f"c{(i // 3) * 3 + (i + 1) % 3:04}", None) for i in range(300)]
    rows += [(f"t{i:04}", f"t{i - 1:04}" if i % 20 else f"c{i % 300:04}", None) for i in range(400)]
    rows += [("z", "z", None), ("r", None, "R")] + [(f"f{i}", f"f{i - 1}" if i else "r", f"F{i}") for i in range(9)]
    rows += [(f"l{i:05}", ("c0005", "t0019", "f8", "r", "z")[i % 5], "leaf") for i in range(5000)]
    written = []

    def count(df, options=None):
        found = materialize(df, options)
        written.append(found.count())
        return found

    monkeypatch.setattr(tree, "materialize", count)
    flat, stuck = tree.split_edges(spark.createDataFrame(rows, "node_id string, parent_id string, title string"))
    flat, stuck = {r.node_id: r for r in flat.collect()}, {r.node_id: r for r in stuck.collect()}
    assert len(flat) == 10 + 2000 and len(stuck) == 701 + 3000
    assert flat["l00002"].path == ["R", *(f"F{i}" for i in range(9))] and flat["l00003"].path == ["R"] and flat["l00002"].is_leaf
    assert (stuck["c0299"].kind, stuck["c0299"].cycle_id, stuck["c0299"].cycle_size) == ("cycle", "c0297", 3)
    assert (stuck["t0039"].kind, stuck["t0039"].cycle_id) == ("below", "c0018") and stuck["z"].cycle_size == 1
    assert [(stuck[f"l{i:05}"].kind, stuck[f"l{i:05}"].cycle_id) for i in (0, 1, 4)] == [("below", "c0003"), ("below", "c0000"), ("below", "z")]
    assert sum(written) < 3 * len(rows) + 10 * 701
