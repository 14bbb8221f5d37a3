"""Scans: catalogue pages, fetch, archives, CSV, topic trees, datasets, indicators."""

from __future__ import annotations

import io
import json
import zipfile
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleanspark import queries
from gleanspark.operators import tree, typed
from gleanspark.sources import catalog, datasets, indicators, payloads, topics
from gleanspark.sources.fetch import fetch
from gleanspark.sources.portals import portals


def archive(**members: bytes) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as packed:
        for name, data in members.items():
            packed.writestr(name, data)
    return buffer.getvalue()


def test_portals(spark):
    rows = {r["portal"]: r for r in portals(spark, [("mine", "ckan", "http://m", "/a"), ("uk", "ckan", "http://u", "/b")]).collect()}
    assert len(rows) == 9 and rows["uk"]["base_url"] == "http://u" and rows["nyc"]["family"] == "socrata"


@pytest.mark.parametrize(
    "total,start,most,batch,expected",
    [
        (10, 0, None, 4, [(0, 0, 4), (1, 4, 4), (2, 8, 2)]),
        (10, 8, 5, 4, [(0, 8, 2)]),
        (10, 2, 5, 5, [(0, 2, 5)]),
        (10, 10, None, 4, []),
        (0, 0, None, 4, []),
    ],
)
def test_page_plan(spark, total, start, most, batch, expected):
    totals = spark.createDataFrame([("p", total)], "portal string, total bigint")
    plan = catalog.catalog_page_plan(totals, start, most, batch)
    assert sorted((r["page_no"], r["start"], r["rows"]) for r in plan.collect()) == expected


def test_scan_packages_and_errors(spark):
    good = {"result": {"count": 2, "results": [
        {"id": "p1", "extra": {"a": [1]}, "resources": [{"id": "r1", "url": "u", "name": None, "format": "CSV", "language": ["en"]}]},
        {"id": "p2", "resources": []},
    ]}}
    pages = spark.createDataFrame(
        [(0, 200, json.dumps(good)), (1, 200, "<html>"), (2, 500, json.dumps(good)), (3, 200, None), (4, 200, '{"result":{}}')],
        "page_no int, status int, body string",
    )
    found = catalog.scan_packages(pages).select(
        "page_no", "package_pos", "package_id", F.size("resources"), F.to_json("package")
    ).collect()
    assert [tuple(r)[:4] for r in found] == [(0, 0, "p1", 1), (0, 1, "p2", 0)]
    assert json.loads(found[0][4])["extra"] == {"a": [1]}
    assert sorted(r["page_no"] for r in catalog.page_errors(pages).collect()) == [1, 2, 3, 4]
    assert catalog.explode_resources(catalog.scan_packages(pages)).count() == 1
    assert catalog.catalog_total(pages).first()["total"] == 2


def test_lookups(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "a", "x")], "id int, kind string, tag string")
    assert [r["id"] for r in catalog.matching(df, {"kind": "a", "tag": None}).collect()] == [1]
    assert sorted(r["id"] for r in catalog.matching(df, {"kind": ["a", "b"], "tag": "x"}).collect()) == [2, 3]
    assert catalog.package_show(df, 2).count() == 1
    assert catalog.resource_show(df, spark.createDataFrame([(1,), (1,), (3,)], "id int")).count() == 2
    assert catalog.package_list(df).columns == ["id"]
    assert [r["id"] for r in catalog.package_search(df, 1, 1, kind="a").collect()] == [3]


def test_fetch_isolates_errors_and_reads_headers_first(spark):
    def transport(url, headers):
        if url == "boom":
            raise ConnectionError("refused")
        if url == "big":
            return 200, {"Content-Length": "101"}, lambda: 1 / 0
        if url == "odd":
            return 200, {"content-length": "abc"}, b""
        if url == "gone":
            return 404, {}, b"x"
        return 200, {"Content-Length": "3", "X": headers["agent"]}, b"abc"

    work = spark.createDataFrame([(u,) for u in ("boom", "big", "odd", "gone", "ok", "ok", None)], "url string")
    rows = {r["url"]: r for r in fetch(work, transport, 3, {"agent": "me"}, 100).collect()}
    assert len(rows) == 5
    assert rows["ok"]["ok"] and rows["ok"]["content"] == b"abc" and rows["ok"]["headers"]["x"] == "me"
    assert rows["big"]["error_type"] == "TooLargeResourceError" and rows["big"]["content"] is None
    assert (rows["boom"]["error_type"], rows["boom"]["error_text"]) == ("ConnectionError", "refused")
    assert rows["odd"]["error_type"] == "ValueError" and rows["gone"]["status"] == 404


def test_expand_archive(spark):
    content = archive(**{"a.csv": b"1", "B.CSV": b"2", "n.txt": b"3", "d/e.csv": b"4", "../evil.csv": b"5", "empty.csv": b""})
    rows = [("all", content), ("none", archive(**{"x.txt": b""})), ("bad", b"PK\x03\x04junk"), ("cut", content[:-30])]
    df = spark.createDataFrame(rows, "storage_key string, content binary")
    found = payloads.expand_archive(df, ".csv").collect()
    members = {r["member"]: bytes(r["data"]) for r in found if r["storage_key"] == "all"}
    assert members == {"a.csv": b"1", "d/e.csv": b"4", "../evil.csv": b"5", "empty.csv": b""}
    assert {r["storage_key"] for r in found if r["error_text"]} == {"bad", "cut"}
    assert payloads.expand_archive(df.where("storage_key = 'all'")).count() == 6


def test_large_member_comes_in_parts(spark):
    data = bytes(range(256)) * 10
    df = spark.createDataFrame([("k", archive(**{"a.csv": data}))], "storage_key string, content binary")
    parts = payloads.expand_archive(df, ".csv", part_bytes=1000).orderBy("part_no").collect()
    assert [r["part_no"] for r in parts] == [0, 1, 2]
    assert b"".join(bytes(r["data"]) for r in parts) == data


def decoded(spark, content, **options):
    df = spark.createDataFrame([("k", content)], "dataset_id string, content binary")
    return [r["record"] for r in payloads.decode_csv(df, **options).orderBy("row_idx").collect()]


def test_decode_csv(spark):
    assert decoded(spark, b"a,b\n1\n2,x,extra\n") == [
        {"a": "1", "b": None},
        {"a": "2", "b": "x", "_extra": "extra"},
    ]
    assert decoded(spark, b'a\n1\n2,"x,y",z\n') == [{"a": "1"}, {"a": "2", "_extra": '"x,y",z'}]
    assert decoded(spark, b"a\n1\n2\nbad\n2.5\n") == [{"a": "1"}, {"a": "2"}, {"a": "bad"}, {"a": "2.5"}]
    assert decoded(spark, b"a\n1\nbad\n") == [{"a": "1"}, {"a": "bad"}]
    assert decoded(spark, b"a\n1.5\n2\n") == [{"a": "1.5"}, {"a": "2"}]
    assert decoded(spark, b"\xef\xbb\xbfa,a\n1,2\n") == [{"a": "1", "a_duplicated_0": "2"}]
    assert decoded(spark, b'a\n"x\ny"\n') == [{"a": "x\ny"}]
    assert decoded(spark, b"a,b\n") == [] and decoded(spark, b"") == []
    assert len(decoded(spark, b"a\n" + b"7\n" * 5001)) == 5001


def test_decode_archives(spark):
    good = archive(**{"a.csv": b"n\n1\n2\n", "b.txt": b"n\n3\n", "c.csv": b"n\nx\n"})
    df = spark.createDataFrame([("k", good), ("bad", b"PK\x03\x04"), ("cut", good[:-20])], "dataset_id string, content binary")
    found = payloads.decode_archives(df).collect()
    assert {r["dataset_id"] for r in found if r["error_text"]} == {"bad", "cut"}
    rows = {tuple(r)[:3] + (r["record"]["n"],) for r in found if not r["error_text"]}
    assert rows == {("k", "a.csv", 0, "1"), ("k", "a.csv", 1, "2"), ("k", "c.csv", 0, "x")}
    damaged = bytearray(good)
    damaged[good.index(b"n\n1") + 2] ^= 1
    df = df.unionByName(spark.createDataFrame([("crc", bytes(damaged)), ("none", None)], "dataset_id string, content binary"))
    assert {r["dataset_id"] for r in payloads.check_archives(df, "dataset_id").collect()} == {"bad", "cut", "crc", "none"}


def test_long_cell(spark):
    cell = "x" * 300_000
    assert decoded(spark, f"a\n{cell}\n".encode()) == [{"a": cell}]


def test_read_csv_table(spark, tmp_path):
    (tmp_path / "t.csv").write_text("n,s\n1,x\n2,y,long\n3\nbad,z\n")
    rows = [tuple(r) for r in payloads.read_csv_table(spark, str(tmp_path)).collect()]
    assert rows == [("1", "x"), ("2", "y"), ("3", None), ("bad", "z")]


def test_scan_payloads(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "k.csv").write_bytes(b"a\n1\n")
    assert [bytes(r["content"]) for r in payloads.scan_payloads(spark, str(tmp_path)).collect()] == [b"a\n1\n"]


def node(label, children=(), data_filter=""):
    return {"label": f'<span class="node">{label}</span>', "childNodes": list(children), "dataFilter": data_filter}


def chain(depth):
    inner = node(f"leaf{depth}", (), f"docID:{depth}")
    for level in range(depth - 1, 0, -1):
        inner = node(f"f{level}", [inner])
    return inner


def test_mart_leaves_at_any_depth(spark):
    body = "{Nodes:" + json.dumps([chain(d) for d in (1, 2, 5, 11)] + [node("no filter")]) + "}"
    marts = spark.createDataFrame([("m", body), ("bad", "nothing")], "mart_id string, body string")
    leaves = topics.scan_mart_leaves(marts)
    found = {r["name"]: (r["path"], r["depth"], r["data_filter"]) for r in leaves.collect()}
    assert set(found) == {"leaf1", "leaf2", "leaf5", "leaf11", "no filter"}
    assert found["leaf1"] == ([], 1, "docID:1")
    assert found["leaf11"] == ([f"f{i}" for i in range(1, 11)], 11, "docID:11")
    usable = {r["name"]: r["dataset_id"] for r in topics.usable_leaves(leaves).collect()}
    assert usable == {"leaf1": "1", "leaf2": "2", "leaf5": "5", "leaf11": "11"}
    assert [r["mart_id"] for r in topics.reply_errors(marts).collect()] == ["bad"]


def test_odd_children_of_a_folder(spark):
    odd = [None, "x", node("bare", [], "a"), {"childNodes": {"a": 1}}, {"label": 3, "childNodes": None}, node("f", [None, node("g", [])])]
    bodies = ["{Nodes:" + json.dumps([node("top", odd)]) + "}", "{Nodes:" + json.dumps([None, node("{Nodes:")]) + "}", "{Nodes:[]}", None]
    marts = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "mart_id string, body string")
    found = [(r.mart_id, r.name, "/".join(r.path), r.depth, r.data_filter) for r in topics.scan_mart_leaves(marts).collect()]
    none = [("0", None, "top", 2, None)] * 4
    rest = [("0", "bare", "top", 2, "a"), ("0", None, "top/f", 3, None), ("0", "g", "top/f", 3, ""), ("1", None, "", 1, None), ("1", "{Nodes:", "", 1, "")]
    assert sorted(map(repr, found)) == sorted(map(repr, none + rest))


def test_usable_leaves_of_any_name_length(spark):
    rows = [("n" * 255, "f", "m"), ("n" * 256, "f", "m"), ("x", "", "m"), ("x", None, "m")]
    df = spark.createDataFrame(rows, "name string, data_filter string, mart_id string")
    assert [len(r["name"]) for r in topics.usable_leaves(df).collect()] == [255, 256]


def test_scan_topics_skips_leading_nodes(spark):
    def topic(i):
        mart = {"label": f'<span class="martOwner">o{i}</span> <span class="martName"> n{i} </span>', "martId": f"m{i}"}
        return {"label": f'<span class="topic">t{i}</span>', "childNodes": [mart]}

    def reply(count):
        return ("{Nodes:" + json.dumps([topic(i) for i in range(count)]) + "}",)

    df = spark.createDataFrame([reply(7), reply(4)], "body string")
    assert [tuple(r) for r in topics.scan_topics(df).collect()] == [("t5", "o5", "n5", "m5"), ("t6", "o6", "n6", "m6")]


def test_leaves_and_topics_are_not_broadcast(spark):
    marts = spark.createDataFrame([("m0", "{Nodes:" + json.dumps([chain(3)]) + "}")], "mart_id string, body string")
    mart = {"label": '<span class="martOwner">o</span><span class="martName">n</span>', "martId": "m0"}
    reply = {"label": '<span class="topic">t</span>', "childNodes": [mart]}
    explorer = spark.createDataFrame([("{Nodes:" + json.dumps([reply]) + "}",)], "body string")
    found = topics.scan_topic_tree(explorer, marts, 0)
    assert [(r["topic"], r["name"], r["path"]) for r in found.collect()] == [("t", "leaf3", ["f1", "f2"])]
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_edges(spark):
    rows = [("r", None, "R")] + [(f"d{i}", "r" if i == 0 else f"d{i - 1}", f"D{i}") for i in range(9)]
    rows += [("orphan", "missing", "O"), ("below", "orphan", "B")]
    flat = {r["node_id"]: r for r in tree.flatten_edges(spark.createDataFrame(rows, "node_id string, parent_id string, title string")).collect()}
    assert len(flat) == 12 and flat["orphan"]["path"] == [] and flat["below"]["path"] == ["O"]
    assert flat["d8"]["path"] == ["R"] + [f"D{i}" for i in range(8)]
    assert flat["d8"]["depth"] == 10 and flat["d8"]["is_leaf"] and not flat["d7"]["is_leaf"]


def test_record_pages_and_limits(spark):
    pages = spark.createDataFrame(
        [("d", 0, '[{"a":"1"},{"a":"2"}]'), ("d", 2, '[{"a":"3"}]'), ("e", 0, "[]")],
        "dataset_id string, offset bigint, body string",
    )
    rows = datasets.parse_record_pages(pages)
    assert sorted((r["row_idx"], r["record"]["a"]) for r in rows.collect()) == [(0, "1"), (1, "2"), (2, "3")]
    assert [r["row_idx"] for r in datasets.scan_dataset_rows(rows, "d", 1, 2).collect()] == [2]
    assert datasets.scan_dataset_rows(rows, limit=-1).count() == 3


def test_dataset_query(spark):
    df = spark.createDataFrame([(i, i % 2, float(i)) for i in range(10)], "id int, k int, v double")
    found = datasets.dataset_query(df, ("id", "v + 1 AS w"), "v >= 3", order=("id",), limit=2, offset=1, k=1)
    assert [tuple(r) for r in found.collect()] == [(5, 6.0), (7, 8.0)]
    grouped = datasets.dataset_query(df, ("sum(v) AS s",), group=("k",), order=("k",))
    assert [tuple(r) for r in grouped.collect()] == [(0, 20.0), (1, 25.0)]
    with pytest.raises(ValueError):
        datasets.dataset_query(df, limit=3)


@pytest.mark.parametrize(
    "wire,body",
    [
        ("csv", "a,b\n1,x\n2,\n"),
        ("xml", "<rows><row><a>1</a><b>x</b></row><row><a>2</a></row></rows>"),
        ("xml", "<response><row><row><a>1</a><b>x</b></row><row><a>2</a></row></row></response>"),
    ],
)
def test_record_pages_in_other_wire_formats(spark, wire, body):
    pages = spark.createDataFrame([("d", 10, body)], "dataset_id string, offset bigint, body string")
    rows = sorted((r["row_idx"], r["dataset_id"], r["record"]["a"], r["record"].get("b")) for r in datasets.parse_record_pages(pages, wire).collect())
    assert rows == [(10, "d", "1", "x"), (11, "d", "2", None)]


@pytest.mark.parametrize(
    "wire,text", [("csv", "a,b\n1,x\n"), ("json", '[{"a": 1, "b": "x"}]'), ("xml", "<rows><row><a>1</a><b>x</b></row></rows>")]
)
def test_read_dataset_files(spark, tmp_path, wire, text):
    (tmp_path / f"d.{wire}").write_text(text)
    df = datasets.read_dataset_files(spark, str(tmp_path), wire)
    assert [tuple(r) for r in df.select("a", "b").collect()] == [("1", "x")]


def test_records_to_df_infers_over_all_rows(spark):
    rows = [(i, {"i": str(i), "f": "1.5" if i else "1", "b": "true", "s": "x" if i == 9 else "1", "e": ""}) for i in range(10)]
    # Keys keep their order in JSON, not on the way from Python to the JVM.
    records = spark.createDataFrame([(i, json.dumps(r)) for i, r in rows], "row_idx bigint, record string")
    frame = typed.records_to_df(records.withColumn("record", F.from_json("record", "map<string,string>")))
    assert frame.schema.simpleString() == "struct<i:bigint,f:double,b:boolean,s:string,e:string>"
    assert frame.where("i = 3 and f = 1.5").count() == 1


def test_typed_cells_without_entry_stay_strings(spark):
    rows = spark.createDataFrame([("d", 0, {"a": "1"})], "dataset_id string, row_idx bigint, record map<string,string>")
    entries = spark.createDataFrame(
        [("other", ["a"], ["number"], [None])],
        "dataset_id string, columns_field_name array<string>, columns_datatype array<string>, columns_format array<map<string,string>>",
    )
    assert [(r["name"], r["type"], r["text_value"]) for r in typed.typed_cells(rows, entries).collect()] == [("a", "string", "1")]


def test_indicators(spark):
    hits = {"value": [{"series_description": {"database_id": d}} for d in ("A", "A", "", None, "B")]}
    replies = spark.createDataFrame([(json.dumps(hits),)], "body string")
    assert sorted(r[0] for r in indicators.scan_database_ids(replies).collect()) == ["A", "B"]
    lists = spark.createDataFrame(
        [("A", 200, '["x","y"]'), ("B", 500, "err"), ("C", 200, "not json")], "database_id string, status int, body string"
    )
    listed = indicators.scan_indicators(lists)
    assert sorted(tuple(r) for r in listed.collect()) == [("A", "x"), ("A", "y")]
    assert sorted(r["database_id"] for r in indicators.list_errors(lists).collect()) == ["B", "C"]
    work = indicators.indicator_resources(listed.where("indicator_id = 'x'"))
    assert sorted(tuple(r)[2:] for r in work.collect()) == [
        ("data", "https://data360files.worldbank.org/data360-data/data/A/x.csv", "data/A/x.csv"),
        ("metadata", "https://data360files.worldbank.org/data360-data/metadata/A/x.json", "metadata/A/x.json"),
    ]
    bodies = spark.createDataFrame([('﻿{"a": 1}',), ("oops",)], "body string")
    assert [r["body"] for r in indicators.clean_metadata(bodies).collect()] == ['{"a":1}', None]


def test_small_members_are_handed_on_in_small_batches(monkeypatch):
    """What a task holds does not grow with the number of its archives."""

    class Task:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(payloads.F, "col", lambda name: SimpleNamespace(cast=lambda kind: name))
    texts = [f"{i},".ljust(60_000, "x") for i in range(100)]
    archives = queries._zip_archive(pa.array([str(i) for i in range(100)]), pa.array(texts))
    batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(100)]), archives], names=["storage_key", "content"])
    found = list(payloads.expand_archive(Task(), ".csv")(iter([batch])))
    assert [d.as_py().decode() for b in found for d in b["data"]] == texts
    assert max(b.nbytes for b in found) < 2 * 2**20
