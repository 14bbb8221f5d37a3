"""Whole harvests and sinks, end to end on a few landed replies."""

from __future__ import annotations

import json

import pytest

from gleanspark import sinks
from gleanspark.functions import predicates
from gleanspark.plans import (
    CatalogueHarvest,
    DatasetHarvest,
    dataset_as_df,
    harvest_catalogue,
    harvest_datasets,
    harvest_indicators,
    harvest_topics,
    plan_catalogue,
)
from gleanspark.plans import indicators
from gleanspark.plans.datasets import store_one_dataset
from gleanspark.session import materialize
from tests.test_sources import archive, node


def resource(rid, url, name="n", fmt="CSV"):
    return {"id": rid, "url": url, "name": name, "format": fmt}


@pytest.fixture(scope="module")
def pages(spark):
    def page(no, *packages):
        return no, 200, json.dumps({"result": {"count": 4, "results": list(packages)}})

    rows = [
        page(
            0,
            {"id": "p0", "org": "x", "resources": [resource("a/1", "http://ok/1"), resource("b", "rel"), resource("c", "http://no", fmt="PDF")]},
            {"id": "p1", "org": "x", "resources": [resource("d", "http://gone"), resource("", "http://x"), resource("e", None)]},
        ),
        page(
            1,
            {"id": "p2", "org": "y", "resources": [resource("z", "http://zip", None), resource("y", "http://txtzip", "t")]},
            {"id": "p3", "org": "y", "resources": [resource("f", "http://ok/1", "shared"), resource("g", "http://h", fmt="html")]},
        ),
    ]
    return spark.createDataFrame(rows, "page_no int, status int, body string")


def transport(url, headers):
    if url == "http://gone":
        return 404, {}, b""
    if url == "http://zip":
        return 200, {}, archive(**{"t.csv": b"a\n1\n"})
    if url == "http://txtzip":
        return 200, {}, archive(**{"t.txt": b"a\n1\n"})
    return 200, {"Content-Length": "4"}, b"a\n1\n"


def settings(tmp_path, run, **more):
    return CatalogueHarvest(str(tmp_path), run, "https://p.org/", predicate=predicates.is_csv, fetch_partitions=2, **more)


def test_plan_catalogue(spark, pages, tmp_path):
    packages, work = plan_catalogue(pages, settings(tmp_path, "r"))
    assert {r["package_id"]: r["num_resources"] for r in packages.collect()} == {"p0": 2, "p1": 1, "p2": 2, "p3": 1}
    assert {(r["storage_key"], r["url"]) for r in work.collect()} == {
        ("n__a-1", "http://ok/1"), ("n__b", "https://p.org/rel"), ("n__d", "http://gone"),
        ("z", "http://zip"), ("t__y", "http://txtzip"), ("shared__f", "http://ok/1"),
    }
    packages, _ = plan_catalogue(pages, settings(tmp_path, "r", start=1, max_packages=2))
    assert sorted(r["package_id"] for r in packages.collect()) == ["p1", "p2"]
    packages, _ = plan_catalogue(pages, settings(tmp_path, "r", search_filters={"org": "y"}))
    assert sorted(r["package_id"] for r in packages.collect()) == ["p2", "p3"]


def test_harvest_catalogue_and_resume(spark, pages, tmp_path):
    summary = harvest_catalogue(pages, settings(tmp_path, "r1", expand_archives=True), transport).collect()
    assert [tuple(r) for r in summary] == [("r1", 4, 2, 6)]
    runs = {r["storage_key"]: r for r in spark.read.parquet(f"{tmp_path}/runs").collect()}
    assert runs["n__d"]["error_type"] == "HTTPResourceError"
    assert runs["t__y"]["error_type"] == "no_csv_member"
    members = spark.read.parquet(f"{tmp_path}/members/r1").collect()
    assert [(r["member"], bytes(r["data"])) for r in members] == [("t.csv", b"a\n1\n")]
    stored = spark.read.parquet(f"{tmp_path}/payloads")
    assert stored.where("url = 'http://ok/1'").count() == 1
    # Only what failed is tried again.
    again = harvest_catalogue(pages, settings(tmp_path, "r2"), transport).collect()
    assert [tuple(r) for r in again] == [("r2", 1, 1, 2)]
    with pytest.raises(ValueError, match="r2"):
        harvest_catalogue(pages, settings(tmp_path, "r2"), transport)


@pytest.mark.parametrize("fmt", ["csv", "parquet", "json"])
def test_decode_into_the_wanted_format(spark, pages, tmp_path, fmt):
    cfg = settings(tmp_path, "r", expand_archives=True, decode=True, download_format=fmt)
    harvest_catalogue(pages, cfg, transport)
    reader = spark.read.option("header", True).option("escape", "\\") if fmt == "csv" else spark.read
    rows = reader.format(fmt).load(f"{tmp_path}/tables/r").collect()
    found = {(r["dataset_id"], r["member"], json.loads(r["record"])["a"] if fmt == "csv" else r["record"]["a"]) for r in rows}
    assert found == {("http://ok/1", None, "1"), ("https://p.org/rel", None, "1"), ("http://zip", "t.csv", "1")}


def test_html_and_zip_urls_can_be_refused(spark, tmp_path):
    resources = [resource("a", "http://x/a.ZIP"), resource("b", "http://x/b"), resource("c", "http://x/c")]
    body = json.dumps({"result": {"results": [{"id": "p", "resources": resources}]}})
    pages = spark.createDataFrame([(0, 200, body)], "page_no int, status int, body string")

    def reply(url, headers):
        assert not url.endswith("ZIP")
        return 200, {}, b"<!DOCTYPE html><p>" if url.endswith("b") else b"a\n1\n"

    cfg = settings(tmp_path, "r", reject_html=True, reject_zip_urls=True, max_workers=4)
    assert [tuple(r) for r in harvest_catalogue(pages, cfg, reply).collect()] == [("r", 1, 2, 3)]
    kinds = {r["url"]: r["error_type"] for r in spark.read.parquet(f"{tmp_path}/runs").collect()}
    assert kinds == {"http://x/a.ZIP": "IsZIPError", "http://x/b": "IsHTMLError", "http://x/c": None}


def test_harvest_from_landed_replies(spark, pages, tmp_path):
    rows = [("http://ok/1", 200, "4", b"a\n1\n"), ("https://p.org/rel", 200, str(2**21), b"x"), ("http://other", 200, None, b"")]
    landed = spark.createDataFrame(rows, "url string, status int, content_length string, content binary")
    summary = harvest_catalogue(pages, settings(tmp_path, "r"), responses=landed).collect()
    assert [tuple(r) for r in summary] == [("r", 2, 4, 6)]
    kinds = {r["storage_key"]: r["error_type"] for r in spark.read.parquet(f"{tmp_path}/runs").collect()}
    assert kinds["n__b"] == "TooLargeResourceError" and kinds["z"] == "no_reply"
    with pytest.raises(ValueError):
        harvest_catalogue(pages, settings(tmp_path, "r"))


ENTRY = "dataset_id string, columns_field_name array<string>, columns_datatype array<string>, columns_format array<map<string,string>>"


@pytest.fixture(scope="module")
def entries(spark):
    rows = [
        ("d1", ["n", "t"], ["number", "calendar date"], [{"noCommas": "true"}, {"view": "date_y"}]),
        ("d2", ["n"], ["calendar date"], [{"view": "odd"}]),
        ("d3", ["n"], ["text"], [None]),
    ]
    return spark.createDataFrame(rows, ENTRY)


@pytest.fixture(scope="module")
def records(spark):
    rows = [("d1", i, {"n": str(i) if i else "x", "t": "2024"}) for i in range(5)]
    rows += [("d2", 0, {"n": "7"}), ("d9", 0, {"n": "1"})]
    return spark.createDataFrame(rows, "dataset_id string, row_idx bigint, record map<string,string>")


def test_harvest_datasets(spark, entries, records, tmp_path):
    cfg = DatasetHarvest(str(tmp_path), max_rows=3, cast_datatypes=True)
    summary = {r["dataset_id"]: tuple(r)[1:4] for r in harvest_datasets(entries, records, cfg).collect()}
    assert summary == {"d1": (3, False, True), "d2": (1, True, True), "d3": (0, False, False)}
    stored = spark.read.parquet(f"{tmp_path}/datasets")
    rows = stored.where("dataset_id = 'd1'").orderBy("row_idx").selectExpr("to_json(record)", "schema_of_variant(record)")
    assert [json.loads(r[0])["n"] if "n" in json.loads(r[0]) else None for r in rows.collect()] == [None, 1, 2]
    assert rows.collect()[1][1] == "OBJECT<n: BIGINT, t: TIMESTAMP_NTZ>"
    assert stored.where("dataset_id = 'd2'").selectExpr("to_json(record)").first()[0] == '{"n":"7"}'
    assert spark.read.json(f"{tmp_path}/metadata").count() == 3


@pytest.mark.parametrize("fmt", ["csv", "parquet", "json"])
@pytest.mark.parametrize("cast", [True, False])
def test_dataset_harvest_formats_and_errors(spark, entries, records, tmp_path, fmt, cast):
    cfg = DatasetHarvest(str(tmp_path), cast_datatypes=cast, fmt=fmt, run_name="r1")
    failures = spark.createDataFrame([("d1", 5, "u", 500), ("d1", 6, "u", 503), ("gone", 0, "u", 500)], "dataset_id string, offset bigint, url string, status int")
    harvest_datasets(entries, records, cfg, failures)
    log = {r["dataset_id"]: (r["n_rows"], r["ok"], r["error_record"]) for r in spark.read.parquet(f"{tmp_path}/runs/run_name=r1").collect()}
    assert log == {
        "d1": (5, False, "[DATASET:d1][ERROR:2 requests failed, status 500][TYPE:HTTPResourceError]"),
        "d2": (1, True, "[DATASET:d2][ERROR:unexpected column declaration][TYPE:ValueError]"),
        "d3": (0, False, "[DATASET:d3][ERROR:no rows][TYPE:EmptyDataset]"),
    }
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    stored = reader.format(fmt).load(f"{tmp_path}/datasets")
    assert stored.groupBy("dataset_id").count().count() == 2
    if fmt == "json" and not cast:
        assert stored.where("dataset_id = 'd2'").select("record.n").first()[0] == "7"


@pytest.mark.parametrize("fmt", ["csv", "parquet", "json"])
def test_one_dataset(spark, entries, records, tmp_path, fmt):
    frame = store_one_dataset(records, "d1", str(tmp_path), fmt, entries, limit=-1)
    assert frame.schema.simpleString() == "struct<n:int,t:timestamp_ntz>"
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    assert reader.format(fmt).load(f"{tmp_path}/{fmt}/d1").count() == 5
    assert dataset_as_df(records, "d9").schema.simpleString() == "struct<n:bigint>"


def test_harvest_topics(spark, tmp_path):
    mart = {"label": '<span class="martOwner">o</span><span class="martName">mart</span>', "martId": "m"}
    topic = {"label": '<span class="topic">top</span>', "childNodes": [mart]}
    explorer = spark.createDataFrame([("{Nodes:" + json.dumps([{}] * 5 + [topic]) + "}",)], "body string")
    tree = [
        node("f/x", [node("one", (), "docID:1"), node("two", (), "2")]),
        node("both", (), "3"), node("html", (), "4"), node("none", (), ""), node("brokenzip", (), "5"),
    ]
    marts = spark.createDataFrame([("m", "{Nodes:" + json.dumps(tree) + "}")], "mart_id string, body string")

    def reply(url, headers):
        csv = "DataFilter" in url
        number = url.split("DataFilter=" if csv else "id=")[1].split("&")[0]
        body, kind = {
            ("1", True): (b"a\n1\n", "application/csv"),
            ("2", False): (archive(**{"x.csv": b"a\n2\n", "y.csv": b"a\n3\n"}), "application/zip"),
            ("3", True): (b"a\nold\n", "text/csv"),
            ("3", False): (b"a\nnew\n", "text/csv"),
            ("4", True): (b"<html>", "text/html"),
            ("5", True): (b"a\nkept\n", "text/csv"),
            ("5", False): (b"PKnope", "application/zip"),
        }.get((number, csv), (b"", ""))
        if not kind:
            return 404, {}, b""
        return 200, {"Content-Type": kind, "Content-Length": str(len(body))}, body

    summary = harvest_topics(explorer, marts, str(tmp_path), reply, 2).collect()
    assert [tuple(r) for r in summary] == [("top", 4, 1, 5)]
    rows = spark.read.option("header", True).option("escape", "\\").csv(f"{tmp_path}/tables").collect()
    assert {(r["path"], r["file_name"], r["member"], json.loads(r["record"])["a"]) for r in rows} == {
        ("f/x", "one.csv", None, "1"), ("f/x", "two.csv", "x.csv", "2"), ("f/x", "two.csv", "y.csv", "3"),
        (None, "both.csv", None, "new"), (None, "brokenzip.csv", None, "kept"),
    }
    assert {(r["topic"], r["mart_name"]) for r in rows} == {("top", "mart")}
    outcomes = {(r["file_name"], r["candidate"]): r["error_type"] for r in spark.read.parquet(f"{tmp_path}/runs").collect()}
    assert len(outcomes) == 10
    assert outcomes["html.csv", 0] == "unknown_content_type" and outcomes["one.csv", 1] == "HTTPResourceError"
    assert outcomes["brokenzip.csv", 1] == "BadArchive" and outcomes["both.csv", 0] == outcomes["both.csv", 1] == ""


def test_harvest_indicators(spark, tmp_path):
    hits = spark.createDataFrame([('{"value":[{"series_description":{"database_id":"A"}}]}',)], "body string")
    lists = spark.createDataFrame(
        [("A", 200, '["x","y"]'), ("B", 200, '["z"]')], "database_id string, status int, body string"
    )

    def reply(url, headers):
        if url.endswith("y.csv"):
            return 500, {}, b""
        return 200, {}, '﻿{"k": 1}'.encode() if url.endswith(".json") else b"c\n1\n"

    summary = harvest_indicators(hits, lists, str(tmp_path), reply, 2).collect()
    assert [tuple(r) for r in summary] == [("A", 3, 1, 4)]
    stored = {(r["kind"], r["indicator_id"]): r["body"] for r in spark.read.parquet(f"{tmp_path}/files").collect()}
    assert stored == {("metadata", "x"): '{"k":1}', ("metadata", "y"): '{"k":1}', ("data", "x"): "c\n1\n"}


def test_indicator_files_meet_their_work_in_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    """More files are more tasks, whatever the size of the tables they are written in; no side is broadcast."""
    hits = spark.createDataFrame([('{"value":[{"series_description":{"database_id":"A"}}]}',)], "body string")
    lists = spark.createDataFrame([("A", 200, json.dumps([f"i{n}" for n in range(60)]))], "database_id string, status int, body string")
    plans = []

    def written(df, options=None):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, options)

    monkeypatch.setattr(indicators, "materialize", written)
    monkeypatch.setattr(indicators, "_TASK_FILES", 10, raising=False)
    summary = harvest_indicators(hits, lists, str(tmp_path), lambda url, headers: (200, {}, b'{"k": 1}'), 2).collect()
    assert [tuple(r) for r in summary] == [("A", 120, 0, 120)]
    joins = [line for line in plans[-1].splitlines() if "Join" in line and "url" in line]
    assert len(joins) == 1 and "SortMergeJoin" in joins[0]
    assert plans[-1].count(", 13), REPARTITION_BY_NUM") == 2


def test_lost_replies_are_errors_of_their_harvest(spark, pages, tmp_path):
    lost = spark.createDataFrame([(7, 500, "gone"), (8, 200, "no json")], "page_no int, status int, body string")
    summary = harvest_catalogue(pages.unionByName(lost), settings(tmp_path / "c", "r", expand_archives=True), transport)
    assert [tuple(r) for r in summary.collect()] == [("r", 4, 4, 8)]
    runs = spark.read.parquet(f"{tmp_path}/c/runs")
    assert runs.where("error_type = 'bad_page' and storage_key is null and not ok").count() == 2

    mart = {"label": '<span class="martName">mart</span>', "martId": "m"}
    topic = {"label": '<span class="topic">top</span>', "childNodes": [mart, {**mart, "martId": "lost"}]}
    explorer = spark.createDataFrame([("{Nodes:" + json.dumps([{}] * 5 + [topic]) + "}",), ("down",)], "body string")
    tree = "{Nodes:" + json.dumps([node("one", (), "docID:1")]) + "}"
    marts = spark.createDataFrame([("m", tree), ("lost", "<html>")], "mart_id string, body string")
    summary = harvest_topics(explorer, marts, f"{tmp_path}/t", lambda u, h: (200, {"Content-Type": "text/csv", "Content-Length": "4"}, b"a\n1\n"), 2)
    assert {tuple(r) for r in summary.collect()} == {("top", 1, 1, 2), (None, 0, 1, 1)}
    runs = spark.read.parquet(f"{tmp_path}/t/runs")
    assert runs.where("error_type = 'unreadable_reply'").count() == 2

    hits = spark.createDataFrame([('{"value":[{"series_description":{"database_id":"A"}},{"series_description":{"database_id":"B"}}]}',)], "body string")
    lists = spark.createDataFrame([("A", 200, '["x"]'), ("B", 503, None), ("C", 503, None)], "database_id string, status int, body string")
    summary = harvest_indicators(hits, lists, f"{tmp_path}/i", lambda u, h: (200, {}, b'{"k": 1}'), 2)
    assert {tuple(r) for r in summary.collect()} == {("A", 2, 0, 2), ("B", 0, 1, 1)}


def test_broken_archives_give_no_tables(spark, tmp_path):
    good = archive(**{"a.csv": b"n\n1\n", "b.csv": b"n\n2\n"})
    damaged = bytearray(good)
    damaged[good.index(b"n\n2") + 2] ^= 1
    body = json.dumps({"result": {"results": [{"id": "p", "resources": [resource("a", "http://x/good"), resource("b", "http://x/bad")]}]}})
    pages = spark.createDataFrame([(0, 200, body)], "page_no int, status int, body string")
    cfg = settings(tmp_path, "r", expand_archives=True, decode=True)
    harvest_catalogue(pages, cfg, lambda url, headers: (200, {}, good if url.endswith("good") else bytes(damaged)))
    rows = spark.read.parquet(f"{tmp_path}/tables/r").collect()
    assert {(r["dataset_id"], r["record"]["n"]) for r in rows} == {("http://x/good", "1"), ("http://x/good", "2")}
    kinds = {r["url"]: r["error_type"] for r in spark.read.parquet(f"{tmp_path}/runs").collect()}
    assert kinds == {"http://x/good": None, "http://x/bad": "BadArchive"}


def test_store_rejects_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.store_dataset(spark.range(1), str(tmp_path), "d", "xls")
