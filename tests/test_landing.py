"""Landing portal replies through a transport, then harvesting them."""

from __future__ import annotations

import json
import re

import pytest

from gleanspark.plans import land, land_catalogue, land_dataset_rows, land_indicators, land_topics
from gleanspark.sources.catalog import page_errors, scan_packages
from gleanspark.sources.topics import scan_topic_tree


def catalogue_transport(url, headers):
    start, rows = (int(n) for n in re.search(r"start=(\d+)&rows=(\d+)&fq=x", url).groups())
    if start == 20:
        raise TimeoutError("timed out")
    packages = [{"id": f"p{i}", "resources": []} for i in range(start, min(start + rows, 45))]
    return 200, {}, json.dumps({"result": {"count": 45, "results": packages}}).encode()


@pytest.mark.parametrize("start,most,expected", [(0, None, set(range(45)) - set(range(20, 30))), (5, 12, set(range(5, 17)))])
def test_land_catalogue(spark, start, most, expected):
    pages = land_catalogue(
        spark, "https://p.org/", "/api/3/action", catalogue_transport, start, most, 10, {"fq": "x"}, partitions=3
    )
    found = [r["package_id"] for r in scan_packages(pages).collect()]
    assert len(found) == len(set(found)) and {int(p[1:]) for p in found} == expected
    assert [r["page_no"] for r in page_errors(pages).collect()] == ([2] if most is None else [])


def test_catalogue_without_a_count(spark):
    with pytest.raises(ValueError):
        land_catalogue(spark, "https://p.org", "/a", lambda url, headers: (200, {}, b"{}"), partitions=1)


SIZES = {"none": 0, "short": 3, "even": 20, "long": 47}


def rows_transport(url, headers):
    name, limit, offset = re.search(r"/resource/(\w+)\.json\?\$limit=(\d+)&\$offset=(\d+)", url).groups()
    records = [{"n": i} for i in range(int(offset), min(int(offset) + int(limit), SIZES[name]))]
    return 200, {}, json.dumps(records).encode()


@pytest.mark.parametrize("limit", [-1, 7, 20, 1000])
def test_land_dataset_rows(spark, limit):
    datasets = spark.createDataFrame([(name,) for name in SIZES], "dataset_id string")
    rows, failures = land_dataset_rows(datasets, "https://p.org/", rows_transport, limit, 5, 2, 3)
    rows = rows.collect()
    for name, size in SIZES.items():
        expected = list(range(size if limit == -1 else min(size, limit)))
        assert sorted(r["row_idx"] for r in rows if r["dataset_id"] == name) == expected
    assert all(r["record"]["n"] == str(r["row_idx"]) for r in rows)
    assert failures.isEmpty()


@pytest.mark.parametrize("limit", [-1, 33, 1000])
def test_a_portal_that_caps_pages_loses_nothing(spark, limit):
    def capped(url, headers):
        status, sent, body = rows_transport(url, headers)
        return status, sent, json.dumps(json.loads(body)[:3]).encode()

    datasets = spark.createDataFrame([(name,) for name in SIZES] * 2, "dataset_id string")
    rows, failures = land_dataset_rows(datasets, "https://p.org/", capped, limit, 10, 4, 3)
    found = sorted((r["dataset_id"], r["row_idx"], r["record"]["n"]) for r in rows.collect())
    assert found == sorted((n, i, str(i)) for n, size in SIZES.items() for i in range(size if limit == -1 else min(size, limit)))
    assert failures.isEmpty()


def test_a_portal_that_sends_more_than_asked_for(spark):
    def generous(url, headers):
        return rows_transport(re.sub(r"limit=(\d+)", lambda m: f"limit={int(m.group(1)) + 2}", url), headers)

    rows, _ = land_dataset_rows(spark.createDataFrame([("long",)], "dataset_id string"), "https://p.org", generous, -1, 5, 3, 2)
    assert sorted(r["row_idx"] for r in rows.collect()) == list(range(47))


def test_failed_row_requests_are_reported(spark):
    def transport(url, headers):
        return (500, {}, b"") if "$offset=5" in url else rows_transport(url, headers)

    datasets = spark.createDataFrame([("even",), (None,)], "dataset_id string")
    rows, failures = land_dataset_rows(datasets, "https://p.org", transport, -1, 5, 2, 2)
    assert sorted(r["row_idx"] for r in rows.collect()) == [*range(5), *range(10, 20)]
    assert {(r["dataset_id"], r["offset"], r["status"]) for r in failures.collect()} == {("even", 5, 500)}
    down = land_dataset_rows(datasets, "https://p.org", lambda url, headers: (503, {}, b""), -1, 5, 2, 2)
    assert down[0].isEmpty() and {r["status"] for r in down[1].collect()} == {503}
    rows, failures = land_dataset_rows(datasets.limit(0), "https://p.org", transport)
    assert rows.isEmpty() and failures.isEmpty()


def test_jobs_do_not_grow_with_the_dataset(spark):
    asked = spark.sparkContext.accumulator(0)

    def endless(size):
        def transport(url, headers):
            limit, offset = (int(n) for n in re.search(r"limit=(\d+)&\$offset=(\d+)", url).groups())
            asked.add(1)
            return 200, {}, json.dumps([{"n": i} for i in range(offset, min(offset + limit, size))]).encode()

        return transport

    rows, _ = land_dataset_rows(spark.createDataFrame([("d",)], "dataset_id string"), "https://p.org", endless(20_000), -1, 100, 8, 4)
    assert rows.count() == 20_000 == rows.select("row_idx").distinct().count()
    # 200 full pages, and of probes and empty pages no more than a few rounds.
    assert asked.value <= 200 + 60


def test_land_topics(spark):
    mart = {"label": '<span class="martOwner">o</span><span class="martName">m</span>', "martId": "7"}
    topic = {"label": '<span class="topic">t</span>', "childNodes": [mart]}
    leaf = {"label": '<span class="node">leaf</span>', "childNodes": [], "dataFilter": "f"}

    def transport(url, headers):
        nodes = [leaf] if url.endswith("?m=7") else [{}] * 5 + [topic]
        return 200, {}, ("{Nodes:" + json.dumps(nodes) + "}").encode()

    explorer, marts = land_topics(spark, transport, 2)
    leaves = scan_topic_tree(explorer, marts).collect()
    assert [(r["topic"], r["mart_name"], r["name"]) for r in leaves] == [("t", "m", "leaf")]


def test_land_indicators(spark):
    def transport(url, headers):
        if "searchv2" in url:
            return 200, {}, b'{"value":[{"series_description":{"database_id":"A"}},{"series_description":{"database_id":"A"}}]}'
        return 200, {}, b'["x"]'

    _, lists = land_indicators(spark, transport, 2)
    assert [(r["database_id"], r["status"], r["body"]) for r in lists.collect()] == [("A", 200, '["x"]')]


def test_land_keeps_failed_requests(spark):
    requests = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "good")], "n int, url string")
    landed = land(requests, lambda url, headers: (200 if url == "good" else 503, {}, b"\xffok"), 2)
    assert sorted((r["n"], r["status"], r["body"]) for r in landed.collect() if r["body"]) == [(1, 200, "\ufffdok"), (3, 200, "\ufffdok")]
    assert [(r["n"], r["status"]) for r in landed.where("body is null").collect()] == [(2, 503)]
