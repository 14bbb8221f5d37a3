"""Coverage of rows, areas, package search, facets and mixed dates against brute force."""

from __future__ import annotations

import datetime as dt
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleanspark.functions import geo
from gleanspark.operators import coverage, dates, spatial
from gleanspark.sources import datasets, search

# --- coverage --------------------------------------------------------------------------------


def brute_coverage(pages, ends, stripe):
    out = []
    for name in {*ends, *(p[0] for p in pages)}:
        spans = sorted({(o, o + n) for d, o, n in pages if d == name and n > 0})
        end = ends.get(name, max((b for _, b in spans), default=0))
        reach = 0
        for a, b in [*spans, (end, end)]:
            if a > reach:
                out += [(name, "gap", x) for x in range(reach, a)]
            elif a < reach and b > a:
                out.append((name, "overlap", a, min(b, reach)))
            reach = max(reach, b)
    cut = Counter()
    for row in out:
        if row[1] == "gap":
            cut[row] += 1
        else:
            for x in range(row[2], row[3]):
                cut[(row[0], "overlap", x)] += 1
    return cut


@pytest.mark.parametrize("stripe, given", [(1 << 20, False), (7, False), (16, True)])
def test_coverage_equals_brute_force(spark, stripe, given):
    draw = random.Random(stripe)
    pages = [(draw.choice("aab"), draw.randrange(200), draw.choice((0, 3, 10, 25))) for _ in range(30)]
    pages += pages[:4]
    ends = {"a": 240, "b": 230, "empty": 9} if given else {}
    frame = spark.createDataFrame(pages, "dataset_id string, offset long, rows long")
    known = spark.createDataFrame(list(ends.items()), "dataset_id string, stop long") if given else None
    found = Counter()
    rows = coverage.row_coverage(frame, known, stripe).collect()
    for r in rows:
        assert r["start"] < r["stop"] and r["start"] // stripe == (r["stop"] - 1) // stripe
        found.update((r["dataset_id"], r["kind"], x) for x in range(r["start"], r["stop"]))
    assert found == brute_coverage(pages, ends, stripe)


def test_coverage_of_nothing(spark):
    none = spark.createDataFrame([], "dataset_id string, offset long, rows long")
    assert coverage.row_coverage(none).isEmpty()
    with pytest.raises(ValueError):
        coverage.row_coverage(none, stripe=0)


def test_fill_requests(spark):
    gaps = spark.createDataFrame([("d", 5, 16, 4), ("e", 3, 3, 9)], "dataset_id string, start long, stop long, size int")
    found = sorted((r["dataset_id"], r["offset"], r["asked"]) for r in coverage.fill_requests(gaps).collect())
    assert found == [("d", 5, 4), ("d", 9, 4), ("d", 13, 3)]


# --- areas -----------------------------------------------------------------------------------


def metres(a, b):
    (la, lo), (ma, mo) = ((math.radians(x) for x in p) for p in (a, b))
    half = math.sin((ma - la) / 2) ** 2 + math.cos(la) * math.cos(ma) * math.sin((mo - lo) / 2) ** 2
    return 2 * geo.EARTH_RADIUS * math.asin(min(1.0, math.sqrt(half)))


@pytest.mark.parametrize("cell", [50_000.0, 900_000.0, 30_000_000.0])
def test_circles_equal_brute_force(spark, cell):
    draw = random.Random(int(cell))
    spots = [(draw.uniform(-90, 90), draw.uniform(-180, 180)) for _ in range(400)]
    spots += [(90.0, 0.0), (-90.0, 10.0), (0.0, 180.0), (0.0, -180.0), (89.9, 170.0), (0.0, 179.9)]
    circles = [(lat, lon, draw.choice((0.0, 3e5, 2e6))) for lat, lon in draw.sample(spots, 40)]
    circles += [(89.0, -10.0, 5e5), (0.0, 179.95, 4e4), (-89.99, 77.0, 1e4), (10.0, 10.0, 2.1e7)]
    places = spark.createDataFrame([(i, *p) for i, p in enumerate(spots)] + [(999, None, 1.0), (998, 1.0, None)], "place int, lat double, lon double")
    rings = spark.createDataFrame([(i, *c) for i, c in enumerate(circles)] + [(99, None, 0.0, 1.0)], "ring int, center_lat double, center_lon double, radius double")
    found = [(r["ring"], r["place"]) for r in spatial.match_circles(places, rings, cell).select("ring", "place").collect()]
    expected = [(i, j) for i, (a, b, radius) in enumerate(circles) for j, p in enumerate(spots) if metres(p, (a, b)) <= radius]
    assert sorted(found) == sorted(expected)


def test_circles_meet_by_cell(spark):
    places = spark.createDataFrame([(1.0, 2.0)], "lat double, lon double")
    rings = spark.createDataFrame([(1.0, 2.0, 5.0)], "center_lat double, center_lon double, radius double")
    plan = spatial.match_circles(places, rings)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_the_cells_of_circles_are_not_broadcast(spark):
    places = spark.createDataFrame([(1.0, 2.0)], "lat double, lon double")
    rings = spark.createDataFrame([(1.0, 2.0, 5.0)], "center_lat double, center_lon double, radius double")
    met = spatial.match_circles(places, rings)
    assert met.count() == len(met.collect()) == 1
    assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()


def exchanged(frame):
    """Rows that the exchanges of a frame wrote, when it has been collected."""
    result = frame._jdf.queryExecution().executedPlan().executedPlan().collectLeaves().apply(0)
    stages = result.plan().collectLeaves()
    return sum(stages.apply(i).plan().metrics().apply("shuffleRecordsWritten").value() for i in range(stages.size()))


def test_circles_are_not_exchanged_by_small_cells(spark):
    places = spark.range(50).select("id", (F.col("id") / 10 - 2).alias("lat"), (F.col("id") / 10 + 20).alias("lon"))
    rings = spark.createDataFrame([(i, i / 10, 20.0, 4e5) for i in range(20)], "ring int, center_lat double, center_lon double, radius double")
    met = spatial.match_circles(places, rings, 100_000.0)
    expected = places.crossJoin(rings).where(geo.distance("lat", "lon", "center_lat", "center_lon") <= F.col("radius"))
    columns = ["id", "ring", geo.distance("lat", "lon", "center_lat", "center_lon")]
    assert sorted(met.select("id", "ring", "distance").collect()) == sorted(expected.select(*columns).collect())
    assert met.columns == [*places.columns, *rings.columns, "distance"]
    assert len(met.collect()) and 50 + 20 <= exchanged(met) <= 50 + 20 * 4**2  # a box of 800 km, by cells of 100 km about 9 x 9


@pytest.mark.parametrize("crowd", [1, 16, 300])
def test_crowded_cells_are_dealt_out(spark, crowd):
    draw = random.Random(crowd)
    spots = [(draw.gauss(48, 0.2), draw.gauss(11, 0.3)) for _ in range(200)] + [(48.0, 11.0)] * 30
    spots += [(draw.uniform(-90, 90), draw.uniform(-180, 180)) for _ in range(50)]
    circles = [(*draw.choice(spots), draw.choice((0.0, 1e4, 3e4, 9e5))) for _ in range(60)]
    circles += circles[:20]
    places = spark.createDataFrame([(i // 2, {"a": i}, *p) for i, p in enumerate(spots)], "place int, notes map<string,int>, lat double, lon double")
    rings = spark.createDataFrame([(i, *c) for i, c in enumerate(circles)], "ring int, center_lat double, center_lon double, radius double")
    met = spatial.match_circles(places, rings, 100_000.0, crowd=crowd)
    assert met.columns == [*places.columns, *rings.columns, "distance"]
    found = [(r["ring"], r["notes"]["a"]) for r in met.collect()]
    expected = [(i, j) for i, (a, b, radius) in enumerate(circles) for j, p in enumerate(spots) if metres(p, (a, b)) <= radius]
    assert sorted(found) == sorted(expected)


def test_circles_of_odd_numbers(spark):
    nan, inf = float("nan"), float("inf")
    spots = [(48.0, 11.0), (48.0, 371.0), (48.0, 11.0 + 360 * 10**7), (0.0, nan), (-0.0, 180.0), (90.0, -5.0), (nan, 0.0), (91.0, 0.0), (-90.0, 3.0)]
    circles = [(48.0, 11.0, r) for r in (0.0, 1e-9, 1.0, 2.0015e7, 2.1e7, inf, nan, -1.0, None)] + [(48.0, 731.0, 5.0), (0.0, -180.0, 0.0), (-48.0, -169.0, 2.0015115e7)]
    places = spark.createDataFrame([(i, *p) for i, p in enumerate(spots)], "place int, lat double, lon double")
    rings = spark.createDataFrame([(i, *c) for i, c in enumerate(circles)], "ring int, center_lat double, center_lon double, radius double")
    metres_ = geo.distance("lat", "lon", "center_lat", "center_lon")
    expected = places.crossJoin(rings).where(F.col("lat").between(-90, 90) & (F.col("radius") >= 0) & (metres_ <= F.col("radius")))
    found = spatial.match_circles(places, rings, 100_000.0)
    assert sorted(found.select("ring", "place").collect()) == sorted(expected.select("ring", "place").collect())


def test_area_filters(spark):
    spots = [(0.0, 0.0), (50.0, 179.0), (50.0, -179.0), (10.0, 20.0), (None, 1.0)]
    frame = spark.createDataFrame(spots, "lat double, lon double")
    geo.register_portal_functions(spark)
    for box in ((60.0, 170.0, 40.0, -170.0), (20.0, -5.0, -5.0, 30.0)):
        north, west, south, east = box
        expected = [
            p for p in spots[:4] if south <= p[0] <= north and (west <= p[1] <= east if west <= east else p[1] >= west or p[1] <= east)
        ]
        assert sorted(tuple(r) for r in frame.where(geo.within_box("lat", "lon", *box)).collect()) == sorted(expected)
        assert sorted(tuple(r) for r in frame.where(f"within_box(lat, lon, {', '.join(map(str, box))})").collect()) == sorted(expected)
    for where in (geo.within_circle("lat", "lon", 49.0, 180.0, 2e5), F.expr("within_circle(lat, lon, 49, 180, 200000)")):
        assert sorted(tuple(r) for r in frame.where(where).collect()) == [(50.0, -179.0), (50.0, 179.0)]


def test_portal_query(spark, tmp_path):
    rows = [("a", i, float(i), float(2 * i)) for i in range(9)] + [("b", 100, 50.0, 60.0)]
    spark.createDataFrame(rows, "kind string, n int, lat double, lon double").write.parquet(str(tmp_path / "rows"))
    frame = spark.read.parquet(str(tmp_path / "rows"))
    some = datasets.portal_query(frame, {"$select": "n, lat", "$where": "within_box(lat, lon, 7, 0, 2, 99)", "$order": "n DESC", "$limit": 2, "$offset": 1, "kind": "a"})
    assert [tuple(r) for r in some.collect()] == [(6, 6.0), (5, 5.0)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(lat,2.0)" in plan and "EqualTo(kind,a)" in plan and "ReadSchema: struct<kind:string,n:int,lat:double,lon:double>" in plan
    grouped = datasets.portal_query(frame, {"$select": "kind, count(*) AS n, '{x}' AS braces", "$where": "n > 0", "$group": "kind", "$having": "count(*) > 1"})
    assert [tuple(r) for r in grouped.collect()] == [("a", 8, "{x}")]
    for wrong in ({"$limit": 3}, {"$q": "x"}):
        with pytest.raises(ValueError):
            datasets.portal_query(frame, wrong)


# --- package search --------------------------------------------------------------------------


def brute_search(packages, searches, rows, start):
    pattern = re.compile(r"[^\W_]+")
    held = {i: Counter(pattern.findall((t or "").lower())) for i, t in packages}
    held = {i: c for i, c in held.items() if c}
    n, mean = len(held), sum(sum(c.values()) for c in held.values()) / max(1, len(held))
    out = []
    for search_id, q in searches:
        scores = {}
        for term in set(pattern.findall((q or "").lower())):
            df = sum(term in c for c in held.values())
            idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
            for i, c in held.items():
                if term in c:
                    norm = c[term] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)
                    scores[i] = scores.get(i, 0) + math.floor(1_000_000 * idf * c[term] * 2.2 / norm)
        ranked = sorted(scores, key=lambda i: (-scores[i], i))[: start + rows]
        out += [(search_id, k, i, scores[i]) for k, i in enumerate(ranked, 1) if k > start]
    return sorted(out)


@pytest.mark.parametrize("rows, start", [(10, 0), (3, 2)])
def test_search_equals_brute_force(spark, rows, start):
    draw = random.Random(3)
    vocabulary = [f"Wört{k}" for k in range(30)]
    packages = [(f"p{i}", " ".join(draw.choices(vocabulary, [1 / (k + 1) for k in range(30)], k=draw.randrange(40)))) for i in range(80)]
    packages += [("null", None), ("blank", " ?! "), ("same", packages[0][1])]
    searches = [(1, "wört3 WÖRT3 wört17"), (2, "wört0"), (3, "nothing known"), (4, None), (5, "wört1, wört2; wört25")]
    index = search.postings(spark.createDataFrame(packages, "id string, notes string"), "notes")
    found = search.search_ranked(index, spark.createDataFrame(searches, "search_id long, q string"), rows, start)
    assert sorted(tuple(r) for r in found.select("search_id", "rank", "id", "score").collect()) == brute_search(packages, searches, rows, start)
    nothing = search.postings(spark.createDataFrame([], "id string, notes string"), "notes")
    assert search.search_ranked(nothing, spark.createDataFrame(searches, "search_id long, q string")).isEmpty()


@pytest.mark.parametrize("most", [search.BROADCAST_WORDS, 0])
def test_searches_for_the_same_words_are_ranked_once(spark, monkeypatch, most):
    monkeypatch.setattr(search, "BROADCAST_WORDS", most)
    packages = spark.createDataFrame([("p", "red bus"), ("q", "bus"), ("r", "tram")], "id string, notes string")
    # A search id given twice is one search.
    asked = [(i, ("red bus", "Bus, red bus")[i % 2]) for i in range(30)] + [(0, "red bus"), (99, "none")]
    searches = spark.createDataFrame(asked, "search_id long, q string")
    assert search._questions(searches)[0].select("question").distinct().count() == 2
    result = search.search_ranked(search.postings(packages, "notes"), searches)
    found = result.collect()
    assert sorted((r["search_id"], r["rank"], r["id"]) for r in found) == sorted((i, k, d) for i in range(30) for k, d in ((1, "p"), (2, "q")))
    assert len({(r["id"], r["score"]) for r in found}) == 2
    moved = re.findall(r"Exchange hashpartitioning\(question#\d+L?, id#", result._jdf.queryExecution().executedPlan().toString())
    assert bool(moved) == (not most)


def test_facets(spark):
    packages = [("o1", ["x", "y", "x"], 1), ("o1", ["y", None, ""], None), (None, None, 2), ("", [], 1), ("o2", ["z"], 1)]
    frame = spark.createDataFrame(packages, "org string, tags array<string>, size int")
    fields = {"organization": F.col("org"), "tags": F.col("tags"), "size": F.col("size")}
    found = search.facets(frame, fields)
    expected = {("organization", "o1", 2), ("organization", "o2", 1), ("tags", "x", 1), ("tags", "y", 2), ("tags", "z", 1), ("size", "1", 3), ("size", "2", 1)}
    assert {tuple(r) for r in found.collect()} == expected
    assert search.facets(frame, fields)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {tuple(r)[:2] for r in search.facets(frame, fields, 1).collect()} == {("organization", "o1"), ("tags", "y"), ("size", "1")}


# --- dates -----------------------------------------------------------------------------------

CELLS = {
    "month first": (["03/04/2024", "12/25/2024"], [(2024, 3, 4), (2024, 12, 25)]),
    "day first": (["03/04/2024", "25/12/2024", " 01/02/2024 "], [(2024, 4, 3), (2024, 12, 25), (2024, 2, 1)]),
    "either": (["03-04-2024", "05-06-2024"], [(2024, 3, 4), (2024, 5, 6)]),
    "both": (["25/12/2024", "12/26/2024", "03/04/2024"], [(2024, 12, 25), (2024, 12, 26), (2024, 3, 4)]),
    "mixed": (["2024-1-5", "5 Feb 2024", "MAR 7, 2024", "20240401", "13.05.2024", "01.02.2024"], [(2024, 1, 5), (2024, 2, 5), (2024, 3, 7), (2024, 4, 1), (2024, 5, 13), (2024, 2, 1)]),
    "bad": (["n/a", "", None, "31/31/2024", "2024", "2024-06"], [None, None, None, None, (2024, 1, 1), (2024, 6, 1)]),
    None: (["14/02/2024", "02/03/2024"], [(2024, 2, 14), (2024, 3, 2)]),
}


def test_mixed_dates(spark):
    rows = [(kind, i, cell, "clash") for kind, (cells, _) in CELLS.items() for i, cell in enumerate(cells)]
    frame = spark.createDataFrame(rows, "kind string, at int, cell string, common string").repartition(4)
    found = dates.cast_mixed_columns(frame, ("kind",), "cell", "day")
    assert found.columns == ["kind", "at", "cell", "common", "day"]
    got = {(r["kind"], r["at"]): r["day"] for r in found.collect()}
    assert got == {(kind, i): d and dt.datetime(*d) for kind, (_, days) in CELLS.items() for i, d in enumerate(days)}
    assert dates.cast_mixed_columns(frame.limit(0), ("kind",), "cell", "day").isEmpty()


def test_times_in_mixed_layouts(spark):
    cells = ["13/02/2024 10:05:06", "01/02/2024 1:02:03", "3/2/2024 11:00:00 pm", "2024-02-04T05:06:07.5", "2024-02-04 05:06:07"]
    frame = spark.createDataFrame([(c,) for c in cells], "cell string")
    got = [r["at"] for r in dates.cast_mixed_columns(frame.withColumn("k", F.lit(1)), ("k",), "cell", "at").orderBy("at").collect()]
    assert got == [
        dt.datetime(2024, 2, 1, 1, 2, 3), dt.datetime(2024, 2, 3, 23), dt.datetime(2024, 2, 4, 5, 6, 7),
        dt.datetime(2024, 2, 4, 5, 6, 7, 500000), dt.datetime(2024, 2, 13, 10, 5, 6),
    ]
