"""Column functions on the edge rows of the reference behaviour."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from gleanspark.functions import errors, payload, predicates, text, types
from gleanspark.operators.responses import classify_responses, header, merge_headers


def values(spark, rows, schema, column):
    # The schema must keep every row in place, so rows are numbered.
    numbered = [(i, *row) for i, row in enumerate(rows)]
    df = spark.createDataFrame(numbered, f"_i int, {schema}")
    return [r[1] for r in sorted(df.select("_i", column).collect())]


def one(spark, rows, column):
    return values(spark, [(r,) for r in rows], "c string", column)


def test_clean_resource_id(spark):
    assert one(spark, ["a/b", "a__b", "a___b", "a//b", "a-b"], text.clean_resource_id("c")) == [
        "a-b", "a--b", "a--_b", "a--b", "a-b",
    ]


def test_clean_resource_name(spark):
    rows = [None, "", "  A b:c__d ", "x/y", "\tpadded\t", " nb　", "   "]
    assert one(spark, rows, text.clean_resource_name("c")) == ["", "", "A-b-c--d", "x/y", "padded", "nb", ""]


def test_clean_id_has_no_separator_left(spark):
    ids = ["/", "__", "a/__b", "_/_", "a__/b"]
    for cleaned in one(spark, ids, text.clean_resource_id("c")):
        assert "/" not in cleaned and "__" not in cleaned


def test_storage_key(spark):
    rows = [("n", "i"), ("", "i")]
    assert values(spark, rows, "n string, i string", text.storage_key("n", "i")) == ["n__i", "i"]
    assert values(spark, rows, "n string, i string", text.storage_key("n", "i", False)) == ["i", "i"]


def test_absolutize_url(spark):
    rows = ["dataset/1", "/dataset/1", "ftp://x", "httpfoo", "https://x/y", None]
    assert one(spark, rows, text.absolutize_url("c", F.lit("https://p.org/"))) == [
        "https://p.org/dataset/1", "https://p.org/dataset/1", "https://p.org/ftp://x", "httpfoo", "https://x/y", None,
    ]


def test_action_url_leaves_null_parameters_out(spark):
    column = text.action_url(F.lit("https://p.org/"), F.lit("/api"), "package_show", {"id": "c", "x": F.lit(1)})
    assert one(spark, ["a", None], column) == [
        "https://p.org/api/package_show?id=a&x=1", "https://p.org/api/package_show?x=1",
    ]
    assert one(spark, ["a"], text.action_url(F.lit("https://p.org"), F.lit("/api"), "package_list", {})) == [
        "https://p.org/api/package_list?"
    ]


def test_repair_nodes_json_changes_the_first_only(spark):
    rows = ["{Nodes:[{Nodes:1}]}", '{"Nodes":[]}', "", "x{Nodes:"]
    assert one(spark, rows, text.repair_nodes_json("c")) == [
        '{"Nodes":[{Nodes:1}]}', '{"Nodes":[]}', "", 'x{"Nodes":',
    ]


def test_span_text(spark):
    rows = [
        '<b><span class="node"> a <i> b </i></span></b><span class="node">z</span>',
        "<span class='x node y'>A &amp; B</span>",
        '<span class="nodes">no</span>',
        '<span class="node"></span>',
        '<SPAN id="1" CLASS="node">up</SPAN>',
        None,
        '<span class="node"><span>a</span> b</span> c',
        '<span class="node">Caf&eacute; &#8217;x &#x1F34E; &amp;lt; &bogus; & &#0;</span>',
        '<span class="node">&nbsp; x</span>',
        '<span class="node">never closed',
    ]
    assert one(spark, rows, text.span_text("c", "node")) == [
        "ab", "A & B", None, "", "up", None, "ab", "Café ’x \U0001f34e &lt; &bogus; & &#0;", "x", None,
    ]


def test_plain_labels_read_as_marked_ones(spark):
    """Labels without tags and references take one pattern, and give what the walk through their spans gives."""
    draw = random.Random(5)
    pieces = ["<span class='node'>", '<SPAN id=1 class="x node">', "<span>", "</span>", "</SPAN >", "<b>", "a", " \xa0", "&amp;", "&#65;", "&#x110000;", "&#xD800;", "<"]
    rows = ["".join(draw.choices(pieces, k=draw.randint(1, 7))) for _ in range(600)] + [None, ""]
    opening = r"(?is)^.*?<span\b[^>]*\bclass\s*=\s*[\"'](?:[^\"']*\s)?node(?:\s[^\"']*)?[\"'][^>]*>"
    found = one(spark, rows, text.span_text("c", "node"))
    assert found == one(spark, rows, text._marked_text(F.col("c"), opening)) and 20 < sum(f is not None for f in found) < 500


def test_a_label_is_read_once(spark):
    """The walk through a label's spans, its references and their names are each worked out in one place."""
    whole = spark.createDataFrame([("a",)], "c string").select(text.span_text("c", "node").alias("name"))._jdf.queryExecution().optimizedPlan().toString()
    assert whole.count("regexp_extract_all(") == whole.count("aggregate(") == whole.count("&(#[0-9]{1,7}") == 1


def test_strip_bom_and_names(spark):
    assert one(spark, ["﻿{}", "{}﻿"], text.strip_bom("c")) == ["{}", "{}﻿"]
    assert one(spark, ["docID:1docID:"], text.strip_doc_id("c")) == ["1"]
    assert one(spark, ["a/b"], text.leaf_file_name("c")) == ["a-b.csv"]
    assert one(spark, ["k"], text.target_path("/d", "c", F.lit("csv"))) == ["/d/datasets/csv/k.csv"]
    stamp = F.lit(datetime.datetime(2024, 3, 5, 6, 7, 8))
    assert one(spark, [""], text.run_name(stamp)) == ["240305_06_07_08"]
    assert one(spark, ["DB"], text.indicator_list_url("c")) == [
        "https://data360api.worldbank.org/data360/indicators?datasetId=DB"
    ]


def test_predicates_on_null(spark):
    rows = [("CSV", None, None), (None, "v1", "en"), ("csv", "v12 x", "fr"), ("Csv", "a (CSV\nEN)", "en"), ("csv", "xv1", "den")]
    schema = "format string, name string, language string"
    assert values(spark, rows, schema, predicates.uk_predicate()) == [True, False, False, True, True]
    assert values(spark, rows, schema, predicates.canada_predicate()) == [True, False, False, False, True]
    assert values(spark, rows, schema, predicates.is_csv_or_json()) == [True, False, True, True, True]


def test_language_on_lists_and_variants(spark):
    rows = [(["en", "fr"],), (["den"],), (None,), ([],)]
    column = predicates.mentions_language("l", "en", "array")
    assert values(spark, rows, "l array<string>", column) == [True, False, True, False]
    texts = ['["en","fr"]', '["den"]', '"den"', '"fr"', None]
    column = predicates.mentions_language(F.parse_json("c"), "en", "variant")
    assert one(spark, texts, column) == [True, False, True, False, True]


def test_usable(spark):
    rows = [("u", "i"), ("", "i"), (None, "i"), ("u", ""), ("u", None)]
    assert values(spark, rows, "url string, id string", predicates.usable()) == [True, False, False, False, False]


def test_classify_status_and_length(spark):
    rows = [
        (1, "u", 200, None), (2, "u", 302, "100"), (3, "u", 399, "101"), (4, "u", 400, "1"),
        (5, "u", 500, None), (6, "u", 200, "abc"), (7, "u", 200, ""), (8, "u", 200, " 50 "),
    ]
    df = classify_responses(spark.createDataFrame(rows, "n int, url string, status int, content_length string"), 100)
    found = {r["n"]: (r["error_type"], r["error_text"], r["ok"]) for r in df.collect()}
    assert found[1] == found[2] == found[7] == found[8] == (None, None, True)
    assert found[3] == (errors.TOO_LARGE, "Resource size 101 > max_size 100 for URL: u", False)
    assert found[4] == (errors.HTTP_ERROR, "Error status 400 with requested URL: u", False)
    assert found[5][0] == errors.HTTP_ERROR
    assert found[6] == (errors.BAD_LENGTH, "invalid Content-Length: abc", False)


def test_error_texts(spark):
    assert one(spark, ["u.zip"], errors.zip_text("c"))[0].startswith("Filename ends with '.zip': u.zip. ZIP")
    assert "first part of data: <p>. It is" in one(spark, ["<p>"], errors.html_text("c"))[0]
    assert one(spark, ["d"], errors.dataset_error_record("c", F.lit("m"), F.lit("T"))) == ["[DATASET:d][ERROR:m][TYPE:T]"]


def test_sniff_kind(spark):
    rows = [(bytes.fromhex(h),) for h in ("504B030400", "D0CF11E0A1B11AE1", "D0CF11E0", "504B", "", "1F8B08", "612C62")]
    rows.append((None,))
    found = values(spark, rows, "c binary", payload.sniff_kind("c"))
    assert found == ["zip", "xls", "plain", "plain", "plain", "gzip", "plain", "plain"]
    assert one(spark, ["zip", "xls", "gzip", "plain"], payload.detected_extension("c", F.lit("csv"))) == [
        "zip", "xls", "csv", "csv",
    ]


def test_media_kind(spark):
    rows = ["application/zip", "application/vnd.ms-excel", "application/csv", "text/csv; charset=utf-8", "text/zip", None, "TEXT/CSV"]
    assert one(spark, rows, payload.media_kind("c")) == ["zip", "excel", "csv", "csv", "unknown", "unknown", "csv"]


def test_is_html_payload(spark):
    rows = ["<!DOCTYPE html><html>", " \n<HTML lang='x'>", "<!-- c --><head>", "a,b\n<html>", "<header>", "", None,
            "﻿<?xml version='1.0'?>\n<html>"]
    assert one(spark, rows, predicates.is_html_payload("c")) == [True, True, True, False, False, False, False, True]


TYPE_CASES = [
    ("Text", None, "string"), ("URL", {}, "string"), ("point", {"view": "date"}, "string"),
    ("Calendar date", None, "timestamp_ntz"), ("calendar date", {}, "timestamp_ntz"),
    ("calendar date", {"align": "x"}, "date"), ("calendar date", {"view": "date"}, "timestamp_ntz"),
    ("calendar date", {"view": "date_ymd"}, "timestamp_ntz"), ("calendar date", {"view": "date_my"}, "timestamp_ntz"),
    ("calendar date", {"view": "date_y"}, "timestamp_ntz"), ("calendar date", {"view": "date_time"}, "timestamp_ntz"),
    ("calendar date", {"view": "default_date_time"}, "timestamp_ntz"),
    ("calendar date", {"view": "iso_8601_date"}, "timestamp_ntz"), ("calendar date", {"view": "odd"}, "invalid"),
    ("number", None, "float"), ("Number", {"align": "x"}, "int"), ("number", {"noCommas": "true"}, "int"),
    ("number", {"noCommas": "false"}, "float"), ("number", {"noCommas": "x"}, "string"),
]


def test_type_map_on_columns_and_values(spark):
    rows = [(d, f) for d, f, _ in TYPE_CASES]
    expected = [t for _, _, t in TYPE_CASES]
    assert values(spark, rows, "d string, f map<string,string>", types.spark_type_of("d", "f")) == expected
    assert [types.type_name(d, f) for d, f in rows] == expected


def test_zip_columns_stops_at_the_shortest(spark):
    rows = [(["a", "b", "c"], ["text", "number"], [None, None, None]), (["a"], None, [None]), ([], [], [])]
    schema = "n array<string>, t array<string>, f array<map<string,string>>"
    found = values(spark, rows, schema, types.zip_columns("n", "t", "f"))
    assert [[c["name"] for c in row] for row in found] == [["a", "b"], [], []]


def test_casts(spark):
    assert one(spark, ["7", "7.5", "x", ""], types.cast_number("c", "int")) == [7, None, None, None]
    assert one(spark, ["2.5", "x"], types.cast_number("c", "float")) == [2.5, None]
    day = datetime.datetime(2024, 1, 15)
    rows = ["2024-01-15", "2024-01-15T00:00:00.000", "01/15/2024", "bad", None]
    assert one(spark, rows, types.cast_datetime("c", "yyyy-MM-dd")) == [day, day, day, None, None]
    assert one(spark, ["2024-01"], types.cast_datetime("c", "yyyy-MM")) == [datetime.datetime(2024, 1, 1)]
    assert one(spark, ["2024"], types.cast_datetime("c", "yyyy")) == [datetime.datetime(2024, 1, 1)]
    assert one(spark, ["2024-01-15"], types.cast_date("c")) == [day.date()]


def test_schema_with_unknown_view_is_all_strings():
    schema = types.schema_from_metadata(["a", "b"], ["number", "calendar date"], [None, {"view": "odd"}])
    assert schema.simpleString() == "struct<a:string,b:string>"


def test_merge_headers_right_wins(spark):
    column = merge_headers(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("1")), F.create_map(F.lit("b"), "c"))
    assert one(spark, ["2"], column) == [{"a": "1", "b": "2"}]
    assert one(spark, ["2"], header(F.create_map(F.lit("Content-Type"), "c"), "content-TYPE")) == ["2"]


@pytest.mark.parametrize("length,expected", [(255, True), (256, False)])
def test_long_names(spark, length, expected):
    assert one(spark, ["n" * length], predicates.has_short_name("c")) == [expected]
