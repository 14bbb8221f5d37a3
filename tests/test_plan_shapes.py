"""What the physical plans must and must not hold, whatever the data size."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleanspark.functions import predicates
from gleanspark.operators import positions, resources, responses, tree
from gleanspark.sinks import stores
from gleanspark.sources import catalog
from tests.compare import contract

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in contract.queries().items() if name.startswith("q_")}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def operators(df) -> Counter:
    return Counter(re.findall(r"\b[A-Z]\w+(?= )", plan(df)))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_row_at_a_time_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


NARROW = [
    "q_work_list", "q_clean_resources", "q_pred_csv", "q_pred_canada", "q_pred_uk", "q_scan_packages",
    "q_filter_packages", "q_page_errors", "q_classify_response", "q_sniff", "q_is_html", "q_un_candidates",
    "q_repair_json", "q_type_map", "q_cast_cells", "q_dataset_rows", "q_action_url", "q_absolutize",
]


@pytest.mark.parametrize("name", NARROW)
def test_per_row_work_does_not_shuffle(spark, name):
    assert "Exchange hashpartitioning" not in plan(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize("name", ["q_harvest_plan", "q_run_summary", "q_last_writer", "q_distinct_databases", "q_page_plan"])
def test_one_shuffle_after_a_partial_aggregate(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert text.count("Exchange hashpartitioning") == 1
    assert len(re.findall(r"(Hash|Sort)Aggregate", text)) == 2


@pytest.mark.parametrize("name", ["q_limit_rows", "q_keep_newest"])
def test_group_limits_cut_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["q_package_search"](spark, SF_DIR))
    assert "EqualTo(o_orderstatus,O)" in text and "TakeOrderedAndProject" in text
    assert "o_totalprice" not in text
    text = plan(QUERIES["q_pred_csv"](spark, SF_DIR))
    assert "l_extendedprice" not in text and "p_retailprice" not in text


@pytest.mark.parametrize("limit", [10, 100_000])
def test_ordered_limits_are_cut_in_each_task(spark, limit):
    text = plan(positions.limit_ordered(spark.range(1000), ("id",), limit, 5))
    # Beyond the threshold of Spark's own top-k, a sort and a limit.
    assert "TakeOrderedAndProject" in text or "Limit" in text
    assert "Window" not in text


def test_no_jobs_while_joins_are_planned(spark):
    work = spark.range(10).selectExpr("id", "'u' AS url", "'k' AS storage_key", "id AS package_id")
    spark.sparkContext.setJobGroup("planning", "joins")
    resources.pending_work(work, work)
    resources.keep_accepted(work, work)
    responses.join_responses(work, work.select("url"))
    catalog.resource_show(work, work.select("id"))
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []


def test_a_hot_key_is_split_at_run_time(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        ids = spark.range(200_000).repartition(8)
        work = ids.select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string").alias("url"), F.sha2(F.col("id").cast("string"), 256).alias("k"))
        landed = ids.select(F.col("id").cast("string").alias("url"), F.lit(200).alias("status"))
        joined = responses.join_responses(work, landed)
        assert joined.count() == 200_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_json_is_parsed_once_per_page(spark):
    pages = spark.createDataFrame([(0, 200, "{}")], "page_no int, status int, body string")
    assert plan(catalog.scan_packages(pages)).lower().count("parsejson") == 1


def test_nested_filter_has_no_explode(spark):
    pages = spark.createDataFrame([(0, 200, "{}")], "page_no int, status int, body string")
    kept = resources.filter_package_resources(catalog.scan_packages(pages), predicates.uk_predicate)
    assert operators(kept)["Generate"] == 1  # the packages themselves
    assert "Exchange" not in plan(kept)


def test_replies_join_without_their_bodies(spark):
    work = spark.createDataFrame([("k", "u")], "storage_key string, url string")
    landed = spark.createDataFrame(
        [("u", 200, "1", b"x", 1)], "url string, status int, content_length string, content binary, at int"
    )
    judged = responses.classify_responses(responses.join_responses(work, landed, ("at",)))
    assert "content" not in judged.columns and judged.first()["ok"]


def test_partitioned_writes_are_rebalanced(spark):
    text = plan(stores._gathered(spark.range(10), "id"))
    assert "REBALANCE_PARTITIONS_BY_COL" in text


def test_a_level_of_a_tree_reads_each_label_once(spark):
    columns = "'k' AS mart_id, 'n' AS name, array('') AS path, 1 AS depth, '' AS data_filter"
    nodes = spark.sql(f"SELECT {columns}, array(parse_json('{{}}')) AS _children FROM range(9)")
    opened = tree._open_folders(nodes, ["mart_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert opened.count("regexp_extract_all(") == opened.count("aggregate(") == opened.count("&(#[0-9]{1,7}") == 1


def test_trees_of_few_levels_are_opened_where_they_are_parsed(spark, monkeypatch):
    reply = """concat('{"childNodes": [{"dataFilter": ', id, '}]}')"""
    nodes = spark.sql(f"SELECT id AS mart_id, parse_json({reply}) AS node FROM range(9)")
    plans, written = [], tree.materialize
    monkeypatch.setattr(tree, "materialize", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or written(df))
    assert tree.flatten_nodes(nodes).count() == 9
    (opened,) = plans
    assert "REBALANCE" not in opened.upper() and "Repartition" not in opened
    # Each level takes the children out of a node once.
    assert opened.count("$.childNodes") == 1 + tree.LEVELS_PER_PASS


def test_leaves_are_read_without_the_children_of_folders(spark):
    nodes = spark.sql("SELECT 'k' AS mart_id, parse_json('{}') AS node FROM range(9)")
    assert "_children" not in plan(tree.flatten_nodes(nodes))
