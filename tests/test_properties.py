"""Properties that hold for any input."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gleanspark.functions import text
from gleanspark.operators import resources, responses
from gleanspark.session import materialize, small_batches

ALPHABET = "ab/_:- .\t\n\u00a0\u3000é<>&"


@pytest.fixture(scope="module")
def words(spark):
    draw = random.Random(5)
    rows = [("".join(draw.choices(ALPHABET, k=draw.randint(0, 12))),) for _ in range(3000)]
    return spark.createDataFrame(rows + [(None,)], "c string")


def test_cleaned_ids_and_names(words):
    cleaned = words.select(
        "c",
        text.clean_resource_id("c").alias("id"),
        text.clean_resource_id(text.clean_resource_id("c")).alias("twice"),
        text.clean_resource_name("c").alias("name"),
    ).collect()
    for r in cleaned:
        assert r["id"] == r["twice"]
        assert r["id"] is None or ("/" not in r["id"] and "__" not in r["id"])
        assert " " not in r["name"] and ":" not in r["name"] and "__" not in r["name"]
        assert r["name"] == r["name"].strip()
        if r["c"] is not None:
            assert len(r["id"]) == len(r["c"]) and len(r["name"]) == len(r["c"].strip())


def test_absolute_urls_start_with_http(words):
    urls = words.where("c is not null").select(text.absolutize_url("c", F.lit("https://p.org/")).alias("u"))
    assert urls.where(~F.startswith("u", F.lit("http"))).isEmpty()


def test_strip_agrees_with_unicode_strip(words):
    for r in words.where("c is not null").select("c", text.strip("c").alias("s")).collect():
        assert r["s"] == r["c"].strip()


def test_storage_keys_can_be_taken_apart(spark, words):
    rows = words.withColumnRenamed("c", "name").withColumn("id", F.reverse("name")).where("id <> ''").withColumn("url", F.lit("u"))
    for r in resources.clean_resources(resources.drop_unusable(rows)).collect():
        parts = [r["clean_name"], r["clean_id"]] if r["clean_name"] else [r["clean_id"]]
        assert r["storage_key"] == "__".join(parts)


def test_successes_and_errors_add_up(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("u"), "id").alias("url"),
        (F.col("id") % 600).cast("int").alias("status"),
        F.when(F.col("id") % 7 == 0, "abc").otherwise((F.col("id") * 10).cast("string")).alias("content_length"),
    )
    judged = responses.classify_responses(df, 5000)
    summary = responses.run_summary(judged).first()
    assert summary["successes"] + summary["errors"] == summary["total"] == 1000
    assert sum(r["n"] for r in responses.errors_by_type(judged).collect()) == summary["errors"]
    assert responses.collect_errors(judged).where("record is null").isEmpty()


def test_materialized_tables_keep_schema_and_rows(spark):
    df = spark.range(100).selectExpr("id", "map('a', cast(id as string)) m", "parse_json('[1]') v", "array(id) l")
    written = materialize(df)
    assert written.schema.simpleString() == df.schema.simpleString() and written.count() == 100
    assert materialize(df.where("id < 0")).isEmpty()


def test_small_batches_restores_settings(spark):
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), small_batches(spark):
        assert spark.conf.get(name) == "16"
        raise RuntimeError
    assert spark.conf.get(name) == before
