"""Indicator portals: two files per indicator, with an outcome for each."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.operators.responses import run_summary
from gleanspark.session import PAYLOAD_OPTIONS, materialize, small_batches
from gleanspark.sinks import store_indicator
from gleanspark.sources.fetch import Transport, fetch
from gleanspark.sources.indicators import (
    clean_metadata,
    expand_databases,
    indicator_resources,
    list_errors,
    scan_database_ids,
    scan_indicators,
)

_MAX_FILE = 2**31 - 1
#: Files, and bytes of them, that meet their work rows in one task.
_TASK_FILES = 100_000
_TASK_BYTES = 64 * 2**20
#: Outcome of an indicator list that failed or cannot be read.
UNREADABLE_LIST = "unreadable_list"


def harvest_indicators(
    hits: DataFrame,
    lists: DataFrame,
    destination: str,
    transport: Transport,
    fetch_partitions: int = 200,
    request_headers: Mapping[str, str] | None = None,
) -> DataFrame:
    """Fetch and store metadata and data files; gives ``(database_id, successes, errors, total)``.

    ``hits`` are search replies, ``lists`` the indicator lists by database. A
    file that fails costs that file alone, and unreadable metadata is an error.
    A wanted database whose list failed is one error, of the kind ``list``.
    Files go to ``files``, the outcome of each to ``runs``.
    """
    wanted = scan_database_ids(hits)
    listed = expand_databases(scan_indicators(lists), wanted).distinct()
    lost = expand_databases(list_errors(lists), wanted).select(
        "database_id",
        F.lit("list").alias("kind"),
        "status",
        F.lit(UNREADABLE_LIST).alias("error_type"),
        F.lit(False).alias("ok"),
    )
    work = materialize(indicator_resources(listed))
    replies = materialize(fetch(work, transport, fetch_partitions, request_headers, _MAX_FILE), PAYLOAD_OPTIONS)
    body = F.make_valid_utf8(F.col("content").cast("string"))
    texts = replies.select("url", "status", "error_type", "error_text", F.when(F.col("ok"), body).alias("body"))
    # Urls are alike, so their files and shuffles are far smaller than the rows; neither tells how many tasks they need.
    held = replies.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    tasks = max(fetch_partitions, work.count() // _TASK_FILES + 1, held // _TASK_BYTES + 1)
    files = work.repartition(tasks, "url").join(texts.repartition(tasks, "url").hint("merge"), "url", "left")
    is_metadata = F.col("kind") == "metadata"
    cleaned = clean_metadata(files.withColumn("_metadata", F.when(is_metadata, F.col("body"))), "_metadata")
    files = cleaned.withColumn("body", F.when(is_metadata, F.col("_metadata")).otherwise(F.col("body"))).drop("_metadata")
    with small_batches(hits.sparkSession):
        files = materialize(files, PAYLOAD_OPTIONS)
    good = F.col("body").isNotNull()
    ids = ("database_id", "indicator_id", "kind")
    store_indicator(files.where(good).select(*ids, "path", "body"), f"{destination}/files", "overwrite")
    unreadable = F.when(~good, F.coalesce("error_type", F.lit("unreadable")))
    outcomes = files.select(
        *ids, "url", "status", unreadable.alias("error_type"), "error_text", good.alias("ok")
    )
    outcomes = outcomes.unionByName(lost, allowMissingColumns=True)
    outcomes.write.mode("overwrite").parquet(f"{destination}/runs")
    return run_summary(hits.sparkSession.read.parquet(f"{destination}/runs"), "database_id")
